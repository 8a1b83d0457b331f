"""The driver contract where a library that only these operators need is missing."""

from tests.test_entry import entry_without


def test_a_missing_library_takes_only_the_optional_part():
    names, said = entry_without("ahocorasick")
    assert "loss_ratio" in names and not any(n.startswith("op") for n in names) and "pipeline" not in names
    assert said.count("is left out") >= 1 and "ahocorasick" in said
