"""The driver contract where optional parts cannot be imported."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def entry_without(*modules):
    """Names of the queries in a process where ``modules`` cannot be imported."""
    code = f"""
import sys
for m in {modules!r}:
    sys.modules[m] = None
import __spark_entry__ as e
assert set(e.oracle_sql()) <= set(e.queries())
print(*sorted(e.queries()))
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return done.stdout.split(), done.stderr


def test_without_the_optional_parts():
    names, said = entry_without("actuaria.llm", "corpus_pipeline")
    assert "loss_ratio" in names and "pipeline" not in names and len(names) >= 50
