"""Token counts against the sentencepiece library."""

import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from actuaria.llm import token_transducer as tt
from tests.llm.helpers import SCHEMA, empty_docs, odd_docs, odd_rows, with_extras

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = tt.load_model(PATH)
MACHINE = tt.Transducer(MODEL)
ODD = ["", " ", "a", "the  the", "\x00", "▁", "▁▁ ▁a", "<s></s><unk> <0x41>", "é" * 9, "é", "aaaaaaaaaaaaa", " x\t\n", "🙂👩‍👩‍👧"]


def library(text):
    return len(MACHINE.library.encode(text))


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert MACHINE.count(text) == library(text)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="abertsin <>_/.\n", max_size=80), st.text(alphabet="a =-", max_size=120)))
def test_any_text(text):
    assert MACHINE.count(text) == library(text)


def test_a_state_holds_all_that_matters():
    """Counts continued from the state of a prefix, at every cut, are those of the whole text."""
    text = MACHINE.normal("internationalisation of ==========  numbers 1234567 Übergrößenträger 漢字かな x")
    whole = MACHINE.run(tt.START, text)
    for cut in range(len(text)):
        state, n = MACHINE.run(tt.START, text[:cut])
        end, rest = MACHINE.run(tt._key(tt._name(state)), text[cut:])
        assert (end, n + rest) == whole


def test_a_small_table_starts_again_and_stays_right():
    small = tt.Transducer(MODEL, max_states=20)
    rnd = random.Random(3)
    for _ in range(40):
        text = "".join(rnd.choice("abcdefghi  ") for _ in range(200))
        assert small.count(text) == library(text)


def test_other_vocabularies_are_refused(tmp_path):
    with pytest.raises(Exception):
        tt.load_model(public_tokenizers.path("byte_bpe_50k.json"))


def check(spark, docs, **options):
    found = tt.count_tokens(docs, PATH, **options)
    assert dict(found.dtypes) == {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint"}
    want = [(r["doc_id"], len((r["text"] or "").encode()), library(r["text"] or "")) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))


def test_whole_rows_chunks_and_extra_columns(spark):
    check(spark, odd_docs(spark))
    extra = with_extras(odd_docs(spark)).selectExpr("*", "1 as no", "2 as look", "3 as body", "4 as entry", "5 as n_bytes")
    check(spark, extra, chunk=100, look=20)
    check(spark, empty_docs(spark))


@pytest.mark.parametrize("chunk, look", [(10, 3), (64, 16)])
def test_chunks_cut_anywhere(spark, chunk, look):
    """Texts without borders and of long periods, whose entry states no short look tells."""
    rows = [(i, t) for i, t in enumerate(["=" * 903, "ab" * 350, "a" * 1001, "ha" * 333 + " " + "-" * 500, "   " * 300, "x y " * 90])]
    rows += [(9, odd_rows()[7][1][:3000])] * 5
    check(spark, spark.createDataFrame(rows, SCHEMA), chunk=chunk, look=look)
