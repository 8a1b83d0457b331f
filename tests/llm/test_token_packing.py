"""Best-fit-decreasing against a plain scan, and lossless round trips."""

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from actuaria.llm import bpe_codec as B
from actuaria.llm import token_packing as P
from tests.llm.helpers import SCHEMA, empty_docs, odd_rows, with_extras

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 70).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=80))))
def test_best_fit_decreasing(case):
    capacity, lengths = case
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(capacity - n)
    rows = P.best_fit_decreasing(lengths, capacity)
    assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
    assert sorted(capacity - sum(lengths[i] for i in r) for r in rows) == sorted(rooms)


def test_packed_rows_and_lossless_split(spark, tmp_path):
    rows = [*odd_rows(), (None, "no id"), (5, "same id " * 300), (5, "other text"), (5, "other text")]
    docs = with_extras(spark.createDataFrame(rows, SCHEMA))
    vocabulary = B.load_vocabulary(PATH)
    packed = P.write_packed(P.pack_documents(docs, vocabulary, row=256, window=5), str(tmp_path / "packed"))
    for r in packed.collect():
        assert len(r["ids"]) == 2 * 256 and r["id_bytes"] == 2 and r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"] <= 256
        assert r["position_resets"] == r["cu_seqlens"][:-1] and len(r["doc_ids"]) == len(r["position_resets"])
        assert set(np.frombuffer(r["ids"], "<u2")[r["n_tokens"] :]) <= {vocabulary.special["<|endoftext|>"]}
    known = Tokenizer.from_file(PATH)
    want = [
        (str(i), np.array(known.encode(t or "", add_special_tokens=False).ids, "<u2").tobytes()) for i, t in rows
    ]
    assert sorted((str(r["doc_id"]), bytes(r["ids"])) for r in P.unpack_documents(packed).collect()) == sorted(want)
    assert P.pack_documents(empty_docs(spark), vocabulary).count() == 0
