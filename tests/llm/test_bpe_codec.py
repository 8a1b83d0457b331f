"""Ids and texts against encoding each whole text with the tokenizers library."""

import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from actuaria.llm import bpe_codec as B
from tests.llm.helpers import SCHEMA, empty_docs, odd_docs, odd_rows, prose, with_extras

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def known():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return B.Codec(B.load_vocabulary(PATH))


def expect(rows, known):
    out = []
    for i, text in rows:
        ids = known.encode(text or "", add_special_tokens=False).ids
        out.append((str(i), len(ids), np.array(ids, "<u4").tobytes(), known.decode(ids, skip_special_tokens=False)))
    return sorted(out)


def got(frame):
    return sorted((str(r["doc_id"]), r["n_tokens"], bytes(r["ids"]), r["text"]) for r in frame.collect())


def test_odd_texts_round_trip(spark, known):
    done = B.round_trip(with_extras(odd_docs(spark)), PATH)
    assert got(done) == expect(odd_rows(), known)
    apart = B.decode_documents(done.drop("text"), B.load_vocabulary(PATH))
    assert got(apart) == expect(odd_rows(), known)
    assert B.round_trip(empty_docs(spark), PATH).count() == 0


def test_shared_passages_are_joined_exactly(spark, known):
    shared = prose(21, 4000)
    rnd = random.Random(2)
    rows = []
    for i in range(25):
        a = rnd.randrange(len(shared) // 2)
        b = a + rnd.randrange(3000, 12000)
        rows.append((i, prose(100 + i, rnd.randrange(200)) + rnd.choice(["", " ", "  ", "\n\n", "'", "<|endoftext|>"]) + shared[a:b] + rnd.choice(["", "s", " 9", "''re"])))
    assert got(B.round_trip(spark.createDataFrame(rows, SCHEMA), PATH)) == expect(rows, known)
    shared_rows = B.shared_chunks(spark.createDataFrame([(bytes([i]), t) for i, t in rows], "k binary, text string"))
    places = shared_rows.collect()
    assert places and len({r["digest"] for r in places}) == sum(r["own"] for r in places) < len(places)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab' \n\t9!é漢<|>endoftx \x00"), max_size=60), st.data())
def test_join_repairs_any_cut(codec, known, text, data):
    raw = text.encode()
    cuts = sorted({0, len(raw), *data.draw(st.lists(st.integers(0, len(raw)), max_size=4))})
    cuts = [c for c in cuts if c == len(raw) or raw[c] & 0xC0 != 0x80]
    parts = [(a, b, codec.encode(raw[a:b].decode()).tobytes()) for a, b in zip(cuts, cuts[1:])]
    assert codec.join(raw, parts).tolist() == known.encode(text, add_special_tokens=False).ids


def test_cuts_follow_content():
    gear = B._gear()
    text = prose(31, 20000).encode()
    plain, moved = B.cut_points(text, gear), B.cut_points(b"inserted bytes " + text, gear)
    assert plain[-1] == len(text) and moved[-1] == len(text) + 15
    assert len({c + 15 for c in plain} & set(moved)) > 0.9 * len(plain)
    sizes = np.diff([0, *plain])
    assert sizes.max() <= B.MAX_CHUNK and (sizes[:-1] >= B.MIN_CHUNK).all()


def test_cuts_do_not_depend_on_blocks():
    gear, text = B._gear(), (prose(32, 3000) + " é漢" * 500).encode()
    spots = B.cut_spots(text, gear).tolist()
    assert spots and all(text[at] & 0xC0 != 0x80 for at in spots)
    for block in (1, 7, 31, 32, 33, 1000, len(text) - 1, len(text)):
        assert B.cut_spots(text, gear, block).tolist() == spots


def peak_mb(work) -> float:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_cutting_a_long_text_takes_little_memory():
    gear, text = B._gear(), prose(33, 2000).encode() * 1000
    assert len(text) > 10_000_000 and peak_mb(lambda: B.cut_points(text, gear)) < 32


def test_a_worker_holds_one_text_and_one_frame():
    texts = [prose(i, 40) * 200 for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array([bytes([i % 256, i // 256]) for i in range(300)]), pa.array(texts)], names=["k", "text"])
    assert batch.nbytes > 10_000_000
    del texts

    def read():
        rows = sum(len(frame) for frame in B._chunk_rows(iter([batch])))
        assert rows > 300

    assert peak_mb(read) < 8


def test_frames_end_at_rows_and_bytes():
    schema = pa.schema([("a", pa.int64()), ("b", pa.string())])
    rows = [(i, None if i % 5 == 0 else "x" * (B.FRAME_BYTES // 3 if i % 100 == 1 else 10)) for i in range(5000)]
    frames = list(B._frames(iter(rows), schema))
    assert [tuple(r.values()) for f in frames for r in f.to_pylist()] == rows
    assert len(frames) > 5 and max(len(f) for f in frames) <= B.FRAME_ROWS
    assert max(f.nbytes for f in frames) < 2 * B.FRAME_BYTES
    assert list(B._frames(iter([]), schema)) == []


def test_millions_of_spaces(spark, known):
    rows = [(i, a + run * n + b) for i, (a, run, n, b) in enumerate([
        ("x", " ", 3_000_000, "y z"), ("", "\n", 1_500_000, "word"), ("a ", "\t \n", 500_000, ""), ("b", "\u3000", 1_200_000, "'s<|endoftext|> c"),
    ])]
    assert got(B.round_trip(spark.createDataFrame(rows, SCHEMA), PATH)) == expect(rows, known)


@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet=st.sampled_from("ab'  \n\t9!é\u3000\x1c\x85<|>endoftx"), max_size=60))
def test_long_runs_by_themselves(known, text):
    short = getattr(test_long_runs_by_themselves, "codec", None) or B.Codec(B.load_vocabulary(PATH), 2)
    test_long_runs_by_themselves.codec = short
    assert short.encode(text).tolist() == known.encode(text, add_special_tokens=False).ids
