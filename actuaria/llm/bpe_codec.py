"""Byte-level BPE encoding with reuse of content-defined chunks, and decoding.

1. *Chunks.* A rolling hash over the text's bytes cuts every text where the hash of the last
   32 bytes meets a condition, so an insertion moves only the cuts near it and equal
   passages of different documents give equal chunks.
2. *Sharing.* Chunk digests are counted over all documents (thin rows only). A chunk that
   occurs once is not worth a detour: it is encoded in place with what surrounds it. Of each
   chunk that occurs more often one owner is chosen; the chunk is encoded once, there, and
   its ids go to all other occurrences.
3. *Joins.* A chunk encoded by itself may differ from the whole text near its ends. A place
   where an ASCII non-space is followed by a space always separates two pre-tokens, whatever
   stands around it: no pre-token holds a space after its first character. So between two
   such places a chunk's ids are exactly those of the whole text. The bytes from the last
   such place of one chunk to the first one of the next are encoded anew and replace the
   ids there; a chunk whose ids do not meet these places exactly is encoded anew as a whole.
4. *Decoding* joins the ids' bytes and reads them as UTF-8, bad bytes replaced.

Texts travel once, compressed, keyed by content; only reused ids travel beside them. Equal
results to encoding each whole text by itself are what the tests check.

Memory: a worker holds the Arrow batch that Spark hands over, one text of it and the frame being
filled; frames end at a number of bytes, and the rolling hash runs in blocks.

Defined results: null text is encoded as the empty text (no ids); equal rows give equal rows;
null doc_id is kept; an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actuaria.llm.common import content_key, stored, whole_text

MIN_CHUNK, MEAN_CHUNK, MAX_CHUNK = 512, 2048, 16384  # bytes
HASHED = 32  # bytes that the rolling hash mixes
BLOCK = 1 << 20  # bytes hashed at a time
FRAME_ROWS, FRAME_BYTES = 1024, 1 << 20  # an output frame ends at either
PLACE = re.compile(rb"[!-~] ")  # a certain pre-token border lies between the two bytes
# ---- fixed value: the pattern that byte-level BPE splits text by before merging --------
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# White space as the pattern reads it; the encoder's look-ahead keeps a state for each character
# of a run and gives up near a million of them.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_SPACE = 100_000  # characters
LONG_RUN = f"(?<![{SPACE}])[{SPACE}]{{%d,}}+"


# ---- vocabulary ---------------------------------------------------------------------
@dataclass(frozen=True)
class Vocabulary:
    """Token bytes by id, and the special tokens' strings."""

    tokens: list[bytes]
    special: dict[str, int]

    @property
    def id_type(self) -> str:
        return "<u2" if len(self.tokens) <= 1 << 16 else "<u4"


def byte_letters() -> dict[str, int]:
    """The printable letter that vocabulary files write for each byte."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_vocabulary(path: str) -> Vocabulary:
    """Read a byte-level BPE file of the tokenizers library (on the driver).

    Merge priority must follow the ids, as it does for vocabularies trained in one go.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    if any(re.search(r"\s", s) for s in special):
        raise ValueError("special tokens with white space are not supported")
    ids = {k: v for k, v in spec["model"]["vocab"].items() if k not in special}
    tokens: list[bytes] = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for text, i in ids.items():
        tokens[i] = bytes(letters[c] for c in text)
    for text, i in special.items():
        tokens[i] = text.encode("utf-8")
    pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    made = [ids["".join(p)] for p in pairs]
    if made != sorted(made):
        raise ValueError("merge order does not follow the ids")
    return Vocabulary(tokens, special)


class Codec:
    """Encoder and decoder of one vocabulary, built once in each task."""

    def __init__(self, vocabulary: Vocabulary, long_space: int = LONG_SPACE):
        self.long_space, self.long_run = long_space, re.compile(LONG_RUN % long_space)
        self.tokens, self.special, self.id_type = vocabulary.tokens, vocabulary.special, vocabulary.id_type
        ranks = {t: i for i, t in enumerate(self.tokens) if t and i not in self.special.values()}
        self.bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text by itself; a special token's string is that token."""
        if any(s in text for s in self.special):
            ids = []
            for part in self.cut.split(text):
                ids += [self.special[part]] if part in self.special else self.ordinary(part)
        else:
            ids = self.ordinary(text)
        return np.frombuffer(array("H" if self.id_type == "<u2" else "I", ids), dtype=self.id_type)

    def ordinary(self, text: str) -> list[int]:
        """Ids of a text without special tokens, very long white-space runs apart.

        Such a run is one pre-token by itself, less its last character before a non-space.
        """
        if len(text) < self.long_space:
            return self.bpe.encode_ordinary(text)
        ids, at = [], 0
        for run in self.long_run.finditer(text):
            stop = run.end() if run.end() == len(text) else run.end() - 1
            ids += self.bpe.encode_ordinary(text[at : run.start()])
            ids += self.bpe._encode_single_piece(text[run.start() : stop].encode("utf-8"))
            at = stop
        return ids + self.bpe.encode_ordinary(text[at:])

    def decode(self, ids: np.ndarray) -> str:
        return b"".join([self.tokens[i] for i in ids.tolist()]).decode("utf-8", "replace")

    def join(self, text: bytes, parts: list[tuple[int, int, bytes]]) -> np.ndarray:
        """Ids of the whole text from ready chunk ids, their joins encoded anew."""
        out, at = [], 0
        for start, stop, blob in sorted(parts):
            first = border_after(text, start, stop)
            last = None if first is None else border_before(text, stop)
            if last is None or first < at or first >= last:
                continue
            ids = np.frombuffer(blob, dtype=self.id_type)
            starts = np.concatenate(([0], np.cumsum(self.lengths[ids]))) + start
            i, j = np.searchsorted(starts, first), np.searchsorted(starts, last)
            if starts[i] != first or starts[j] != last or starts[-1] != stop:
                continue  # no agreement: these bytes are encoded with the next gap
            if first > at:
                out.append(self.encode(text[at:first].decode("utf-8")))
            out.append(ids[i:j])
            at = last
        if at < len(text):
            out.append(self.encode(text[at:].decode("utf-8")))
        return np.concatenate(out) if out else np.empty(0, dtype=self.id_type)


def border_after(text: bytes, at: int, stop: int) -> int | None:
    """First certain pre-token border from ``at`` to ``stop``."""
    if at == 0:
        return 0
    found = PLACE.search(text, at - 1, stop + 1)
    return found.start() + 1 if found else None


def border_before(text: bytes, at: int) -> int | None:
    """Last certain pre-token border at or before ``at``."""
    if at == len(text):
        return at
    while at > 0:
        at = text.rfind(b" ", 0, at + 1)
        if at > 0 and 0x21 <= text[at - 1] <= 0x7E:
            return at
        at -= 1
    return None


# ---- rows in and out of a worker ------------------------------------------------------
def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Scalar, ...]]:
    """Rows of a task's batches, one at a time and without a copy of the batch."""
    for batch in batches:
        yield from zip(*batch.columns)


def _frames(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Frames of at most ``FRAME_ROWS`` rows, each closed once it holds ``FRAME_BYTES``."""

    def frame() -> pa.RecordBatch:
        columns = [pa.array(values, field.type) for values, field in zip(zip(*held), schema)]
        held.clear()
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(value) for value in row if isinstance(value, (bytes, str)))
        if len(held) >= FRAME_ROWS or size >= FRAME_BYTES:
            yield frame()
            size = 0
    if held:
        yield frame()


# ---- chunks -------------------------------------------------------------------------
def _gear() -> np.ndarray:
    """A fixed pseudo-random number for each byte value."""
    return np.frombuffer(
        b"".join(hashlib.sha256(bytes([b])).digest()[:4] for b in range(256)), dtype="<u4"
    ).astype(np.uint32)


def cut_spots(text: bytes, gear: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Places of a text, in order, where the hash meets the condition and a character begins."""
    found = []
    for at in range(0, len(text), block):
        lead = min(at, HASHED - 1)
        codes = np.frombuffer(text, dtype=np.uint8)[at - lead : at + block + 1]
        rolled = gear[codes]
        for step in (1, 2, 4, 8, 16):  # after these, entry i mixes bytes i-31..i
            rolled[step:] += rolled[:-step] << np.uint32(step)
        inner = (codes[1:] & 0xC0) != 0x80
        spots = np.flatnonzero(((rolled[:-1] >> np.uint32(8)) % np.uint32(MEAN_CHUNK) == 0) & inner) + 1
        found.append(spots[spots > lead] + (at - lead))
    return np.concatenate(found) if found else np.empty(0, dtype=np.int64)


def cut_points(text: bytes, gear: np.ndarray) -> list[int]:
    """Chunk ends of a text, its length included; never inside a UTF-8 character."""
    n = len(text)
    if n <= MIN_CHUNK:
        return [n]
    spots = cut_spots(text, gear)
    cuts, last = [], 0
    while n - last > MIN_CHUNK:
        i = np.searchsorted(spots, last + MIN_CHUNK)
        nxt = int(spots[i]) if i < len(spots) else n
        if nxt - last > MAX_CHUNK:
            nxt = last + MAX_CHUNK
            while text[nxt] & 0xC0 == 0x80:
                nxt -= 1
        cuts.append(nxt)
        last = nxt
    if last < n:
        cuts.append(n)
    return cuts


CHUNKS = pa.schema([("k", pa.binary()), ("start", pa.int32()), ("stop", pa.int32()), ("digest", pa.binary())])


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    gear = _gear()

    def chunks() -> Iterator[tuple]:
        for key, text in _rows(batches):
            raw, at, k = text.as_buffer().to_pybytes(), 0, key.as_py()
            if not raw:
                continue
            for end in cut_points(raw, gear):
                yield k, at, end, hashlib.sha256(raw[at:end]).digest()[:16]
                at = end

    return _frames(chunks(), CHUNKS)


BODIES = pa.schema([("doc_id", pa.string()), ("k", pa.binary()), ("body", pa.binary())])


def _packed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, k and text -> the text zstd-compressed, to halve its shuffle."""
    squeeze = zstandard.ZstdCompressor(level=3)
    return _frames(((d.as_py(), k.as_py(), squeeze.compress(t.as_buffer())) for d, k, t in _rows(batches)), BODIES)


def shared_chunks(keyed: DataFrame) -> DataFrame:
    """Occurrences of the chunks found more than once: k, start, stop, digest, own.

    ``keyed`` has ``k`` (content key) and ``text``. A text's chunks are listed once however
    many rows hold it, but all its rows count as occurrences. ``own`` marks the one place
    that encodes the chunk.
    """
    rows = keyed.select("k", "text").mapInArrow(_chunk_rows, "k binary, start int, stop int, digest binary")
    chunks = stored(rows, "chunks")
    counted = chunks.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("k", "start")).alias("owner"))
    often = counted.where(F.col("n") > 1).select("digest", "owner")
    return (
        chunks.join(often, "digest").dropDuplicates(["k", "start"])
        .withColumn("own", F.struct("k", "start") == F.col("owner")).drop("owner")
    )


# ---- operators ----------------------------------------------------------------------
def encode_documents(docs: DataFrame, vocabulary: Vocabulary, decoded: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) of every row of ``docs``.

    ``decoded`` adds the column ``text``: the ids decoded again, in the same pass.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.tokens, vocabulary.special))  # one file: a few MB
    keyed = docs.select("doc_id", whole_text().alias("text")).withColumn("k", content_key(F.col("text")))
    places = stored(shared_chunks(keyed), "places")
    # doc_id crosses to Python as text
    texts = (
        keyed.select(F.col("doc_id").cast("string"), "k", "text")
        .mapInArrow(_packed_rows, "doc_id string, k binary, body binary").where(F.col("k").isNotNull())
    )

    def encode_owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, reader = Codec(Vocabulary(*shared.value)), zstandard.ZstdDecompressor()

        def codes() -> Iterator[tuple]:
            for _, _, body, wanted in _rows(batches):
                raw = reader.decompress(body.as_buffer())
                for w in wanted.as_py():
                    # a cut never splits a character, so the chunk is a text of its own
                    yield w["digest"], codec.encode(raw[w["start"] : w["stop"]].decode("utf-8")).tobytes()

        return _frames(codes(), pa.schema([("digest", pa.binary()), ("ids", pa.binary())]))

    owned = places.where("own").groupBy("k").agg(F.collect_list(F.struct("start", "stop", "digest")).alias("wanted"))
    # rows with equal text all carry its key: one of them is enough. The select keeps every
    # column of texts, so that this join and the one below read one and the same shuffle.
    codes = (
        texts.join(owned, "k").select("doc_id", "k", "body", "wanted")
        .mapInArrow(encode_owned, "digest binary, ids binary").dropDuplicates(["digest"])
    )
    parts = (
        places.join(codes, "digest").groupBy("k")
        .agg(F.collect_list(F.struct("start", "stop", "ids")).alias("parts"))
    )

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, reader = Codec(Vocabulary(*shared.value)), zstandard.ZstdDecompressor()
        columns = [("doc_id", pa.string()), ("n_tokens", pa.int64()), ("ids", pa.binary())]

        def encoded() -> Iterator[tuple]:
            for doc_id, body, ready in _rows(batches):
                parts = [(p["start"], p["stop"], p["ids"]) for p in ready.as_py() or ()]
                ids = codec.join(reader.decompress(body.as_buffer()), parts)
                row = doc_id.as_py(), len(ids), ids.astype("<u4").tobytes()
                yield row + ((codec.decode(ids),) if decoded else ())

        return _frames(encoded(), pa.schema(columns + [("text", pa.string())] * decoded))

    kind = docs.schema["doc_id"].dataType
    return (
        texts.join(parts, "k", "left")
        .select("doc_id", "body", "parts")
        .mapInArrow(assemble, "doc_id string, n_tokens long, ids binary" + ", text string" * decoded)
        .withColumn("doc_id", F.col("doc_id").cast(kind))
    )


def decode_documents(encoded: DataFrame, vocabulary: Vocabulary, column: str = "text") -> DataFrame:
    """``encoded`` with the text of its ``ids`` (little-endian unsigned 32-bit) added."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary.tokens)

    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = shared.value
        for blobs in batches:
            yield pd.Series(
                [b"".join([tokens[i] for i in np.frombuffer(b, "<u4").tolist()]).decode("utf-8", "replace") for b in blobs],
                dtype=object,
            )

    return encoded.withColumn(column, F.pandas_udf(decode, "string")("ids"))


def round_trip(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, n_tokens, ids and the decoded text of every row."""
    return encode_documents(docs, load_vocabulary(vocabulary_path), decoded=True)
