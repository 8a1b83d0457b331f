"""Fixed-length training rows of token ids, by best-fit-decreasing packing.

Every document is encoded whole and followed by the end-of-text id. A document longer than a row is
split losslessly: all but its last piece fill rows of their own. The remaining pieces of a
task's documents are packed best-fit-decreasing in windows of ``WINDOW`` pieces: from the longest to the
shortest, each goes to the open row with the least room that still holds it, found by a
search tree over room sizes in logarithmic time. Nothing is shuffled: a packed row holds
documents of one input partition, and memory is bounded by the window.

A packed row has its ids as a fixed-width little-endian array (``id_bytes`` each: two where the
vocabulary allows; unused places hold the end-of-text id), the cumulative segment lengths (0 first) that mark the segments, the places where
positions restart, and for each segment its document, piece number and first token. ``row_keys`` tell the
documents' rows apart, whatever their doc_ids. :func:`write_packed` stores the rows as the training job
reads them, and :func:`unpack_documents` gives the ids of every document's row back, whole.

Defined results: null and empty texts give one segment with the end-of-text id alone; equal rows and rows that
share a doc_id, or have none, are packed and unpacked as rows of their own; an empty table gives an empty result; other
columns are not read. Which documents share a row, and the row keys, depend on the input's partitions; the set
of segments does not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actuaria.llm.bpe_codec import Codec, Vocabulary
from actuaria.llm.common import whole_text

ROW = 2048
GROUP_BYTES = 16 << 20
FRAME = 256  # packed rows handed over at a time
WINDOW = 8192  # pieces packed together: at most ROW * WINDOW ids are held

SCHEMA = (
    "ids binary, id_bytes int, n_tokens int, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<string>, pieces array<int>, offsets array<long>, row_keys array<long>"
)


class RoomTree:
    """Open rows by the room they have left, over rooms 0..capacity.

    A segment tree over room sizes counts the open rows below each node; the smallest room
    that holds a piece is found by walking down from the root.
    """

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, change: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += change
            node >>= 1

    def put(self, row: int, room: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (row, room) with the smallest room of ``least`` or more."""
        node = least + self.size
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.size
        self._add(room, -1)
        return self.rows[room].pop(), room


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows of item numbers; every item has a length of 1 to ``capacity``."""
    tree, rows = RoomTree(capacity), []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.take(lengths[item])
        if found is None:
            rows.append([item])
            row, room = len(rows) - 1, capacity
        else:
            row, room = found
            rows[row].append(item)
        tree.put(row, room - lengths[item])
    return rows


def _packed_row(segments: list[tuple], row: int, pad: int) -> tuple:
    """One output row of (doc_id, piece, offset, ids, row key) segments."""
    ids = np.full(row, pad, dtype=segments[0][3].dtype)
    ends = np.cumsum([0] + [len(s[3]) for s in segments])
    ids[: ends[-1]] = np.concatenate([s[3] for s in segments])
    return (
        ids.tobytes(), ids.itemsize, int(ends[-1]), ends.tolist(), ends[:-1].tolist(),
        *([s[i] for s in segments] for i in (0, 1, 2, 4)),
    )


def pack_documents(
    docs: DataFrame, vocabulary: Vocabulary, end_of_text: str = "<|endoftext|>", row: int = ROW, window: int = WINDOW
) -> DataFrame:
    """Packed rows of every document of ``docs`` (columns of ``SCHEMA``)."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.tokens, vocabulary.special))
    end_id = vocabulary.special[end_of_text]
    names = [f.split(" ")[0] for f in SCHEMA.split(", ")]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(Vocabulary(*shared.value))
        waiting: list[tuple] = []
        ready: list[tuple] = []

        def pack_waiting() -> Iterator[pd.DataFrame]:
            for members in best_fit_decreasing([len(p[3]) for p in waiting], row):
                ready.append(_packed_row([waiting[i] for i in members], row, end_id))
                yield from frames()
            waiting.clear()

        def frames(least: int = FRAME) -> Iterator[pd.DataFrame]:
            """The rows made so far, once there are enough for a frame of their own."""
            if len(ready) >= least:
                yield pd.DataFrame(ready, columns=names)
                ready.clear()

        for batch in batches:
            for doc_id, key, text in zip(batch["doc_id"], batch["key"], batch["text"]):
                ids = np.append(codec.encode(text), np.array([end_id], dtype=codec.id_type))
                rest = len(ids) // row * row
                for at in range(0, rest, row):
                    ready.append(_packed_row([(doc_id, at // row, at, ids[at : at + row], key)], row, end_id))
                    yield from frames()
                if rest < len(ids):
                    waiting.append((doc_id, rest // row, rest, ids[rest:], key))
                if len(waiting) == window:
                    yield from pack_waiting()
        yield from pack_waiting()
        yield from frames(1)

    key = F.monotonically_increasing_id().alias("key")
    return docs.select(F.col("doc_id").cast("string"), key, whole_text().alias("text")).mapInPandas(pack, SCHEMA)


def write_packed(rows: DataFrame, path: str) -> DataFrame:
    """Write packed rows as Parquet (fixed-width id matrix, segment lengths, resets) and read them back.

    Row groups are small: a writer holds one in memory beside the Python worker, and a training
    job fetches rows group by group. Ids have no repeats worth a dictionary.
    """
    writer = rows.write.mode("overwrite").option("parquet.block.size", GROUP_BYTES).option("parquet.enable.dictionary", False)
    writer.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def unpack_documents(rows: DataFrame) -> DataFrame:
    """doc_id and ids (without the end-of-text id) of every packed document's row."""
    each = rows.select(
        "ids", "id_bytes", "cu_seqlens", F.posexplode(F.arrays_zip("row_keys", "doc_ids", "offsets")).alias("i", "s")
    )
    segments = each.select(
        F.col("s.row_keys").alias("key"), F.col("s.doc_ids").alias("doc_id"), F.col("s.offsets").alias("at"),
        F.expr("substring(ids, id_bytes * cu_seqlens[i] + 1, id_bytes * (cu_seqlens[i + 1] - cu_seqlens[i]))").alias("part"),
        "id_bytes",
    )
    joined = segments.groupBy("key", "doc_id", "id_bytes").agg(F.sort_array(F.collect_list(F.struct("at", "part"))).alias("p"))
    whole = F.aggregate("p", F.expr("cast('' as binary)"), lambda s, x: F.concat(s, x["part"]))
    return joined.select("doc_id", "id_bytes", whole.alias("w")).select(
        "doc_id", F.expr("substring(w, 1, length(w) - id_bytes)").alias("ids")
    )
