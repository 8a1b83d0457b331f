"""Small helpers shared by the text operators of this subpackage.

Texts are keyed by their content (:func:`content_key`): an operator whose answer depends
on the text alone can join its answer back without relying on ``doc_id``, which may be
null or repeated. Internal columns live in frames that the operators build themselves
from the two or three columns they read, so extra columns of the input can never clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actuaria.session import materialize


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table, every row and column of it."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def read_input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, with null read as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def content_key(text: Column) -> Column:
    """128 bits of SHA-256 of a text: equal texts, and only those, share a key."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def fresh_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared checkpoint folder and read it back (lineage is cut)."""
    return materialize(df, f"llm-{name}")


def hash_sample(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """At most ``rows`` rows, those with the smallest hash of ``keys`` (ties by the keys).

    A hash threshold from the row count leaves about the rows wanted before they are sorted,
    so what meets in the last task is bounded by ``rows``, not by the number of partitions.
    """
    spread = 1 << 32
    place = F.pmod(F.xxhash64(*keys), F.lit(spread))
    total = df.count()
    if total > 2 * rows:
        df = df.where(place < int(spread * 1.5 * rows / total))
    return df.orderBy(place, *keys).limit(rows)


def pack_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Series of texts -> Series of zstd-compressed UTF-8, to halve a text shuffle."""
    squeeze = zstandard.ZstdCompressor(level=3)
    for texts in batches:
        yield pd.Series([squeeze.compress(t.encode("utf-8")) for t in texts], dtype=object)


def packed(text: Column) -> Column:
    return F.pandas_udf(pack_texts, "binary")(text)


def unpack(blob: bytes, reader: zstandard.ZstdDecompressor) -> bytes:
    """UTF-8 bytes of a text packed by :func:`packed`."""
    return reader.decompress(blob)
