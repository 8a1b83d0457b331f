"""Generations of a set of tables: rebuilt aside, switched in one step, dropped when unread.

A *home* folder (any Hadoop file system) holds

    generations/<id>/<table>   the tables of one rebuild
    current/<number>-<id>      an empty marker; the highest name is the current generation
    writers/<id>               an empty marker of a rebuild under way
    readers/<id>/<lease>       an empty marker of each open reader

A rebuild writes a new generation that nobody reads. It becomes current by one empty file,
whose creation is atomic on every store, after each of its tables was found whole. Until then,
and if the rebuild dies at any point, readers see the generation before. A reader takes a lease and then
looks again whether its generation is still marked; :meth:`Generations.retire` takes the markers of
older generations away and then looks for leases. So either the reader sees that it came
too late (and takes the newer generation), or the lease keeps the folder.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LEASE_SECONDS = 24 * 3600


class IncompleteGeneration(RuntimeError):
    """A table of a generation is missing or does not hold the rows that were written."""


@dataclass(frozen=True)
class Generation:
    """One generation as a reader sees it."""

    spark: SparkSession
    id: str
    folder: str

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def table(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))


def counted_write(df: DataFrame, path: str) -> int:
    """Write a new Parquet folder; the rows are counted by the write itself."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return int(seen.get["rows"])


class Generations:
    """The generations under ``home``.

    ``lease_seconds`` is the age from which the marker of a reader or a writer counts as
    left behind by a process that died.
    """

    def __init__(self, spark: SparkSession, home: str, lease_seconds: int = LEASE_SECONDS):
        self.spark, self.home, self.lease_seconds = spark, home.rstrip("/"), lease_seconds

    # ---- files ------------------------------------------------------------------------
    def _at(self, *names: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.home, *names)))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self, *folder: str) -> dict[str, float]:
        """Entries of a folder and their time of change in seconds."""
        fs, path = self._at(*folder)
        if not fs.exists(path):
            return {}
        return {s.getPath().getName(): s.getModificationTime() / 1000 for s in fs.listStatus(path)}

    def _mark(self, *name: str) -> None:
        fs, path = self._at(*name)
        fs.create(path, False).close()

    def _remove(self, *name: str) -> None:
        fs, path = self._at(*name)
        fs.delete(path, True)

    def _live(self, names: dict[str, float]) -> list[str]:
        return [n for n, changed in names.items() if time.time() - changed < self.lease_seconds]

    # ---- writing ------------------------------------------------------------------------
    def begin(self) -> str:
        """A new, unpublished generation; its folder is :meth:`folder`."""
        new = uuid.uuid4().hex
        self._mark("writers", new)
        return new

    def folder(self, generation: str) -> str:
        return f"{self.home}/generations/{generation}"

    def publish(self, generation: str, rows: dict[str, int]) -> None:
        """Make a generation current, once every table of ``rows`` holds the rows given (file footers)."""
        for table, expected in rows.items():
            fs, done = self._at("generations", generation, table, "_SUCCESS")
            found = self.spark.read.parquet(f"{self.folder(generation)}/{table}").count() if fs.exists(done) else None
            if found != expected:
                raise IncompleteGeneration(f"{table}: {found} rows instead of {expected}")
        last = max(self._names("current"), default="0-")
        self._mark("current", f"{int(last.split('-')[0]) + 1:012d}-{generation}")
        self._remove("writers", generation)

    def give_up(self, generation: str) -> None:
        """End an unpublished generation; its folder goes when the next one retires the old."""
        self._remove("writers", generation)

    def retire(self, keep: int = 0) -> list[str]:
        """Remove what is neither current, nor one of ``keep`` before it, nor being read or written."""
        marks = sorted(self._names("current"))
        kept = marks[-1 - keep :]
        for mark in marks[: -1 - keep]:
            self._remove("current", mark)
        held = {m.split("-", 1)[1] for m in kept} | set(self._live(self._names("writers")))
        gone = []
        for generation in self._names("generations"):
            if generation not in held and not self._live(self._names("readers", generation)):
                self._remove("generations", generation)
                self._remove("readers", generation)
                self._remove("writers", generation)
                gone.append(generation)
        return gone

    def replace(self, tables: dict[str, DataFrame], keep: int = 0) -> dict[str, int]:
        """Write a generation of ``tables``, make it current and return the rows of each."""
        new = self.begin()
        try:
            rows = {name: counted_write(df, f"{self.folder(new)}/{name}") for name, df in tables.items()}
            self.publish(new, rows)
        except Exception:
            self.give_up(new)
            raise
        self.retire(keep)
        return rows

    # ---- reading ------------------------------------------------------------------------
    def current(self) -> str | None:
        last = max(self._names("current"), default=None)
        return last.split("-", 1)[1] if last else None

    @contextmanager
    def reading(self) -> Iterator[Generation]:
        """The current generation, kept as long as the block runs (or the lease lasts)."""
        while True:
            last = max(self._names("current"), default=None)
            if last is None:
                raise FileNotFoundError(f"no complete generation under {self.home}")
            generation, lease = last.split("-", 1)[1], uuid.uuid4().hex
            self._mark("readers", generation, lease)
            if last in self._names("current"):
                break
            self._remove("readers", generation, lease)
        try:
            yield Generation(self.spark, generation, self.folder(generation))
        finally:
            self._remove("readers", generation, lease)
