"""CSV files of an unknown dialect: found on a bounded sample, then read once.

The sample is the first ``SAMPLE_BYTES`` of one file. Every separator and quote of the
lists below is tried on it; the pair wins under which most records have the same number of
fields (then: more fields, then the order of the lists). Types are the first of ``TYPES`` that
every sampled value of a column fits, dates and timestamps with a format from their lists. The first
record is a header when it does not fit the types of the records under it, or, where all columns are
text, when its values are names that do not come back among the column's values.

What the sample says need not hold for the rest of the file. The typed read keeps a column
``rejects`` with what it could not type: the whole record where it has another number of fields,
else the values that do not fit. Nothing is dropped, and the file is read once.
"""

from __future__ import annotations

import csv
import io
import re
from collections import Counter
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SAMPLE_BYTES = 1 << 18
SEPARATORS = (",", ";", "\t", "|")
QUOTES = ('"', "'")
# (pattern of the Spark reader, the same for the sample)
DATES = (
    ("yyyy-MM-dd", "%Y-%m-%d"), ("dd/MM/yyyy", "%d/%m/%Y"), ("MM/dd/yyyy", "%m/%d/%Y"), ("dd.MM.yyyy", "%d.%m.%Y"),
    ("dd-MM-yyyy", "%d-%m-%Y"), ("yyyy/MM/dd", "%Y/%m/%d"),
)
TIMES = (
    ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"), ("yyyy-MM-dd'T'HH:mm:ss", "%Y-%m-%dT%H:%M:%S"),
    ("dd/MM/yyyy HH:mm:ss", "%d/%m/%Y %H:%M:%S"), ("dd/MM/yyyy HH:mm", "%d/%m/%Y %H:%M"),
)
INTEGER = re.compile(r"[+-]?(?:0|[1-9][0-9]{0,17})")  # a leading zero makes a code, not a number
NUMBER = re.compile(r"[+-]?(?:0|[1-9][0-9]*)?(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?")
COMMA_NUMBER = re.compile(r"[+-]?(?:0|[1-9][0-9]*),[0-9]+")
CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class ColumnType:
    """A column's type and, for dates and timestamps, the pattern of its values."""

    name: str
    pattern: str | None = None


@dataclass(frozen=True)
class Dialect:
    sep: str
    quote: str
    header: bool
    encoding: str
    multiline: bool
    columns: tuple[str, ...]
    types: tuple[ColumnType, ...]


class UnreadableSample(ValueError):
    """No file, or one without any record."""


def sample_of(spark: SparkSession, path: str, size: int = SAMPLE_BYTES) -> tuple[bytes, bool]:
    """The first bytes of the first data file at ``path``, and whether they are all there is."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(root)
    if not found:
        raise UnreadableSample(f"no file at {path}")
    files, folders = [], list(found)
    while folders:
        status = folders.pop()
        name = status.getPath().getName()
        if status.isDirectory():
            folders += [s for s in fs.listStatus(status.getPath()) if s.getPath().getName()[0] not in "._"]
        elif status.getLen():
            files.append((name, status))
    if not files:
        raise UnreadableSample(f"no data at {path}")
    files.sort(key=lambda f: f[1].getPath().toString())
    status = files[0][1]
    stream = fs.open(status.getPath())
    try:
        head = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, int(min(size, status.getLen()))))
    finally:
        stream.close()
    return head, len(files) == 1 and status.getLen() <= size


def _decoded(head: bytes, whole: bool) -> tuple[str, str]:
    """Text and encoding; a character cut off at the end does not count against UTF-8."""
    for cut in range(1 if whole else 4):
        try:
            return head[: len(head) - cut].decode("utf-8-sig"), "UTF-8"
        except UnicodeDecodeError:
            continue
    return head.decode("latin-1"), "ISO-8859-1"


def _records(text: str, sep: str, quote: str) -> list[list[str]]:
    return [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=sep, quotechar=quote) if r]


def _best(text: str, whole: bool) -> tuple[str, str, list[list[str]]]:
    """Separator, quote and records of the most consistent reading."""
    best = None
    for sep in SEPARATORS:
        for quote in QUOTES:
            records = _records(text, sep, quote)
            if not whole and len(records) > 1:
                records = records[:-1]  # the last one may be cut off
            if not records:
                continue
            width, same = Counter(map(len, records)).most_common(1)[0]
            # a value that still begins and ends with the other quote was read with the wrong one
            other = QUOTES[1 - QUOTES.index(quote)]
            wrapped = sum(len(v) > 1 and v[0] == v[-1] == other for r in records for v in r)
            score = (width > 1, same / len(records) if width > 1 else 0, -wrapped, width)
            if best is None or score > best[0]:
                best = score, sep, quote, records
    if best is None:
        raise UnreadableSample("no record in the sample")
    return best[1:]


def _fits(value: str, kind: ColumnType) -> bool:
    if kind.name == "boolean":
        return value.lower() in ("true", "false")
    if kind.name == "int":
        return bool(INTEGER.fullmatch(value)) and abs(int(value)) < 1 << 31
    if kind.name == "bigint":
        return bool(INTEGER.fullmatch(value))
    if kind.name == "double":
        pattern = COMMA_NUMBER if kind.pattern == "," else NUMBER
        return bool(pattern.fullmatch(value)) and any(c.isdigit() for c in value) or (
            kind.pattern == "," and bool(INTEGER.fullmatch(value))
        )
    if kind.name in ("date", "timestamp"):
        form = dict(DATES if kind.name == "date" else TIMES)[kind.pattern]
        try:
            return datetime.strptime(value, form).strftime(form) == value
        except ValueError:
            return False
    return True


TYPES = (
    ColumnType("boolean"), ColumnType("int"), ColumnType("bigint"), ColumnType("double"), ColumnType("double", ","),
    *(ColumnType("date", p) for p, _ in DATES), *(ColumnType("timestamp", p) for p, _ in TIMES),
)
TEXT = ColumnType("string")


def _type_of(values: list[str], whole: bool) -> ColumnType:
    seen = [v for v in values if v != ""]
    if not seen:
        return TEXT
    for kind in TYPES:
        if all(_fits(v, kind) for v in seen):
            # beyond the sample an integer may be larger than those seen
            return ColumnType("bigint") if kind.name == "int" and not whole else kind
    return TEXT


def sniff(head: bytes, whole: bool) -> Dialect:
    """The dialect of a sample; ``whole``: there is nothing beyond it."""
    text, encoding = _decoded(head, whole)
    sep, quote, records = _best(text, whole)
    width = Counter(map(len, records)).most_common(1)[0][0]
    # a preamble or a footer of other width does not decide types or names
    fitting = [r for r in records if len(r) == width]
    first, body = fitting[0], fitting[1:]
    columns = [[r[i] for r in body] for i in range(width)]
    types = [_type_of(c, whole) for c in columns]
    if all(t == TEXT for t in types):
        named = bool(body) and len(set(first)) == width and all(v and v not in c for v, c in zip(first, columns))
    else:
        named = any(t != TEXT and v != "" and not _fits(v, t) for v, t in zip(first, types)) or not body
    if named:
        names = [v.strip() or f"c{i}" for i, v in enumerate(first)]
    else:
        names = [f"c{i}" for i in range(width)]
        types = [_type_of([v, *c], whole) for v, c in zip(first, columns)]
    taken: Counter = Counter()
    unique = []
    for name in names:  # Spark compares names without case
        taken[name.lower()] += 1
        unique.append(name if taken[name.lower()] == 1 else f"{name}_{taken[name.lower()]}")
    lines = any("\n" in v for r in records for v in r)
    return Dialect(sep, quote, named, encoding, lines, tuple(unique), tuple(types))


def _typed(value: Column, kind: ColumnType) -> Column:
    if kind.name == "string":
        return value
    if kind.name == "date":
        return F.try_to_date(value, kind.pattern)
    if kind.name == "timestamp":
        return F.try_to_timestamp(value, F.lit(kind.pattern))
    return (F.translate(value, ",", ".") if kind.pattern == "," else value).try_cast(kind.name)


def read_csv(spark: SparkSession, path: str, dialect: Dialect | None = None, rejects: str | None = "_rejected") -> DataFrame:
    """A CSV file (or folder) of any dialect, typed in one read.

    ``rejects`` names the column that holds what could not be typed, null elsewhere. With
    ``rejects=None`` such a record fails the job instead.
    """
    if dialect is None:
        dialect = sniff(*sample_of(spark, path))
    schema = ", ".join(f"`_v{i}` string" for i in range(len(dialect.columns)))
    rows = (
        spark.read.schema(f"{schema}, `{CORRUPT}` string")
        .option("header", dialect.header).option("sep", dialect.sep).option("quote", dialect.quote)
        .option("escape", dialect.quote).option("encoding", dialect.encoding).option("multiLine", dialect.multiline)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    )
    values = [F.col(f"_v{i}") for i in range(len(dialect.columns))]
    typed = [_typed(v, t) for v, t in zip(values, dialect.types)]
    misfits = F.concat_ws(
        dialect.sep,
        *(
            F.when(v.isNotNull() & t.isNull(), F.concat(F.lit(f"{name}="), v))
            for v, t, name, kind in zip(values, typed, dialect.columns, dialect.types)
            if kind != TEXT
        ),
    )
    rejected = F.coalesce(F.col(CORRUPT), F.when(misfits != "", misfits))
    named = [t.alias(name) for t, name in zip(typed, dialect.columns)]
    if rejects is None:
        misfit = F.raise_error(F.concat(F.lit("a record does not fit the sample: "), rejected))
        passed = F.when(rejected.isNotNull(), misfit.cast("boolean")).otherwise(True)
        return rows.where(passed).select(*named)
    return rows.select(*named, rejected.alias(rejects))

