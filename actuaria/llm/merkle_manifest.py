"""Merkle manifest of a dataset by lag and lead windows, in DataFrame functions only.

Every row is a leaf: the SHA-256 of its fields, each written with its length. Per group
(``source``) the leaves stand in order; every ``FAN`` consecutive nodes become one parent until
one node, the *subroot*, remains, and the subroots become the one *root* alike.

*Positions.* The leaves are dealt by range of (group, order, leaf) and numbered within each
range; the counts of the ranges, one row for each range and group, shift the numbers to positions in the group.
A group, an order value or copies of one row that hold a third of all rows are spread over
many ranges (a last sort key parts even equal rows), so no task numbers a whole group.

*Levels.* Per level, lag and lead columns of fixed offsets hold a node's siblings, masked by
the node's slot in its run and the length of the run; the rows of first children hash their
parents. A window holds one run, at most ``FAN`` rows. Only digests are shuffled, never texts.

*Proofs.* From the root downwards each node takes the path of its parent, joined on the run, and
puts its own siblings before it: the path of a leaf is what :func:`folded` needs to compute the
root again. All nodes but the leaves are a fifteenth of the leaves, and paths grow with the logarithm.

Defined results: a null field is written ``-``; rows of one group and order value (null first) stand in order of
their leaves, and equal rows have equal leaves; a null group is a group and comes first; a lone
leaf is its group's subroot and a lone subroot the root; an empty table has no rows and no root;
very long texts are hashed whole; columns that are no field are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actuaria.llm.common import stored

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def digest(*inputs: Column) -> Column:
    """Lowercase hex SHA-256 of the inputs, concatenated."""
    return F.sha2(F.concat(*inputs), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: list[Column]) -> Column:
    return digest(*(field(v) for v in values))


def _ordered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with pos (from 0) and n (number of rows) within their group ``g``, by ``keys``."""
    salt = "salt"  # parts equal rows, whose order among themselves changes nothing
    spread = rows.withColumn(salt, F.monotonically_increasing_id()).repartitionByRange("g", *keys, salt)
    # the id of a row: the number of its range in the upper bits, its place there in the lower 33
    placed = spread.sortWithinPartitions("g", *keys, salt).drop(salt).withColumn("id", F.monotonically_increasing_id())
    placed = stored(placed.withColumn("part", F.shiftright("id", 33)), "placed")
    earlier = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("g", "part").agg(F.min("id").alias("first"), F.count("*").alias("rows"))
    shifts = stored(
        parts.select(
            "g", "part", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
            F.sum("rows").over(Window.partitionBy("g")).alias("n"),
        ),
        "shifts",
    )
    return placed.join(shifts, ["g", "part"]).withColumn("pos", F.col("id") + F.col("shift")).drop("id", "part", "shift")


def _runs(nodes: DataFrame, fan: int) -> tuple[DataFrame, Column, list[Column], list[Column]]:
    """Nodes of unfinished groups with run; their digests before and after them in the run.

    The lists hold the columns of offsets 1 to ``fan`` - 1, null where the offset leaves the run.
    """
    of = nodes.where(F.col("n") > 1).withColumn("run", F.expr(f"pos div {fan}"))
    slot = F.col("pos") % fan
    length = F.least(F.lit(fan), F.col("n") - F.col("run") * fan)
    window = Window.partitionBy("g", "run").orderBy("pos")
    before = [F.when(slot >= i, F.lag("digest", i).over(window)) for i in range(1, fan)]
    after = [F.when(slot + i < length, F.lead("digest", i).over(window)) for i in range(1, fan)]
    return of, slot, before, after


def _joined(digests: list[Column]) -> Column:
    return F.concat_ws("", *digests)  # leaves nulls out


def _parents(nodes: DataFrame, fan: int) -> DataFrame:
    of, slot, _, after = _runs(nodes.select("g", "pos", "n", "digest"), fan)
    above = of.select(
        "g", slot.alias("slot"), F.col("run").alias("pos"), F.expr(f"(n + {fan - 1}) div {fan}").alias("n"),
        digest(F.col("digest"), _joined(after)).alias("digest"),
    )
    return above.where(F.col("slot") == 0).drop("slot")


def _levels(nodes: DataFrame, fan: int) -> list[DataFrame]:
    """The nodes (g, pos, n, digest) of every level, leaves first; the last level's groups are all finished."""
    levels = [nodes]
    largest = nodes.agg(F.max("n")).first()[0] or 0
    while largest > 1:
        levels.append(stored(_parents(levels[-1], fan), "nodes"))
        largest = -(-largest // fan)
    return levels


def _finished(levels: list[DataFrame]) -> DataFrame:
    """(g, digest) of the last node of every group."""
    done = [level.where(F.col("n") == 1).select("g", "digest") for level in levels]
    return reduce(DataFrame.unionByName, done)


def _with_paths(levels: list[DataFrame], tops: DataFrame, fan: int) -> DataFrame:
    """The first level with the path of each node to the root and its group's ``subroot``.

    ``tops`` has the path (of the last node) and the subroot of every group ``g``.
    """
    above = None
    for level in reversed(levels):
        ready = level.where(F.col("n") == 1).join(tops, "g")
        if above is not None:
            of, _, before, after = _runs(level, fan)
            own = of.withColumn("own", F.struct(_joined(before[::-1]).alias("left"), _joined(after).alias("right")))
            parent = above.select("g", F.col("pos").alias("run"), "path", "subroot")
            climbed = own.join(parent, ["g", "run"]).withColumn("path", F.concat(F.array("own"), "path"))
            ready = ready.unionByName(climbed.drop("own", "run"))
        above = ready
    return above


def manifest(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "source", order: str = "doc_id",
    also: dict[str, Column] | None = None, fan: int = FAN,
) -> DataFrame:
    """``order``, leaf, position (in the group), subroot, root and path of every row.

    ``path`` holds, level by level, the concatenated digests before and after the node in its
    run. ``also`` names further columns computed from ``docs`` in the same scan (such as the
    leaf of another version of the row); ``fields`` are those of the leaf, in order.
    """
    also = also or {}
    names = {name: f"also{i}" for i, name in enumerate(also)}
    rows = docs.select(
        F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group).cast("string"))).alias("g"),
        F.col(order).alias("o"), leaf_digest([F.col(f) for f in fields]).alias("digest"),
        *(also[name].alias(plain) for name, plain in names.items()),
    )
    # stored first: dealing by range looks at the rows twice, and the texts should be read once
    levels = _levels(_ordered(stored(rows, "leaves"), ["o", "digest"]), fan)
    subroots = stored(_finished(levels), "subroots").withColumnRenamed("digest", "subroot")
    upper = _levels(_ordered(subroots.select(F.lit("").alias("g"), F.col("g").alias("of"), F.col("subroot").alias("digest")), ["of"]), fan)
    last = _finished(upper).first()
    start = upper[0].sparkSession.range(1).select(
        F.lit("").alias("g"), F.expr(f"cast(array() as {PATH})").alias("path"), F.lit("").alias("subroot")
    )
    tops = _with_paths(upper, start, fan).select(F.col("of").alias("g"), "path", F.col("digest").alias("subroot"))
    tops = stored(tops, "tops")
    return _with_paths(levels, tops, fan).select(
        F.col("o").alias(order), F.col("digest").alias("leaf"), F.col("pos").alias("position"), "subroot",
        F.lit(last["digest"] if last else None).cast("string").alias("root"), "path",
        *(F.col(plain).alias(name) for name, plain in names.items()),
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, from the leaf's level to the root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)
