"""Connected components of a link table, by alternating star contractions.

Every round rewrites the whole link table on the executors: the large-star step ties the
larger neighbours of each node to its smallest neighbour, the small-star step does the
same for the smaller ones. The links shrink to stars around the smallest node of each
component in a few rounds. Only a two-number fingerprint of the table (row count and a
hash sum) reaches the driver to see that a round changed nothing. Each round is written to
the shared checkpoint folder, so lineage stays short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actuaria.llm.common import stored


def _star(links: DataFrame, keep_larger: bool) -> DataFrame:
    """One contraction; ``links`` has both directions (``u``, ``v``) of every link.

    A hub's minimum comes from an aggregate (combined on the map side) joined back, so a
    node with very many neighbours is never gathered in one place.
    """
    least = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = links.join(least, "u")
    if keep_larger:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.where(F.col("v") <= F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = least.select("u", F.col("m").alias("v"))
        moved = moved.unionByName(own)
    return moved.where(F.col("u") != F.col("v")).distinct()


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _print(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")
    ).first()
    return row["n"], row["h"]


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (``u``, ``v``: comparable, not null).

    ``root`` is the smallest node of the component. Self-links and repeated links are
    allowed; nodes without a link to another node do not appear. An empty link table
    gives an empty result.
    """
    links = stored(links.select("u", "v").where(F.col("u") != F.col("v")).distinct(), "links")
    seen = _print(links)
    while seen[0]:
        links = _star(_both_ways(links), keep_larger=True)
        links = stored(_star(_both_ways(links), keep_larger=False), "links")
        now = _print(links)
        if now == seen:
            break
        seen = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
