"""Merkle manifest against a plain walk over sorted rows."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from actuaria.llm import merkle_manifest as mm
from tests.llm.helpers import odd_rows

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    out = []
    for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"]):
        out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return sha(*out)


def climb(nodes, fan):
    """The last node and, for every first node, its (left, right) texts level by level."""
    paths = [[] for _ in nodes]
    holders = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, held = [], []
        for a in range(0, len(nodes), fan):
            run = nodes[a : a + fan]
            for j in range(len(run)):
                for leaf in holders[a + j]:
                    paths[leaf].append(("".join(run[:j]), "".join(run[j + 1 :])))
            above.append(sha(*run))
            held.append([x for h in holders[a : a + fan] for x in h])
        nodes, holders = above, held
    return (nodes[0] if nodes else None), paths


def brute(rows, fan):
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    kept, out = {}, []
    for s in order:
        placed = sorted(groups[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
        kept[s] = placed, *climb([plain_leaf(r) for r in placed], fan)
    root, tops = climb([kept[s][1] for s in order], fan)
    for s, top in zip(order, tops):
        placed, subroot, paths = kept[s]
        for i, (r, path) in enumerate(zip(placed, paths)):
            out.append((r["doc_id"], plain_leaf(r), i, subroot, root, tuple(path + top)))
    return out


def rows_of(found):
    return [
        (r["doc_id"], r["leaf"], r["position"], r["subroot"], r["root"], tuple((s["left"], s["right"]) for s in r["path"]))
        for r in found.collect()
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def sample(n, sources):
    return [(i * 7 % n, f"Text {i}", "en", sources[i % len(sources)], i) for i in range(n)]


@pytest.mark.parametrize("n, fan", [(1, 16), (2, 2), (9, 2), (17, 16), (33, 3), (90, 16)])
def test_sizes(spark, n, fan):
    docs = frame(spark, sample(n, ["a", None, "b", "a", "a", "Ä", ""]))
    assert sorted(rows_of(mm.manifest(docs, fan=fan)), key=str) == sorted(brute(docs.collect(), fan), key=str)


def test_a_hot_source_over_many_ranges_and_many_sources(spark):
    rows = sample(900, ["hot"]) + [(i, None, None, f"s{i}", None) for i in range(40)] + [(5, "same", "en", "hot", 4)] * 400
    docs = frame(spark, rows).repartition(7)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = rows_of(mm.manifest(docs, fan=4))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sorted(found, key=str) == sorted(brute(docs.collect(), 4), key=str)


def test_odd_rows_extra_columns_and_an_empty_table(spark):
    rows = [(i, t, "en" if i else None, None if (i or 0) % 2 else "s", len(t or "")) for i, t in odd_rows()]
    docs = frame(spark, rows)
    want = sorted(brute(docs.collect(), 16), key=str)
    assert sorted(rows_of(mm.manifest(docs)), key=str) == want
    clashing = ["g", "o", "pos", "n", "run", "digest", "path", "id", "part", "salt", "also0", "leaf", "root"]
    wide = docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(clashing)))
    assert sorted(rows_of(mm.manifest(wide)), key=str) == want
    assert mm.manifest(docs.limit(0)).collect() == []


def test_a_change_breaks_the_fold_and_only_there(spark):
    docs = frame(spark, sample(40, ["a", "b"]))
    other = [F.col(c) if c != "text" else F.upper("text") for c in mm.FIELDS]
    seen = F.when(F.col("doc_id") % 3 == 0, mm.leaf_digest(other))
    found = mm.manifest(docs, also={"seen": seen}).withColumn("back", mm.folded(F.coalesce("seen", "leaf"), F.col("path")))
    for r in found.collect():
        assert (r["back"] == r["root"]) == (r["doc_id"] % 3 != 0)
        node = r["seen"] or r["leaf"]
        for s in r["path"]:
            node = sha(s["left"], node, s["right"])
        assert node == r["back"]
