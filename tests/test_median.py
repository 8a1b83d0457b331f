"""The radix-select median against a brute-force median (NumPy) on random groups."""

import random
from decimal import Decimal

import numpy as np
from pyspark.sql import functions as F

from actuaria.operators.median import exact_median


def brute(rows):
    groups = {}
    for k1, k2, v in rows:
        if v is not None:
            groups.setdefault((k1, k2), []).append(int(Decimal(v) * 100))
    out = {}
    for key, vals in groups.items():
        vals.sort()
        n = len(vals)
        lo, hi = vals[(n - 1) // 2], vals[n // 2]
        out[key] = Decimal(lo + hi) / Decimal(200)
    return out


def test_exact_median_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    # one hot group with a third of the rows, many duplicates and a wide range
    for _ in range(3000):
        rows.append(("hot", 1, f"{rnd.choice([0, 1, 5, 99999999, rnd.randint(0, 10**12)]) / 100:.2f}"))
    for g in range(200):
        for _ in range(rnd.randint(1, 30)):
            v = rnd.choice([None, f"{rnd.randint(-10**9, 10**9) / 100:.2f}", "-0.01", "0.00", "123.45"])
            rows.append((None if g % 17 == 0 else f"g{g % 40}", g % 3 if g % 11 else None, v))
    df = spark.createDataFrame(rows, "k1 string, k2 int, v string").withColumn("v", F.col("v").cast("decimal(15,2)"))
    got = {(r.k1, r.k2): r.median for r in exact_median(df, ["k1", "k2"], "v").collect()}
    want = brute(rows)
    assert got == want


def test_exact_median_single_value_and_pairs(spark):
    df = spark.createDataFrame(
        [("a", Decimal("5.00")), ("b", Decimal("1.00")), ("b", Decimal("2.00")), ("c", Decimal("7.00")), ("c", Decimal("7.00"))],
        "k string, v decimal(15,2)",
    )
    got = {r.k: r.median for r in exact_median(df, ["k"], "v").collect()}
    assert got == {"a": Decimal("5.000"), "b": Decimal("1.500"), "c": Decimal("7.000")}
    assert np.isclose(float(got["b"]), 1.5)


def test_rows_are_not_shuffled_for_the_join_with_a_small_state(spark):
    """The state is a written table of known size when the second pass is planned."""
    df = spark.range(0, 30_001, 1, 3).selectExpr("id % 3 as k", "cast((id * 7919 % 30011) * 11.11 as decimal(15,2)) as v")
    median = exact_median(df, ["k"], "v")
    got = {r.k: r.median for r in median.collect()}
    plan = median._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    rows = [(str(r.k), None, str(r.v)) for r in df.collect()]
    assert {(str(k), None): v for k, v in got.items()} == brute(rows)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

cents = st.integers(min_value=-(10**13) + 1, max_value=10**13 - 1)
groups = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2]), st.one_of(st.none(), cents)),
                  min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=groups)
def test_exact_median_property(spark, rows):
    data = [(k1, k2, None if v is None else f"{Decimal(v) / 100:.2f}") for k1, k2, v in rows]
    df = spark.createDataFrame(data, "k1 string, k2 int, v string").withColumn("v", F.col("v").cast("decimal(15,2)"))
    got = {(r.k1, r.k2): r.median for r in exact_median(df, ["k1", "k2"], "v").collect()}
    assert got == brute(data)
