"""Segment states: rolled up, they equal the aggregates over all rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from actuaria.operators import segments
from actuaria.plans.registry import Layers
from tests.conftest import SF_SMALL


def test_states_roll_up_to_any_grain(spark):
    layers = Layers(spark, SF_SMALL)
    state = segments.claims_state(layers.enriched)
    for keys in (["line_of_business", "accident_year"], ["claim_type"], []):
        rolled = segments.rolled_up(state, keys)
        direct = segments.measures_of(layers.enriched, keys)
        assert rolled.columns == direct.columns
        assert sorted(map(str, rolled.collect())) == sorted(map(str, direct.collect()))
    policies = segments.policies_state(layers.stg_policies)
    rolled = segments.rolled_up(policies, ["region"]).select("region", "policy_count", "premium_sum", "premium_min", "premium_max")
    p = F.col("annual_premium_eur")
    direct = layers.stg_policies.groupBy("region").agg(F.count("policy_id"), F.sum(p), F.min(p), F.max(p))
    assert sorted(map(str, map(tuple, rolled.collect()))) == sorted(map(str, map(tuple, direct.collect())))


def claims(spark, n, policies):
    rnd = random.Random(n)
    rows = [
        (rnd.choice(["auto", "home", None]), rnd.choice(["N", "S", None]), dt.date(2019 + rnd.randrange(4), 5, 1),
         None if rnd.random() < 0.02 else f"P{rnd.randrange(policies)}")
        for _ in range(n)
    ]
    rows += [("auto", "N", dt.date(2020, 1, 1), "P-hot")] * n  # half of all claims
    return spark.createDataFrame(rows, "line_of_business string, region string, claim_date date, policy_id string")


def test_distinct_policies_are_exact_at_every_grain(spark):
    every = claims(spark, 6000, 1500).repartition(6)
    stored = segments.policy_bitmaps(every).cache()
    year = every.withColumn("accident_year", F.year("claim_date"))
    for keys in (segments.SEEN_KEYS, ["region"], ["line_of_business", "accident_year"], []):
        got = segments.distinct_policies(stored, keys)
        want = year.where("policy_id is not null").groupBy(*keys).agg(F.countDistinct("policy_id").alias("policy_count"))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), keys
    stored.unpersist()


def test_bitmaps_of_many_policies_and_of_none(spark):
    """More policies than one bitmap holds; numbers are dense, so two bitmaps a segment are enough."""
    many = spark.range(50_000).selectExpr(
        "'auto' as line_of_business", "'N' as region", "date'2020-01-01' as claim_date", "concat('Q', id * 7919) as policy_id"
    )
    state = segments.policy_bitmaps(many)
    assert state.count() == 2 and segments.distinct_policies(state, []).first()[0] == 50_000
    assert segments.policy_bitmaps(many.limit(0)).count() == 0
