"""A hot key (one policy with most of the claims) under adaptive skew handling.

Thresholds are lowered so that the tiny test data counts as skewed: the result must
be unchanged and the claims ⋈ policies join must be executed as a skew join (the hot
partition split over several tasks), not as one oversized task.
"""

import contextlib
import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from actuaria.operators import intermediate, marts, quality, staging
from actuaria.sources.tables import RAW_CLAIMS_SCHEMA, RAW_POLICIES_SCHEMA

DAY = dt.date(2023, 1, 1)

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def raw_frames(spark, hot_claims=4000, cold_policies=200):
    pols = [(f"P{i}", "Auto", "R", 30, DAY, DAY + dt.timedelta(days=365), D("100.00"), "ACTIVE", "Direct")
            for i in range(cold_policies + 1)]
    clms = [(f"H{i}", "P0", "Auto", "R", DAY, DAY, D(f"{i % 997}.00"), D("0"), D("0"), "open", "Theft")
            for i in range(hot_claims)]
    clms += [(f"C{p}-{j}", f"P{p}", "Auto", "R", DAY, DAY, D("10.00"), D("0"), D("0"), "open", "Theft")
             for p in range(1, cold_policies + 1) for j in range(3)]
    return spark.createDataFrame(pols, RAW_POLICIES_SCHEMA), spark.createDataFrame(clms, RAW_CLAIMS_SCHEMA)


def frames(spark, hot_claims=4000, cold_policies=200):
    policies, claims = raw_frames(spark, hot_claims, cold_policies)
    return staging.stg_policies(policies), staging.stg_claims(claims)


def test_hot_policy_is_split_by_the_skew_join(spark):
    with conf(spark, SKEW_CONF):
        sp, sc = frames(spark)
        enriched = intermediate.claims_enriched(sc, sp)
        rows = enriched.groupBy("policy_id").count().where("policy_id = 'P0'").collect()
        assert rows[0]["count"] == 4000 and enriched.count() == 4600
        assert len(enriched.collect()) == 4600  # runs this DataFrame's own adaptive plan
        plan = enriched._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan
        assert "isSkewJoin=true" in plan or "skew=true" in plan


def test_hot_group_results_are_whole(spark):
    with conf(spark, SKEW_CONF):
        sp, sc = frames(spark)
        enriched = intermediate.claims_enriched(sc, sp)
        freq = marts.claims_frequency_mart(enriched, sp, materialize_input=False).collect()
        assert sum(r.claim_count for r in freq) == 4600
        orphans = quality.orphan_claims(sc, sp).count()
        assert orphans == 0


def test_hot_accident_is_combined_and_written_by_several_tasks(spark, tmp_path, monkeypatch):
    from actuaria.operators import accidents

    monkeypatch.setattr(accidents, "REPEATS_A_TASK", 50)
    header = spark.createDataFrame(
        [(i if i else None, 2021, 1, 1, "00:00", "75", 1, 1) for i in range(300)] + [(7, 2021, 1, 1, "00:00", "75", 1, 1)],
        "Num_Acc long, an int, mois int, jour int, hrmn string, dep string, atm int, lum int",
    )
    lieux = spark.createDataFrame(
        [(1, i % 9, None if i % 8 == 7 else i % 2) for i in range(5000)] + [(i, 1, 1) for i in range(2, 200)] + [(None, 1, 1)] * 9,
        "Num_Acc long, catr int, surf int",
    )
    usagers = spark.createDataFrame([(i % 300, 1 + i % 4) for i in range(900)] + [(999, 4)], "Num_Acc long, grav int")
    vehicules = spark.createDataFrame([(i % 250,) for i in range(500)], "Num_Acc long")
    files = []
    for name, df in (("h", header), ("l", lieux), ("u", usagers), ("v", vehicules)):
        df.write.parquet(str(tmp_path / name))
        files.append(spark.read.parquet(str(tmp_path / name)))
    with conf(spark, SKEW_CONF):
        whole = accidents.enrich_accidents(*files)
        rows = whole.collect()
        plan = whole._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        for name in ("/h]", "/l]", "/u]", "/v]"):
            assert plan.count(name) == 1, name  # each file is read once
        exchanges = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "Reused" not in x]
        assert len(exchanges) == 3  # two for the files; the one of repeated rows is nearly empty
    users = usagers.groupBy("Num_Acc").agg(F.max("grav").alias("grav"), F.count("*").alias("nb_victimes"))
    vehicles = vehicules.groupBy("Num_Acc").agg(F.count("*").alias("nb_vehicules"))
    plain = header.withColumnRenamed("an", "annee").join(lieux, "Num_Acc", "left").join(users, "Num_Acc", "left").join(vehicles, "Num_Acc", "left")
    want = plain.withColumnsRenamed(accidents.RENAME).select(*whole.columns).collect()
    assert len(rows) == 5000 + 199 + 101 and sorted(map(str, rows)) == sorted(map(str, want))


def test_counts_of_an_accident_are_one_row_and_its_number_leads_the_keys(spark, tmp_path):
    """Users and vehicles meet in one combined row; sorts and shuffles compare the number before the year."""
    from actuaria.operators import accidents

    header = spark.createDataFrame([(i, 2020 + i % 2, i % 12) for i in range(60)] + [(None, 2020, 1), (3, None, 1)],
                                   "Num_Acc long, annee int, mois int")
    lieux = spark.createDataFrame([(i % 40, 2020 + i % 2, i % 9, i % 3) for i in range(200)], "Num_Acc long, annee int, catr int, surf int")
    # accidents with users alone, with vehicles alone, with both and with neither
    users = spark.createDataFrame([(i % 20, 2020 + i % 2, None if i % 3 else i % 4) for i in range(90)], "Num_Acc long, annee int, grav int")
    vehicles = spark.createDataFrame([(10 + i % 20, 2020 + i % 2) for i in range(70)], "Num_Acc long, annee int")
    whole = accidents.enrich_accidents(header, lieux, users, vehicles)
    rows = whole.collect()
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [Num_Acc" in plan and "Aggregate [annee" not in plan
    assert "count AS _kind" in plan and "user AS _kind" not in plan and "vehicle AS _kind" not in plan
    keys = ["annee", "Num_Acc"]
    worst = users.groupBy(*keys).agg(F.max("grav").alias("grav"), F.count("*").alias("nb_victimes"))
    plain = header.join(lieux, keys, "left").join(worst, keys, "left").join(
        vehicles.groupBy(*keys).agg(F.count("*").alias("nb_vehicules")), keys, "left")
    want = plain.withColumnsRenamed(accidents.RENAME).select(*whole.columns).collect()
    assert sorted(map(str, rows)) == sorted(map(str, want))
    assert {(r.nb_victimes is None, r.nb_vehicules is None) for r in rows} == {(a, b) for a in (True, False) for b in (True, False)}


def split(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "isFinalPlan=true" in plan and ("isSkewJoin=true" in plan or "skew=true" in plan)


def test_hot_policy_is_split_in_the_queries_that_join_claims(spark):
    with conf(spark, SKEW_CONF):
        sp, sc = frames(spark)
        orphans = quality.orphan_claims(sc, sp.where("policy_id <> 'P1'"))
        assert len(orphans.collect()) == 3 and split(orphans)
        summary = intermediate.portfolio_summary(intermediate.claims_enriched(sc, sp), sc)
        rows = summary.collect()
        assert rows[0].claim_count == 4600 and rows[0].policy_count == 201 and split(summary)
        plan = summary._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("policy_id") and plan.count("skew=true") == 1  # one claims-policies join
