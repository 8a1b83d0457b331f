"""The raw insurance layer, derived from the driver's TPC-H-like tables.

The mapping is deterministic (no randomness) and contains dirty rows on purpose so
that every staging filter removes something:

* ``raw_policies``  one row per order (orders ⋈ customer ⋈ nation ⋈ region)
* ``raw_claims``    every lineitem row, joined to its order
* ``raw_contracts`` three reinsurance treaties (a constant dimension)
* ``accident_files`` header / lieux / usagers / vehicules road-accident frames

Plan notes: ``orders ⋈ customer`` is the one large-large join (sort-merge on the
customer key); ``nation`` and ``region`` are fixed 25- and 5-row dimensions that the
planner broadcasts from their measured size. Claims join that order base on the
order key. No Python code runs per row.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actuaria.functions.formatting import padded_key
from actuaria.sources.tables import RAW_CONTRACTS_SCHEMA, read_table

# ---- fixed values: the three reinsurance treaties -------------------------------
CONTRACT_ROWS = [
    ("XL-AUTO-2023", "Auto", "Excess of Loss", 100000.0, 500000.0, 2.0, 0.045, "1995-01-01", "1998-12-31"),
    ("XL-HOME-2023", "Home", "Excess of Loss", 250000.0, 2000000.0, 1.0, 0.032, "1995-01-01", "1999-12-31"),
    ("QUOTA-LIAB-2023", "Liability", "Quota Share", 0.70, None, None, 0.30, "1996-01-01", "2000-12-31"),
]
# ---- fixed values: mapping parameters (FIXTURES.md §2) --------------------------
POLICY_STATUS_CUTOFF = "2000-12-31"
CHANNEL_BY_PRIORITY = {
    "1-URGENT": "Direct",
    "2-HIGH": "Broker",
    "3-MEDIUM": "Broker",
    "4-NOT SPECIFIED": "Online",
}
REGION_NAMES = {
    "AFRICA": "Île-de-France",
    "AMERICA": "Occitanie",
    "ASIA": "Bretagne",
    "EUROPE": "Grand Est",
    "MIDDLE EAST": "Hauts-de-France",
}
CLAIM_TYPE_BY_LINE = {
    1: "Material",
    2: "Material",
    6: "Material",
    3: "Bodily Injury",
    7: "Bodily Injury",
    4: "Theft",
    5: "Natural Disaster",
}
# ---------------------------------------------------------------------------------


def _dec(value: str, precision: int, scale: int) -> Column:
    return F.lit(Decimal(value)).cast(f"decimal({precision},{scale})")


def region_name(region: Column) -> Column:
    """The insurance region a driver region stands for (others keep their name)."""
    out = region
    for source, name in REGION_NAMES.items():
        out = F.when(region == source, name).otherwise(out)
    return out


def lob_of(orderkey: Column) -> Column:
    """``orderkey % 20``: 0-8 Auto, 9-14 Home, 15-17 Liability, 18-19 Health."""
    m = orderkey % 20
    return (
        F.when(m <= 8, "Auto").when(m <= 14, "Home").when(m <= 17, "Liability").otherwise("Health")
    )


def order_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders ⋈ customer ⋈ nation ⋈ region, keeping what policies and claims need."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", region_name(F.col("r_name")).alias("r_name")
    )
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(geo, customer.c_nationkey == geo.n_nationkey)
        .select(
            "o_orderkey",
            "c_custkey",
            "o_totalprice",
            "o_orderpriority",
            F.col("o_orderdate").cast("date").alias("order_date"),
            "r_name",
        )
    )


def raw_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    ob = order_base(spark, sf_dir)
    key = F.col("o_orderkey")
    inception = F.col("order_date")
    premium = (F.col("o_totalprice").cast("decimal(15,2)") * _dec("0.01", 4, 2)).cast(
        "decimal(12,2)"
    )
    channel = F.lit("Agent")
    for priority, name in reversed(list(CHANNEL_BY_PRIORITY.items())):
        channel = F.when(F.col("o_orderpriority") == priority, name).otherwise(channel)
    return ob.select(
        F.when(key % 997 == 5, F.lit(None).cast("string"))
        .otherwise(padded_key("POL", key, 9))
        .alias("policy_id"),
        lob_of(key).alias("lob"),
        F.col("r_name").alias("region"),
        F.when(F.col("c_custkey") % 101 == 7, F.lit(None).cast("int"))
        .otherwise((F.lit(18) + F.col("c_custkey") % 57).cast("int"))
        .alias("insured_age"),
        inception.alias("inception_date"),
        F.when(key % 499 == 1, inception).otherwise(F.date_add(inception, 365)).alias("expiry_date"),
        F.when(key % 503 == 2, _dec("0", 12, 2)).otherwise(premium).alias("annual_premium"),
        F.when(F.date_add(inception, 365) > F.lit(POLICY_STATUS_CUTOFF).cast("date"), "ACTIVE")
        .otherwise("expired")
        .alias("status"),
        channel.alias("channel"),
    )


def raw_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
    )
    ob = order_base(spark, sf_dir).select("o_orderkey", "order_date", "r_name")
    joined = lineitem.join(ob, lineitem.l_orderkey == ob.o_orderkey)

    price = F.col("l_extendedprice").cast("decimal(15,2)")
    qty = F.col("l_quantity")
    factor = (
        F.when(qty == 50, _dec("2.00", 4, 2))
        .when(qty >= 45, _dec("0.25", 4, 2))
        .otherwise(_dec("0.02", 4, 2))
    )
    flag = F.col("l_returnflag")
    paid_share = (
        F.when(flag == "N", _dec("0", 4, 2))
        .when(flag == "R", _dec("0.95", 4, 2))
        .otherwise((F.col("l_discount") * F.lit(11)).cast("decimal(4,2)"))
    )
    reserve_share = (F.lit(0.80) + F.col("l_tax")).cast("decimal(4,2)")
    claim_date = F.date_add(
        F.col("order_date"),
        ((F.col("l_partkey") * 7 + F.col("l_linenumber") * 31) % 365).cast("int"),
    )
    lag = (
        F.lit(1)
        + (F.col("l_suppkey") * 13 + F.col("l_linenumber") * 5 + F.col("l_orderkey")) % 45
    ).cast("int")
    claim_type = F.lit(None).cast("string")
    for line, name in CLAIM_TYPE_BY_LINE.items():
        claim_type = F.when(F.col("l_linenumber") == line, name).otherwise(claim_type)
    parts = [
        padded_key("CLM", F.col("l_orderkey"), 9),
        F.col("l_linenumber").cast("string"),
        F.col("l_partkey").cast("string"),
        F.col("l_suppkey").cast("string"),
        F.round(F.col("l_extendedprice") * F.lit(100)).cast("bigint").cast("string"),
    ]
    claim_id = F.concat(*[x for p in parts for x in (F.lit("-"), p)][1:])
    # dirty rows, so that each check on claims meets failures
    order_part, part_supp = F.col("l_orderkey") + F.col("l_partkey"), F.col("l_partkey") + F.col("l_suppkey")
    claim_id = (
        F.when(order_part % 1499 == 7, F.lit(None).cast("string"))
        .when(order_part % 1013 == 9, "CLM-SHARED")
        .otherwise(claim_id)
    )
    lag = F.when(order_part % 983 == 5, F.lit(-2)).otherwise(lag)
    paid = F.when(part_supp % 1009 == 11, _dec("-1.00", 15, 2)).otherwise(
        (price * factor * paid_share).cast("decimal(15,2)")
    )
    return joined.select(
        claim_id.alias("claim_id"),
        padded_key("POL", F.col("o_orderkey"), 9).alias("policy_id"),
        lob_of(F.col("o_orderkey")).alias("lob"),
        F.col("r_name").alias("region"),
        claim_date.alias("claim_date"),
        F.date_add(claim_date, lag).alias("reporting_date"),
        (price * factor).cast("decimal(15,2)").alias("ultimate_cost"),
        (price * factor * reserve_share).cast("decimal(15,2)").alias("reserve"),
        paid.alias("paid_amount"),
        F.when(flag == "R", "CLOSED").otherwise("open").alias("status"),
        claim_type.alias("claim_type"),
    )


def raw_contracts(spark: SparkSession) -> DataFrame:
    """The treaty dimension (three rows; reinstatements and limit may be NULL)."""
    return spark.createDataFrame(CONTRACT_ROWS, RAW_CONTRACTS_SCHEMA)


def accident_files(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four road-accident files, keyed by kind, built from orders and lineitem.

    ``com`` (commune) is deliberately absent: the enrichment must cope with it.
    """
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lineitem = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    key, cust, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate").cast("date")
    header = orders.select(
        key.alias("Num_Acc"),
        F.year(day).alias("an"),
        F.month(day).alias("mois"),
        F.dayofmonth(day).alias("jour"),
        F.concat(
            F.lpad((key % 24).cast("string"), 2, "0"),
            F.lit(":"),
            F.lpad(((key * 7) % 60).cast("string"), 2, "0"),
        ).alias("hrmn"),
        (cust % 95 + 1).cast("string").alias("dep"),
        (key % 9 + 1).cast("int").alias("atm"),
        (key % 5 + 1).cast("int").alias("lum"),
    )
    # one place per line item: accidents on several roads repeat, orders without line
    # items have no place
    lieux = lineitem.select(
        F.col("l_orderkey").alias("Num_Acc"),
        (F.col("l_partkey") % 9 + 1).cast("int").alias("catr"),
        (F.col("l_partkey") % 8 + 1).cast("int").alias("surf"),
    )
    usagers = lineitem.select(
        F.col("l_orderkey").alias("Num_Acc"), (F.col("l_suppkey") % 4 + 1).cast("int").alias("grav")
    )
    vehicules = lineitem.select(F.col("l_orderkey").alias("Num_Acc"))
    return {"caract": header, "lieux": lieux, "usag": usagers, "vehic": vehicules}
