"""Readers for the driver's parquet tables and explicit raw-layer schemas."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


# Declared schemas of the driver tables this library reads. Reading with a declared
# schema skips the footer-inference job each ``spark.read.parquet`` call would run.
DRIVER_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Catalyst prunes the columns and pushes filters into the scan."""
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(table_path(sf_dir, name))


# Raw-layer schemas (explicit, so that a production read never infers types).
RAW_POLICIES_SCHEMA = T.StructType(
    [
        T.StructField("policy_id", T.StringType()),
        T.StructField("lob", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("insured_age", T.IntegerType()),
        T.StructField("inception_date", T.DateType()),
        T.StructField("expiry_date", T.DateType()),
        T.StructField("annual_premium", T.DecimalType(12, 2)),
        T.StructField("status", T.StringType()),
        T.StructField("channel", T.StringType()),
    ]
)

RAW_CLAIMS_SCHEMA = T.StructType(
    [
        T.StructField("claim_id", T.StringType()),
        T.StructField("policy_id", T.StringType()),
        T.StructField("lob", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("claim_date", T.DateType()),
        T.StructField("reporting_date", T.DateType()),
        T.StructField("ultimate_cost", T.DecimalType(15, 2)),
        T.StructField("reserve", T.DecimalType(15, 2)),
        T.StructField("paid_amount", T.DecimalType(15, 2)),
        T.StructField("status", T.StringType()),
        T.StructField("claim_type", T.StringType()),
    ]
)

RAW_CONTRACTS_SCHEMA = T.StructType(
    [
        T.StructField("contract_id", T.StringType()),
        T.StructField("lob", T.StringType()),
        T.StructField("treaty_type", T.StringType()),
        T.StructField("retention", T.DoubleType()),
        T.StructField("limit", T.DoubleType()),
        T.StructField("reinstatements", T.DoubleType()),
        T.StructField("premium_rate", T.DoubleType()),
        T.StructField("effective_date", T.StringType()),
        T.StructField("expiry_date", T.StringType()),
    ]
)
