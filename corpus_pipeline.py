"""The corpus pipeline: five stages over the documents table, each one operator.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and
read again as the next stage's documents. The first four return the columns of
documents; the last returns one row of token counts and digests per document.

Defined results follow the operators: null texts are kept through the filters (a null text
has no toxic word, no line and no benchmark window; in near-duplicate search it is a
text without words), an empty table stays empty, and extra columns pass through to the
last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actuaria.llm import decontaminate, line_templates, simhash_dedup, toxicity
from actuaria.llm.common import read_documents, read_input, stored
from actuaria.llm.queries import bpe_digests


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under the toxicity threshold; the model learns from the labels."""
    model = toxicity.fit(docs, read_input(spark, sf_dir, "labels"), ~toxicity.held_out())
    return toxicity.drop_toxic(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of recurring templates; ``n_chars`` follows the text."""
    cleaned = line_templates.drop_recurring_lines(docs)
    if "n_chars" not in docs.columns:
        return cleaned
    kind = docs.schema["n_chars"].dataType
    return cleaned.withColumn(
        "n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars"))
    )


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash_dedup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark."""
    return decontaminate.decontaminate(docs, read_input(spark, sf_dir, "benchmark"), remove="documents")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and the decoded text of every document."""
    return bpe_digests(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_lines),
    ("simhash_dedup", one_of_each),
    ("decontamination", drop_contaminated),
    ("bpe_encoding", encode),
]

ORACLE_SQL = None  # hashing, a learned model and the vocabulary are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
