"""Registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actuaria.llm import (
    bpe_codec, centroid_search, decontaminate, line_templates, merkle_manifest, pii_sanitise, repeated_passages,
    secret_scan, simhash_dedup, token_packing, token_transducer, topk_search, toxicity,
)
from actuaria.llm.common import read_documents, read_input
from actuaria.session import scratch_path


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """A vocabulary file of the installed tokenizer package."""
    return public_tokenizers.path(name)


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(read_input(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = read_documents(spark, sf_dir), toxicity.held_out()
    trigrams = secret_scan.dictionary_trigrams(docs)
    # a third of the documents never trains the forest, so that its findings there can be judged
    findings = secret_scan.rule_labels(secret_scan.candidates(docs.where(~held_out), "source"))
    model = secret_scan.train(findings, trigrams)
    kept = secret_scan.scan(docs, "source", model)
    return kept.select(
        "doc_id", held_out.alias("held_out"), "at", "path", F.sha2("value", 256).alias("value_sha256"), "score"
    )


def op3_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe_codec.load_vocabulary(vocabulary_path())
    packed = token_packing.pack_documents(read_documents(spark, sf_dir), vocabulary)
    rows = token_packing.write_packed(packed, scratch_path(spark, f"llm-packed-{uuid.uuid4().hex}"))
    return rows.select(  # of the rows as they were written
        "doc_ids", "pieces", "offsets", "cu_seqlens", "position_resets", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
    )


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(read_documents(spark, sf_dir))


def bpe_digests(docs: DataFrame) -> DataFrame:
    done = bpe_codec.round_trip(docs, vocabulary_path())
    return done.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256")
    )


def op5_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicate_groups(read_documents(spark, sf_dir))


def op6_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    docs = docs.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long"))
    cleaned = line_templates.drop_recurring_lines(docs, column="n_dropped")
    return cleaned.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    model = toxicity.fit(docs, read_input(spark, sf_dir, "labels"), ~toxicity.held_out())
    scored = toxicity.with_score(docs.select("doc_id", "text"), model, "score")
    return scored.select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = repeated_passages.remove_recurring(read_documents(spark, sf_dir))
    return done.select(
        "doc_id", "n_words", "n_removed",
        F.when(F.col("kept").isNull(), F.col("whole_sha")).otherwise(F.sha2("kept", 256)).alias("kept_sha256"),
    )


def op9_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_sanitise.span_digests(pii_sanitise.private_spans(read_documents(spark, sf_dir)))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read_documents(spark, sf_dir), read_input(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_search.clusters(read_input(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    lowered = F.translate("text", decontaminate.UPPER, decontaminate.LOWER)
    other = [lowered if name == "text" else F.col(name) for name in merkle_manifest.FIELDS]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, merkle_manifest.leaf_digest(other))
    found = merkle_manifest.manifest(docs, also={"tampered": tampered})
    back = merkle_manifest.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle_manifest.proof_digest(F.col("path")).alias("proof_sha256"),
        back.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_transducer.count_tokens(read_documents(spark, sf_dir), vocabulary_path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


QUERIES = {
    "op2_secret_scan": op2_secret_scan,
    "op1_topk_search": op1_topk_search,
    "op3_token_packing": op3_token_packing,
    "op4_bpe_codec": op4_bpe_codec,
    "op5_simhash_groups": op5_simhash_groups,
    "op6_line_templates": op6_line_templates,
    "op7_toxicity": op7_toxicity,
    "op8_repeated_passages": op8_repeated_passages,
    "op9_private_data": op9_private_data,
    "op10_decontamination": op10_decontamination,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_token_counts": op13_token_counts,
}
