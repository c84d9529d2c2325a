"""The queries of this folder and the SQL they have to agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import (
    bpe,
    fingerprints,
    lexical,
    licenses,
    line_dedup,
    mixing,
    negatives,
    neighbors,
    scoring,
    secrets,
    simhash,
    suffixes,
    toxicity,
)
from .common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.copies(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    taken = F.col("size") * F.col("n_copies")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = secrets.spans_text("spans", secrets.KINDS[:3])

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(k) for k in secrets.KINDS],
        F.sha2(base, 256).alias("base_sha256"),
        secrets.spans_text("spans").alias("spans"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, read(spark, sf_dir, "labels")).drop("text")
    predicted = F.when(F.col("score") >= toxicity.REJECT, 1).otherwise(0)
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", predicted.alias("predicted"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.code(read(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.by_document(licenses.scan(read(spark, sf_dir, "documents").select("doc_id", "text")))


def op8_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbors.search(rows, F.col("vec_id") % 20 == 0)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "fingerprint", "component_id")


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffixes.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.search(docs, read(spark, sf_dir, "benchmark").select("item_id", "text"))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", scoring.is_held_out().alias("held_out"))
    return scoring.score(docs)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES["op1_mixing"] = op1_mixing
ORACLES["op1_mixing"] = mixing.SQL
QUERIES["op2_line_dedup"] = op2_line_dedup
ORACLES["op2_line_dedup"] = line_dedup.SQL
QUERIES["op3_secrets"] = op3_secrets
QUERIES["op4_toxicity"] = op4_toxicity
QUERIES["op5_fingerprints"] = op5_fingerprints
QUERIES["op6_bpe"] = op6_bpe
QUERIES["op7_licenses"] = op7_licenses
ORACLES["op7_licenses"] = licenses.SQL
QUERIES["op8_neighbors"] = op8_neighbors
QUERIES["op9_simhash"] = op9_simhash
QUERIES["op10_suffixes"] = op10_suffixes
ORACLES["op10_suffixes"] = suffixes.SQL
QUERIES["op11_negatives"] = op11_negatives
ORACLES["op11_negatives"] = negatives.SQL
QUERIES["op12_lexical"] = op12_lexical
ORACLES["op12_lexical"] = lexical.SQL
QUERIES["op13_lm_scoring"] = op13_lm_scoring
QUERIES["pipeline"] = pipeline
