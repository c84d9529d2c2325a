"""A corpus pipeline of five stages: each works on all that its predecessor kept, written as Parquet and read again.

toxicity (rejected documents go), line dedup (repeated lines go), SimHash near-dedup (one document of each group stays),
mixing sources to target weights (documents are repeated or thinned), BPE encoding and decoding (token ids).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import bpe, line_dedup, mixing, simhash, toxicity
from feedloom.llm.common import read
from feedloom.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = "byte_bpe_50k.json"


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.score(docs.select(*COLUMNS), read(spark, sf_dir, "labels"))
    return scored.filter(F.col("score") < toxicity.REJECT).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs.select(*COLUMNS), words=3, distance=2)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs.select(*COLUMNS))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids, and whether the ids decode to the text"""
    import public_tokenizers

    path = public_tokenizers.path(TOKENIZER)
    coded = bpe.code(docs.select("doc_id", "source", "text"), path, compare="round_trip")
    return coded.select("doc_id", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_stage),
    ("mixing sources", mixing_stage),
    ("BPE coding", encoding_stage),
]

#: A network, fingerprints and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
