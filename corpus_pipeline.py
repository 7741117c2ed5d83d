"""A corpus from documents to token ids, in five stages.

Every stage works on all rows its predecessor kept, written as Parquet and read
again, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import bpe, quality
from gridloom.llm.minhash import drop_near_duplicates
from gridloom.llm.mixing import mix_plan, take_mix
from gridloom.llm.secrets import scan_and_redact
from gridloom.plans.joins import store

QUALITY = 0.7  # documents that score less go
SIMILARITY = 80  # percent of five-word shingles that near-duplicates share


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` again, where a stage changes texts."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the network, fitted on those with labels, takes for good."""
    net = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score_quality(docs, net, out="_score").where(F.col("_score") >= QUALITY).drop("_score")


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return drop_near_duplicates(docs, percent=SIMILARITY)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by its kind; every document stays."""
    return _counted(scan_and_redact(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return take_mix(docs, mix_plan(docs))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it again."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    decoded = bpe.round_trip(docs.select("doc_id", "source", "text"), path, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        "source",
        bpe.token_count().alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("decodes"),
    )


STAGES = [
    ("quality classifier", classify),
    ("near-dedup", deduplicate),
    ("secret scan", redact),
    ("source mix", mix),
    ("byte-level BPE", tokenize),
]

# networks, sketches, draws and merges are not SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
