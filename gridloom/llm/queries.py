"""One query per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import secrets as S
from gridloom.llm import bpe, oracles, quality
from gridloom.llm.ann import nearest_neighbours
from gridloom.llm.embed_dedup import near_duplicate_vectors
from gridloom.llm.fingerprints import compare_with_edits
from gridloom.llm.html import extract_main_text
from gridloom.llm.lm import score_documents
from gridloom.llm.minhash import near_duplicates
from gridloom.llm.mixing import mix_plan
from gridloom.llm.shards import shuffle_into_shards
from gridloom.llm.spelling import spelling_variants
from gridloom.llm.whitening import whitened_components


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN).select(
        "doc_id",
        bpe.token_count().alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose five-word shingles agree by 85 percent."""
    return near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", percent=85, width=5)


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    plan = mix_plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return plan.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "source"
    )


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every hundredth vector, among all others."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, found=10)


def op5_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of vectors whose cosine is at least 0.9."""
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of every document, learned outside the held-out fold."""
    return score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the plain kinds, all spans."""
    found = S.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("secret_spans")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    plain = F.filter(spans, lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(_listed(plain), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
    )


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled into eight shards of equal row counts."""
    placed = shuffle_into_shards(table(spark, sf_dir, "documents"), ["doc_id"], shards=8)
    text = F.coalesce(F.col("text"), F.lit(""))
    return placed.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = extract_main_text(table(spark, sf_dir, "pages"), "html", "text")
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by a network fitted outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, net).select(
        "doc_id",
        quality.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector along the eight components of largest variance, whitened."""
    rows = whitened_components(table(spark, sf_dir, "embeddings"), components=8)
    # null where the exact number is too large for a long
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every word of the documents."""
    return spelling_variants(table(spark, sf_dir, "documents"), damage=97)


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return compare_with_edits(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_mix": op3_mix,
    "op4_neighbours": op4_neighbours,
    "op5_vector_duplicates": op5_vector_duplicates,
    "op6_shards": op6_shards,
    "op7_lm_scores": op7_lm_scores,
    "op8_main_text": op8_main_text,
    "op9_secret_scan": op9_secret_scan,
    "op10_quality": op10_quality,
    "op11_whitening": op11_whitening,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_fingerprints": op13_fingerprints,
}

ORACLES: dict[str, str] = {
    "op2_near_duplicates": oracles.NEAR_DUPLICATES,
    "op5_vector_duplicates": oracles.EMBEDDING_DUPLICATES,
    "op12_spelling_variants": oracles.SPELLING_VARIANTS,
}
