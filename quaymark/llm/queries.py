"""The queries of this folder, one per operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    conversations, exact_dedup, fingerprints, language_id, mixing, near_dedup, oracles, packing, quality, secrets,
    spelling, substring_dedup, token_counts, vectors,
)

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LIMIT = 2048


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), VOCABULARY, LIMIT)


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.language_id(_table(spark, folder, "documents"))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, folder, "documents"), VOCABULARY, LIMIT)


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.importance(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def _listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(_table(spark, folder, "documents"), VOCABULARY)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in secrets.KINDS),
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
    )


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring_dedup.remove_repeats(_table(spark, folder, "documents"))
    kept = F.when(F.col("kept").isNull(), F.lower(F.hex("sha"))).otherwise(F.sha2(F.col("kept"), 256))
    return found.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.classes(_table(spark, folder, "documents"), width=2)


def op8_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, folder, "embeddings"))


def op9_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    return exact_dedup.classes(documents, exact_dedup.earlier_half(documents))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.audited(_table(spark, folder, "conversations"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    runs = spelling.runs(_table(spark, folder, "documents"))
    return spelling.variants(spelling.vocabulary(spelling.with_slips(runs)))


def op13_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """The contract's columns, and how many other documents lie within the radius of each document."""
    rows = fingerprints.with_near(fingerprints.edited(_table(spark, folder, "documents")))
    hexadecimal = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    like = lambda c: 1 - F.bit_count(F.col("fingerprint").bitwiseXOR(F.col(c))) / fingerprints.BITS
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", hexadecimal("fingerprint").alias("fingerprint"),
        hexadecimal("edited_fingerprint").alias("edited_fingerprint"), like("edited_fingerprint").alias("near_edited"),
        like("next_fingerprint").alias("near_next"), "n_near",
    )


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Query] = {q.__name__: q for q in (
    op1_best_fit_packing, op2_language_id, op3_token_counts, op4_quality_classifier, op5_substring_dedup,
    op6_minhash_near_dedup, op7_secret_scan,
    op8_embedding_near_dedup, op9_source_mixing, op10_exact_dedup, op11_conversation_repair, op12_spelling_variants,
    op13_document_fingerprints, pipeline,
)}

SQL: dict[str, str] = {
    "op11_conversation_repair": oracles.CONVERSATIONS,
    "op12_spelling_variants": oracles.SPELLING,
    "op9_source_mixing": mixing.oracle(),
    "op10_exact_dedup": """
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ), w AS (
            SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM d
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w
    """,
}
