"""From raw documents to packed sequences: quality, exact copies, near copies, mixing, packing.

Each stage takes (spark, docs, folder) and returns a frame; all but the last return the columns of the documents.
`run` writes each stage's rows to the shared folder and reads them back for the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quaymark.llm import exact_dedup, mixing, near_dedup, packing, quality
from quaymark.llm.queries import LIMIT, VOCABULARY
from quaymark.session import stage


def keep_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents the quality model draws; the others go."""
    return quality.drawn(docs, spark.read.parquet(f"{folder}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.distinct(docs, exact_dedup.earlier_half(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8)."""
    return near_dedup.distinct(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics get their target weights within the token budget."""
    return mixing.sample(docs, keep=mixing.KEEP)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents' pieces, with their places in sequences."""
    return packing.pack(docs, VOCABULARY, LIMIT)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack),
]

#: The stages fit models and count byte-pair tokens, which SQL can't; tests compare them with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, folder), name.replace(" ", "-"))
    return docs
