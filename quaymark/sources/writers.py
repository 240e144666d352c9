"""Writers: CSV, path and table sinks, and a verified publish step."""

from __future__ import annotations

from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import versions
from .readers import require_text, table_name
from .versions import PublishError, fingerprint

__all__ = ["CSV_OPTIONS", "PACKED", "PublishError", "as_text", "fingerprint", "publish", "write_csv", "write_path", "write_table"]

MODES = ("overwrite", "append", "ignore", "error")

#: With these a text comes back as it was: line breaks, quotes, blanks at its ends, empty and null are told apart.
CSV_OPTIONS = {
    "header": "true", "multiLine": "true", "quote": '"', "escape": '"', "nullValue": "\\N",
    "lineSep": "\n", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}

#: Packed exports, in the quickest of the format's ways: more thorough ones take twice the time of writing for a fifth less.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def _mode(mode: str) -> str:
    name = require_text(mode=mode)["mode"].lower()
    if name not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    return name


def write_csv(
    df: DataFrame, base: str, layer: str, dataset: str, mode: str = "overwrite", at: datetime | None = None, **options: str
) -> str:
    """Write values as text, with a header, under base/layer/dataset/<timestamp> and return that path."""
    names = require_text(base=base, layer=layer, dataset=dataset)
    stamp = (at or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S_%f")
    path = f"{names['base'].rstrip('/')}/{names['layer']}/{names['dataset']}/{stamp}"
    as_text(df).write.mode(_mode(mode)).options(**{**CSV_OPTIONS, **options}).csv(path)
    return path


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def write_path(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> str:
    df.write.format(fmt).mode(_mode(mode)).save(path)
    return path


def write_table(
    df: DataFrame, catalog: str, schema: str, table: str, mode: str = "overwrite", path: str | None = None,
    fmt: str = "parquet",
) -> str:
    """Write a catalog table, replacing its schema; with a path, the table is external."""
    name = table_name(catalog, schema, table)
    writer = df.write.format(fmt).mode(_mode(mode)).option("overwriteSchema", "true")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return name


def publish(
    spark: SparkSession, source: DataFrame, staged: str, target: str, fmt: str, schema: T.StructType, **options: str
) -> DataFrame:
    """Publish staged files as a new version of `target`, checked against the source before anyone reads it.

    Returns one row (row_count, hash_sum). Raises when the copy is empty or not the source's rows; then the version
    before it is still the one to read.
    """
    reader = spark.read.format(fmt).options(**options).schema(schema)
    done = versions.publish(spark, source, reader.load(staged), target, fmt, schema, **options)
    return spark.createDataFrame([(done.row_count, Decimal(done.hash_sum))], "row_count long, hash_sum decimal(38,0)")
