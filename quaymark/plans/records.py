"""Run metadata as one-row frames, ready to append to a metadata table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.readers import require_text

FRAMEWORK, VERSION = "quaymark", "1.0.0"
FILE_FORMATS = ("csv", "parquet", "json")


def _now(at: datetime | None) -> Column:
    return F.lit((at or datetime.now(timezone.utc)).isoformat())


def _common(columns: Sequence[str], at: datetime | None) -> dict[str, Column]:
    return {
        "columns": F.array(*[F.lit(c) for c in columns]),
        "generated_at": _now(at),
        "framework": F.lit(FRAMEWORK),
        "framework_version": F.lit(VERSION),
    }


def _texts(**values: str) -> dict[str, Column]:
    return {n: F.lit(v) for n, v in require_text(**values).items()}


def bronze_record(
    report: DataFrame, columns: Sequence[str], dataset: str, layer: str, object_path: str,
    file_format: str = "csv", at: datetime | None = None,
) -> DataFrame:
    """Metadata of a bronze table from its validation report."""
    kind = require_text(file_format=file_format)["file_format"].lower()
    if kind not in FILE_FORMATS:
        raise ValueError(f"file_format must be one of {', '.join(FILE_FORMATS)}")
    named = _texts(dataset=dataset, layer=layer, object_path=object_path)
    return report.withColumns({**named, "format": F.lit(kind), **_common(columns, at)})


def silver_record(
    report: DataFrame, columns: Sequence[str], dataset: str, layer: str, object_path: str,
    file_format: str = "parquet", duration: float | None = None, at: datetime | None = None,
) -> DataFrame:
    named = _texts(dataset=dataset, layer=layer, object_path=object_path, format=file_format)
    spent = F.lit(duration).cast("double")
    return report.withColumns({**named, "processing_duration": spent, **_common(columns, at)})


def gold_record(
    written: DataFrame, query_name: str, target_table: str, object_path: str, status: str = "SUCCESS",
    file_format: str = "parquet", duration: float | None = None, at: datetime | None = None,
) -> DataFrame:
    """Metadata of a gold table; rows are counted in the written table, not by running the query again."""
    named = _texts(
        query_name=query_name, target_table=target_table, layer="gold", object_path=object_path, status=status,
        format=file_format,
    )
    rows = written.agg(F.count(F.lit(1)).alias("row_count"))
    return rows.withColumns(
        {
            "column_count": F.lit(len(written.columns)),
            **named,
            "processing_duration": F.lit(duration).cast("double"),
            **_common(written.columns, at),
        }
    )


def as_json(records: DataFrame) -> DataFrame:
    """One JSON text per record."""
    return records.select(F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"}).alias("record"))
