"""Readers: catalog tables, path copies, named SQL files."""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SQL_FOLDER = Path(__file__).resolve().parent.parent / "plans" / "sql"


def require_text(**arguments: object) -> dict[str, str]:
    """Trimmed arguments; a wrong type or a blank one raises."""
    for name, value in arguments.items():
        if not isinstance(value, str):
            raise TypeError(f"{name} must be a string")
        if not value.strip():
            raise ValueError(f"{name} must not be blank")
    return {name: value.strip() for name, value in arguments.items()}


def table_name(catalog: str, schema: str, table: str) -> str:
    parts = require_text(catalog=catalog, schema=schema, table=table)
    return ".".join(f"`{p}`" for p in parts.values())


def read_table(spark: SparkSession, catalog: str, schema: str, table: str) -> DataFrame:
    return spark.read.table(table_name(catalog, schema, table))


def read_path(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None, **options: str
) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def list_tables(spark: SparkSession, catalog: str, schema: str) -> list[str]:
    parts = require_text(catalog=catalog, schema=schema)
    found = spark.catalog.listTables(f"{parts['catalog']}.{parts['schema']}")
    return sorted(t.name for t in found if not t.isTemporary)


def table_exists(spark: SparkSession, catalog: str, schema: str, table: str) -> bool:
    return spark.catalog.tableExists(table_name(catalog, schema, table))


def run_named(
    spark: SparkSession, name: str, frames: Mapping[str, DataFrame] | None = None, folder: Path = SQL_FOLDER
) -> DataFrame:
    """Run the SQL file of that name. Frames are bound to the {names} in its text."""
    path = Path(folder) / f"{name}.sql"
    if not path.exists():
        raise FileNotFoundError(f"no SQL file {path}")
    return spark.sql(path.read_text(encoding="utf-8"), **dict(frames or {}))
