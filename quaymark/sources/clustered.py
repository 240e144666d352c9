"""Files clustered by a key: ranges of the key per file, sorted within, with each file's bounds kept beside them.

A reader of a range opens only the files whose bounds touch it, and within them Parquet's own bounds per row group leave
out the rest. The bounds are a small table with a row per file; only the names of the files to read come to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Size of a row group, by which Parquet leaves out parts of a file.
ROW_GROUP_BYTES = 32 << 20


def write_clustered(df: DataFrame, path: str, key: str, then: Sequence[str] = (), row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Write rows in ranges of `key`, sorted by it and then by other columns, which also split a value of many rows.

    The ranges come from Spark's own sample of the rows; their number is spark.sql.shuffle.partitions at most. Rows whose
    key is null come first. Writing again to the same path is an error.
    """
    order = [F.col(key).asc_nulls_first(), *then]
    laid = df.repartitionByRange(*order).sortWithinPartitions(*order)
    laid.write.option("parquet.block.size", row_group_bytes).parquet(f"{path}/data")
    written = df.sparkSession.read.schema(df.schema).parquet(f"{path}/data")
    bounds = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count_if(F.col(key).isNull()).alias("nulls"), F.count(F.lit(1)).alias("rows")
    )
    bounds.coalesce(1).write.parquet(f"{path}/bounds")


def bounds(spark: SparkSession, path: str) -> DataFrame:
    """file, low, high, nulls, rows of every file."""
    return spark.read.parquet(f"{path}/bounds")


def files_between(spark: SparkSession, path: str, low: object, high: object) -> list[str]:
    """The files that may hold keys from `low` up to, not including, `high`; None is no bound."""
    touched: Column = F.col("rows") > F.col("nulls")
    if low is not None:
        touched = touched & (F.col("high") >= F.lit(low))
    if high is not None:
        touched = touched & (F.col("low") < F.lit(high))
    return [r.file for r in bounds(spark, path).where(touched).select("file").orderBy("file").collect()]


def read_between(spark: SparkSession, path: str, key: str, schema: T.StructType, low: object = None, high: object = None) -> DataFrame:
    """Rows whose key is from `low` up to, not including, `high`. Without a bound, rows with a null key are left out all the same."""
    names = files_between(spark, path, low, high)
    if not names:
        return spark.createDataFrame([], schema)
    inside: Column = F.col(key).isNotNull()
    if low is not None:
        inside = inside & (F.col(key) >= F.lit(low))
    if high is not None:
        inside = inside & (F.col(key) < F.lit(high))
    return spark.read.schema(schema).parquet(*names).where(inside)
