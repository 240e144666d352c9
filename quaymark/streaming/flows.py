"""Streaming forms of the batch operators. They take a streaming frame and return one."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.behaviour import GAP_MINUTES
from ..operators.metrics import tumbling

LATENESS = "10 minutes"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside keep their state in RocksDB, whatever the session's provider is.

    A stateful processor with several values or timers needs column families, which Spark's default provider does not have.
    A micro-batch commits what it changed, not files of the whole state. A query takes the settings over when it starts.
    """
    settings = {PROVIDER: ROCKSDB, CHANGELOG: "true"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format("parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def session_totals(events: DataFrame, user: str, time: str, lateness: str = LATENESS) -> DataFrame:
    """Sessions with the batch rule: times in whole seconds, a new session after more than the gap.

    Session windows that touch are merged, so a pause of exactly the gap stays inside a session.
    """
    second = F.date_trunc("second", F.col(time))
    timed = events.withColumn("_second", second).withWatermark("_second", lateness)
    gap = f"{GAP_MINUTES * 60} seconds"
    out = timed.groupBy(F.session_window("_second", gap).alias("_window"), user).agg(
        F.count(F.lit(1)).alias("events"),
        F.min(time).alias("first_event"),
        F.max(time).alias("last_event"),
    )
    return out.select(user, "events", "first_event", "last_event")


def window_totals(
    samples: DataFrame, every: str, by: Sequence[str], ts: str = "ts", lateness: str = LATENESS
) -> DataFrame:
    """Windowed counts and sums; rows later than the watermark are dropped."""
    aggs = [F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total")]
    return tumbling(samples.withWatermark(ts, lateness), every, by, aggs, ts)


def drop_repeats(events: DataFrame, key: Sequence[str], ts: str = "ts", lateness: str = LATENESS) -> DataFrame:
    """Drop repeated events that arrive within the watermark delay; state is freed after it."""
    return events.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(list(key))


def closing_stream(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """A stream that is empty until `close` writes the row that ends a run."""
    # an empty range, as an empty list would start a Python worker per core
    spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema]).write.mode("append").parquet(folder)
    return file_stream(spark, folder, schema)


def close(spark: SparkSession, folder: str, schema: T.StructType, time: str, last: Column) -> None:
    """Write a row of no key, a day after the last time, so that the watermark passes every open window.

    The row's own window stays open and is never written.
    """
    row = spark.range(1).select(
        *[(last + F.expr("INTERVAL 1 DAY") if f.name == time else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )
    row.write.mode("append").parquet(folder)


def run_available(stream: DataFrame, out: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Process everything that is there now, append it to files, and stop."""
    writer = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    with rocksdb_state(stream.sparkSession):
        query = writer.start()
    query.awaitTermination()
