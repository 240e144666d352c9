"""Streams over many files against the batch result."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quaymark.operators import behaviour
from quaymark.session import new_folder
from quaymark.streaming import flows

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double"
START = datetime(2024, 1, 1)


def write_files(spark, rows, files):
    """Files in time order; the stream reads them in the order they were written."""
    folder = new_folder(spark, "source")
    size = -(-len(rows) // files)
    for i in range(files):
        spark.createDataFrame(rows[i * size : (i + 1) * size], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return folder


def run(spark, folder, build):
    source = flows.file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, files_per_batch=2)
    stream, out = build(source), new_folder(spark, "out")
    flows.run_available(stream, out, new_folder(spark, "offsets"))
    return spark.read.schema(stream.schema).parquet(out)


@pytest.fixture(scope="module")
def rows():
    return [(i, START + timedelta(seconds=i * 400 + i * i % 97), i * i % 5, "view" if i % 2 else "buy", float(i % 9)) for i in range(400)]


def test_sessions_equal_the_batch(spark, rows):
    folder = write_files(spark, rows, 6)
    have = run(spark, folder, lambda s: flows.session_totals(s, "user_id", "ts")).collect()
    batch = behaviour.sessionize(spark.createDataFrame(rows, SCHEMA), "user_id", "ts")
    sessions = batch.groupBy("user_id", "session_no").agg(
        F.count("*").alias("events"), F.min("ts").alias("first_event"), F.max("ts").alias("last_event"))
    closed = max(r[1] for r in rows) - timedelta(minutes=10)
    want = [r for r in sessions.collect() if r.last_event + timedelta(minutes=30) <= closed]
    assert len(want) > 3
    assert {tuple(r) for r in have} == {(r.user_id, r.events, r.first_event, r.last_event) for r in want}


def test_windows_equal_the_batch(spark, rows):
    folder = write_files(spark, rows, 6)
    have = run(spark, folder, lambda s: flows.window_totals(s, "5 minutes", ["event_type"])).collect()
    closed = max(r[1] for r in rows) - timedelta(minutes=10)
    want = {}
    for _, ts, _, kind, value in rows:
        start = ts - timedelta(minutes=ts.minute % 5, seconds=ts.second, microseconds=ts.microsecond)
        n, total = want.get((start, kind), (0, 0.0))
        want[(start, kind)] = (n + 1, total + value)
    want = {k: v for k, v in want.items() if k[0] + timedelta(minutes=5) <= closed}
    assert {(r.window_start, r.event_type): (r.events, float(r.total)) for r in have} == want


def test_closing_a_run_writes_every_event(spark, rows):
    folder, end = write_files(spark, rows, 6), new_folder(spark, "closing")
    schema = spark.createDataFrame([], SCHEMA).schema
    source = flows.file_stream(spark, folder, schema).unionByName(flows.closing_stream(spark, end, schema))
    out, offsets = new_folder(spark, "out"), new_folder(spark, "offsets")
    stream = flows.session_totals(source, "user_id", "ts")
    flows.run_available(stream, out, offsets)
    flows.close(spark, end, schema, "ts", F.lit(max(r[1] for r in rows)))
    flows.run_available(stream, out, offsets)
    found = spark.read.parquet(out).collect()
    assert sum(r.events for r in found) == len(rows) and all(r.user_id is not None for r in found)


def test_late_rows_are_dropped(spark):
    fresh = [(i, START + timedelta(minutes=i), 1, "view", 1.0) for i in range(120)]
    next_one = [(998, START + timedelta(minutes=150), 1, "view", 1.0)]  # a batch that moves the watermark on
    late = [(999, START, 1, "view", 50.0)]
    more = [(1000 + i, START + timedelta(minutes=200 + i), 1, "view", 1.0) for i in range(3)]
    folder = new_folder(spark, "source")
    for part in (fresh, next_one, late, more):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    source = flows.file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)
    out = new_folder(spark, "out")
    flows.run_available(flows.window_totals(source, "5 minutes", ["event_type"]), out, new_folder(spark, "offsets"))
    first = spark.read.parquet(out).orderBy("window_start").first()
    assert (first.events, float(first.total)) == (5, 5.0)


def test_repeats_are_dropped(spark, rows):
    folder = write_files(spark, rows + rows[-3:], 2)
    have = run(spark, folder, lambda s: flows.drop_repeats(s, ["event_id"]))
    assert sorted(r.event_id for r in have.collect()) == [r[0] for r in rows]
