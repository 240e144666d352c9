from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from quaymark.operators import logs, metrics

LINES = [
    "  stray line",
    "[2024-01-01 00:00:00,123] {a.py:1} ERROR - it failed",
    "Traceback (most recent call last):",
    '  File "x.py", line 1',
    "[2024-01-01 00:00:01,000] {a.py:2} INFO - fine",
]


def lines(spark, files=("/logs/shop_gold/t/2024-01-01/1.log", "/logs/odd.log")):
    rows = [(p, i, text) for p in files for i, text in enumerate(LINES)]
    return spark.createDataFrame(rows, "path string, line_no long, line string")


def test_records(spark):
    placed = logs.assemble_records(lines(spark)).orderBy("path", "line_no").collect()
    assert [(r.record_no, r.line_in_record) for r in placed] == [(0, 1), (1, 1), (1, 2), (1, 3), (2, 1)] * 2
    out = logs.record_texts(logs.assemble_records(lines(spark))).orderBy("path", "record_no").collect()
    assert [r.message for r in out[:3]] == [LINES[0], "\n".join(LINES[1:4]), LINES[4]]
    assert [r.lines for r in out] == [1, 3, 1] * 2


def test_a_record_has_no_greatest_length(spark):
    rows = [("/f.log", i, "[start" if i == 5 else "more") for i in range(20_000)]
    placed = logs.assemble_records(spark.createDataFrame(rows, "path string, line_no long, line string"))
    last = placed.orderBy(F.desc("line_no")).first()
    assert (last.record_no, last.line_in_record) == (1, 20_000 - 5)


def test_fields_and_classes(spark):
    records = logs.record_texts(logs.assemble_records(lines(spark)))
    out = {(r.path, r.record_no): r for r in logs.classify(logs.structure(records)).collect()}
    hit = out[("/logs/shop_gold/t/2024-01-01/1.log", 1)]
    assert hit.logged_at == datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert (hit.source_file, hit.log_level, hit.log_message) == ("a.py:1", "error", "it failed")
    assert (hit.dag_id, hit.task_id, hit.try_number, hit.layer, hit.severity) == ("shop_gold", "t", 1, "gold", "high")
    miss = out[("/logs/odd.log", 0)]
    assert miss.tags == ["record_parse_failure", "path_parse_failure"] and miss.severity == "low"


def samples(spark, n=500):
    start = datetime(2024, 1, 1)
    rows = [
        (i, start + timedelta(seconds=i * 37 % 9000), "hot" if i % 3 else f"m{i % 4}", "p95", float(i * 7919 % 101))
        for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, "event_id long, ts timestamp, measurement string, field string, value double")


def test_percentiles_are_exact(spark):
    rows, df = samples(spark)
    for found in metrics.percentiles(df, ["measurement"]).collect():
        values = [r[4] for r in rows if r[2] == found.measurement]
        want = np.quantile(values, metrics.PERCENTILES)
        assert found.samples == len(values)
        assert np.allclose([found.p50, found.p90, found.p95, found.p99, found.p99_9], want)


def test_rate_is_null_when_a_counter_falls(spark):
    start = datetime(2024, 1, 1)
    rows = [("m", start + timedelta(seconds=s), v) for s, v in ((0, 1.0), (10, 21.0), (20, 5.0))]
    df = spark.createDataFrame(rows, "measurement string, window_start timestamp, value double")
    out = metrics.rate(df, ["measurement"]).orderBy("window_start").collect()
    assert [r.per_second for r in out] == [2.0, None]


def test_heartbeat_limit(spark):
    start = datetime(2024, 1, 1)
    rows = [(i, "m", start + timedelta(seconds=s)) for i, s in enumerate((0, 60, 121))]
    df = spark.createDataFrame(rows, "event_id long, measurement string, ts timestamp")
    gaps = metrics.heartbeat_gaps(df, ["measurement"]).collect()
    assert [g.gap_seconds for g in gaps] == [61.0]


def test_last_value_and_alerts(spark):
    rows, df = samples(spark)
    for r in metrics.last_values(df, ["measurement"]).collect():
        newest = max((x for x in rows if x[2] == r.measurement), key=lambda x: (x[1], x[0]))
        assert (r.last_ts, r.last_value) == (newest[1], newest[4])
    alerts = metrics.failure_alerts(df, F.col("measurement") == "hot")
    assert {a.alert for a in alerts.collect()} == {"CRITICAL"}
