"""Clustered files: the rows of a range, from few of the files."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from quaymark.session import new_folder
from quaymark.sources import clustered

START = date(2024, 1, 1)


@pytest.fixture(scope="module")
def days(spark):
    """A third of the rows on one day, some without a day."""
    rows = [(i, None if i % 50 == 0 else START + timedelta(days=200 if i % 3 == 0 else i % 365), "x" * 40) for i in range(12_000)]
    frame = spark.createDataFrame(rows, "id long, day date, fat string").repartition(5)
    path = new_folder(spark, "clustered")
    clustered.write_clustered(frame, path, "day", ["id"], row_group_bytes=4_096)
    return frame, path


def test_ranges_hold_the_rows_of_a_filter(spark, days):
    frame, path = days
    day = lambda n: START + timedelta(days=n)
    for low, high in ((day(10), day(20)), (day(200), day(201)), (None, day(5)), (day(360), None), (None, None), (day(400), None), (day(20), day(10))):
        want = frame.where("day IS NOT NULL")
        want = want if low is None else want.where(F.col("day") >= F.lit(low))
        want = want if high is None else want.where(F.col("day") < F.lit(high))
        have = clustered.read_between(spark, path, "day", frame.schema, low, high)
        assert have.count() == want.count() and have.exceptAll(want).isEmpty()


def test_a_range_reads_few_files(spark, days):
    frame, path = days
    every = clustered.bounds(spark, path).collect()
    assert sum(r.rows for r in every) == frame.count() and len(every) == 8
    few = clustered.files_between(spark, path, START + timedelta(days=10), START + timedelta(days=20))
    assert 1 <= len(few) <= 2
    # the day of a third of the rows is split over files by the second column
    hot = clustered.files_between(spark, path, START + timedelta(days=200), START + timedelta(days=201))
    assert len(hot) >= 3
    assert clustered.files_between(spark, path, START + timedelta(days=400), None) == []


def test_row_groups_are_left_out_within_a_file(spark, days):
    """The scan gives out a measured part of the rows of the files it opens."""
    frame, path = days
    low, high = START + timedelta(days=10), START + timedelta(days=12)
    found = clustered.read_between(spark, path, "day", frame.schema, low, high)
    opened = spark.read.parquet(*clustered.files_between(spark, path, low, high)).count()
    rows = found.collect()
    plan = found._jdf.queryExecution().executedPlan()
    scans = plan.collectLeaves()
    read = sum(scans.apply(i).metrics().apply("numOutputRows").value() for i in range(scans.length()))
    assert len(rows) <= read < opened / 2
