"""Tiles by rank search against NTILE over a sorted window."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quaymark.operators import tiles


def with_windows(df, key, measures):
    for name, (measure, n) in measures.items():
        df = df.withColumn(name, F.ntile(n).over(Window.orderBy(measure, key)))
    return df


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(4)
    return [
        (f"id{i:05d}", draw.choice([1, 1, 1, 2, 3]), Decimal(draw.randrange(10**6)) / 100, draw.choice([None, 1.5, float(i)]), 7, f"{draw.randrange(50):02d}")
        for i in range(9_000)
    ]


SCHEMA = "id string, visits long, spent decimal(18,2), score double, same long, word string"
MEASURES = {"a": ("visits", 5), "b": ("spent", 5), "c": ("score", 7), "d": ("same", 3), "e": ("word", 4), "f": ("spent", 11)}


@pytest.mark.parametrize("few,sample", [(4_096, 4_096), (20, 100)])
def test_tiles_equal_ntile(spark, rows, monkeypatch, few, sample):
    """Ties in a third of the rows, nulls, equal values throughout; unlucky samples too."""
    monkeypatch.setattr(tiles, "FEW", few)
    monkeypatch.setattr(tiles, "SAMPLE", sample)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    # many rounds for each edge, so fewer edges where intervals stay small
    measures = MEASURES if few > 1_000 else {n: MEASURES[n] for n in "abc"}
    have, want = tiles.with_tiles(df, "id", measures), with_windows(df, "id", measures)
    assert have.exceptAll(want).isEmpty() and have.count() == len(rows)


def test_narrow_margins_still_find_the_ranks(spark, rows, monkeypatch):
    """With no margin the first interval is often wrong; the search has to go beside it."""
    monkeypatch.setattr(tiles, "SPREAD", -1.0)
    monkeypatch.setattr(tiles, "FEW", 20)
    df = spark.createDataFrame(rows, SCHEMA)
    measures = {"b": ("spent", 5), "a": ("visits", 4)}
    assert tiles.with_tiles(df, "id", measures).exceptAll(with_windows(df, "id", measures)).isEmpty()


@pytest.mark.parametrize("n", [0, 1, 2, 4, 5, 6, 13])
def test_few_rows(spark, n):
    df = spark.createDataFrame([(i, float(-i % 3)) for i in range(n)], "id long, v double")
    measures = {"t": ("v", 5)}
    have = sorted(tiles.with_tiles(df, "id", measures).collect())
    assert have == sorted(with_windows(df, "id", measures).collect())


def test_rows_are_not_shuffled(spark, rows):
    found = tiles.with_tiles(spark.createDataFrame(rows, SCHEMA), "id", MEASURES)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan
