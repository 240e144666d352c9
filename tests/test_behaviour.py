from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quaymark.operators import behaviour

START = datetime(2024, 1, 1)


def events(spark, rows):
    data = [(i, u, START + timedelta(seconds=s), kind) for i, (u, s, kind) in enumerate(rows)]
    return spark.createDataFrame(data, "event_id long, acc_id string, event_time timestamp, event_type string")


def test_session_gap(spark):
    rows = [("u", 0, "view"), ("u", 1800, "view"), ("u", 3601, "view"), ("u", 3601, "view"), ("w", 9, "view")]
    out = behaviour.sessionize(events(spark, rows))
    assert {r.event_id: r.session_no for r in out.collect()} == {0: 1, 1: 1, 2: 2, 3: 2, 4: 1}


def test_fraction_of_a_second_does_not_open_a_session(spark):
    base = spark.createDataFrame(
        [(1, "u", datetime(2024, 1, 1, 0, 0, 0, 100)), (2, "u", datetime(2024, 1, 1, 0, 30, 0, 900))],
        "event_id long, acc_id string, event_time timestamp",
    )
    assert {r.session_no for r in behaviour.sessionize(base).collect()} == {1}


FUNNELS = [
    (["purchase"], ["view"]),
    (["checkout", "purchase"], ["add_to_cart", "purchase"]),
    (["add_to_cart", "checkout", "purchase"], ["add_to_cart", "checkout", "purchase"]),
    (["remove_from_cart", "add_to_cart", "remove_from_cart"], ["view", "add_to_cart", "remove_from_cart"]),
    (["view", "wishlist", "checkout", "checkout"], ["view", "wishlist", "add_to_cart", "add_to_cart"]),
]


@pytest.mark.parametrize("before,after", FUNNELS)
def test_funnel(spark, before, after):
    rows = events(spark, [("u", i, k) for i, k in enumerate(before)]).withColumn("session_no", F.lit(1))
    out = behaviour.repair_funnel(rows).orderBy("event_id")
    assert [r.event_type for r in out.collect()] == after


def test_sessions_are_numbered_through(spark):
    kinds = ["view", "add_to_cart", "checkout", "purchase", "remove_from_cart"]
    rows = [("hot" if i % 3 else f"u{i % 7}", i * 977 % 90000, kinds[i * 7 % 5]) for i in range(600)]
    found = behaviour.rebuild_sessions(events(spark, rows)).collect()
    numbers = sorted({int(r.session_id[2:]) for r in found})
    assert len(found) == 600 and numbers == list(range(1, len(numbers) + 1))
    owner = {}
    for r in found:
        owner.setdefault(r.session_id, r.acc_id)
        assert owner[r.session_id] == r.acc_id
    assert [owner[k] for k in sorted(owner)] == sorted(owner.values())
