"""Ordered scans and numbering against brute force, with groups split over slices."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quaymark.operators import keys, ordered
from quaymark.session import stage, workspace


def skewed(n=900, seed=3):
    """A third of the rows belong to one key; some keys are null; times have ties."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.34 else rng.choice(["a", "b", "c", None, "z", "zz"])
        rows.append((i, key, rng.randrange(200), rng.choice([None, 1, 2, 3])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, k string, t long, v long").repartition(5)


def arranged(df, keys):
    return ordered.ordered(df, keys, ["t", "id"])


def by_key(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        groups.setdefault(r[1], []).append(r)
    return groups


def test_previous_value(spark):
    rows = skewed()
    plan = arranged(frame(spark, rows), ["k"])
    out = plan.done(plan.previous(plan.frame, "v", "p"))
    want = {}
    for group in by_key(rows).values():
        for before, row in zip([None, *group], group):
            want[row[0]] = before[3] if before else None
    assert {r.id: r.p for r in out.collect()} == want
    assert out.columns == ["id", "k", "t", "v", "p"]


@pytest.mark.parametrize("inclusive", [False, True])
def test_running_sum(spark, inclusive):
    rows = skewed(seed=5)
    plan = arranged(frame(spark, rows), ["k"])
    out = plan.done(plan.running_sum(plan.frame, F.col("v"), "s", inclusive))
    want = {}
    for group in by_key(rows).values():
        total = 0
        for row in group:
            want[row[0]] = total + (row[3] or 0) if inclusive else total
            total += row[3] or 0
    assert {r.id: r.s for r in out.collect()} == want


def test_two_steps_over_two_keys(spark):
    """A running sum over a value that itself comes from the row before."""
    rows = skewed(seed=7)
    two = frame(spark, rows).withColumn("m", F.col("id") % 2)
    plan = arranged(two, ["k", "m"])
    seen = plan.previous(plan.frame, "t", "p")
    jump = F.when(F.col("p").isNull() | (F.col("t") - F.col("p") > 3), 1).otherwise(0)
    out = plan.done(plan.running_sum(seen.withColumn("j", jump), F.col("j"), "n"))
    want = {}
    groups = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        groups.setdefault((r[1], r[0] % 2), []).append(r)
    for group in groups.values():
        n = 0
        for before, row in zip([None, *group], group):
            n += 1 if before is None or row[2] - before[2] > 3 else 0
            want[row[0]] = n
    assert {r.id: r.n for r in out.collect()} == want


def test_split_spreads_a_hot_key(spark):
    rows = [(i, "hot", i, 1) for i in range(800)]
    df = frame(spark, [*rows, (900, "cold", 1, 1)])
    plan = ordered.ordered(df, ["k"], ["t"])
    sizes = [r["count"] for r in plan.frame.groupBy(ordered.SLICE).count().collect()]
    assert len(sizes) > 5 and max(sizes) < 400


def test_empty_input(spark):
    plan = ordered.ordered(frame(spark, []), ["k"], ["t", "id"])
    assert plan.done(plan.number(plan.previous(plan.frame, "v", "p"), "n")).count() == 0


def test_latest_per_key_breaks_ties(spark):
    rows = [(1, "a", 5, 1), (2, "a", 5, 2), (3, "b", 1, 1), (4, "b", 2, 1)]
    out = ordered.latest_per_key(frame(spark, rows), ["k"], [F.desc("t"), F.desc("id")])
    assert sorted(r.id for r in out.collect()) == [2, 4]


def test_latest_per_key_prunes_before_the_shuffle(spark):
    out = ordered.latest_per_key(frame(spark, skewed()), ["k"], [F.desc("t"), F.desc("id")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_number_rows(spark):
    rows = skewed(seed=11)
    out = keys.number_rows(frame(spark, rows), [F.desc("t"), "id"], "n", "total")
    order = sorted(rows, key=lambda r: (-r[2], r[0]))
    assert {r.id: r.n for r in out.collect()} == {r[0]: i + 1 for i, r in enumerate(order)}
    assert {r.total for r in out.select("total").distinct().collect()} == {len(rows)}


def test_numbering_moves_rows_once_whatever_their_size(spark):
    """Joins with one row per slice, or with few choices, don't move the rows."""
    rows, before = frame(spark, skewed()), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        numbered = keys.number_rows(rows, ["t", "id"], "n")
        plan = arranged(rows, ["k"])
        summed = plan.running_sum(plan.frame, F.col("v"), "s")
        for out in (numbered, summed):
            assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    picked = keys.bucket_lookup(rows, ["id"], spark.range(20).withColumnRenamed("id", "c"), ["c"])
    assert "SortMergeJoin" not in picked._jdf.queryExecution().executedPlan().toString()


def test_small_keys_are_counted_by_bucket(spark, monkeypatch):
    """Counting keys moves a row per key and task; buckets are fewer, and tell that no key is large."""
    grouped, plain = [], type(spark.range(1)).groupBy
    monkeypatch.setattr(type(spark.range(1)), "groupBy", lambda df, *columns: grouped.append(tuple(map(str, columns))) or plain(df, *columns))
    rows = frame(spark, skewed())
    assert ordered.item_sequence(rows, "id", ["t"], "n").filter("n <> 1").isEmpty()
    assert ("id",) not in grouped
    assert ordered.item_sequence(rows, "k", ["t", "id"], "n", 20).count() == rows.count()
    assert ("k",) in grouped


def test_dense_keys(spark):
    rows = skewed(seed=13)
    out = keys.dense_keys(frame(spark, rows), ["k"], "d").collect()
    names = sorted({r[1] for r in rows}, key=lambda k: (k is not None, k))
    assert {(r.k, r.d) for r in out} == {(k, i + 1) for i, k in enumerate(names)}
    assert len(out) == len(rows)


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 12])
def test_ntile_matches_sql(spark, n):
    df = spark.createDataFrame([(i, i // 3) for i in range(n)], "id long, v long")
    have = keys.ntile(df, ["v", "id"], 5, "tile").collect()
    df.createOrReplaceTempView("tiles")
    want = spark.sql("SELECT id, v, ntile(5) OVER (ORDER BY v, id) AS tile FROM tiles").collect()
    assert sorted(map(tuple, have)) == sorted(map(tuple, want))


def test_zip_join(spark):
    left = spark.createDataFrame([(c,) for c in "dbca"], "l string")
    right = spark.createDataFrame([(i,) for i in (30, 10, 20)], "r long")
    out = keys.zip_join(left, right, ["l"], ["r"]).collect()
    assert {(r.l, r.r) for r in out} == {("a", 10), ("b", 20), ("c", 30)}


def test_round_robin_is_even(spark):
    rows = spark.range(10)
    choices = spark.createDataFrame([(0, "x"), (1, "y"), (2, "z")], "slot int, name string")
    out = keys.round_robin(rows, ["id"], choices, "slot").collect()
    assert {r.id: r.name for r in out} == {i: "xyz"[i % 3] for i in range(10)}


def test_bucket_lookup_gives_each_row_one_choice(spark):
    rows = spark.range(3000)
    choices = spark.createDataFrame([(c,) for c in "abcde"], "c string")
    out = keys.bucket_lookup(rows, ["id"], choices, ["c"], salt="s")
    counts = {r.c: r["count"] for r in out.groupBy("c").count().collect()}
    assert sum(counts.values()) == 3000 and len(counts) == 5 and min(counts.values()) > 450
    again = keys.bucket_lookup(rows, ["id"], choices, ["c"], salt="s")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, again.collect()))


def test_staged_rows_survive(spark):
    df = stage(spark.range(10).withColumn("r", F.rand()), "probe")
    assert df.collect() == df.collect()
    assert workspace(spark) in df.inputFiles()[0]


@pytest.mark.parametrize("task_rows", [0, 150, 10_000])
def test_item_sequence_of_small_and_large_keys(spark, task_rows):
    """Keys of few rows move once and are not written; large ones are split; both give the same numbers."""
    rows = skewed(seed=11)
    out = ordered.item_sequence(frame(spark, rows), "k", ["t", "id"], "n", task_rows)
    want = {row[0]: i for group in by_key(rows).values() for i, row in enumerate(group, 1)}
    assert {r.id: r.n for r in out.collect()} == want and out.columns == ["id", "k", "t", "v", "n"]
    if task_rows == 10_000:
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "slices-" not in plan and "rangepartitioning" not in plan
