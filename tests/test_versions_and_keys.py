"""Two-phase publishing and key maps that grow."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quaymark.operators import keys
from quaymark.session import new_folder
from quaymark.sources import files, versions, writers


def put(spark, base, source, copy=None, fmt="parquet", **options):
    return versions.publish(spark, source, source if copy is None else copy, base, fmt, source.schema, **options)


def read(spark, base, source):
    return sorted(r.id for r in versions.read_current(spark, base, "parquet", source.schema).collect())


def test_a_failed_check_leaves_the_version_before_it(spark):
    base, one = new_folder(spark, "published"), spark.range(100)
    first = put(spark, base, one)
    for source, copy in ((one, spark.range(1, 101)), (one, spark.range(99)), (one.limit(0), one.limit(0))):
        with pytest.raises(versions.PublishError):
            put(spark, base, source, copy)
        assert versions.current(spark, base) == first and read(spark, base, one) == list(range(100))
    # what failed is gone again
    assert files.children(spark, f"{base}/versions") == [first.name]


def test_files_are_published_by_moving_them(spark):
    base, one, staged = new_folder(spark, "published"), spark.range(100), new_folder(spark, "staged")
    sent, seen = versions.observed(one)
    sent.write.parquet(staged)
    wrong = {**seen.get, "row_count": 99}
    with pytest.raises(versions.PublishError):
        versions.publish_files(spark, wrong, staged, base, "parquet", one.schema)
    # a copy that differs stays where it is and is not read
    assert files.exists(spark, staged) and versions.current(spark, base) is None and files.children(spark, f"{base}/versions") == []
    done = versions.publish_files(spark, seen.get, staged, base, "parquet", one.schema)
    assert done.row_count == 100 and read(spark, base, one) == list(range(100)) and not files.exists(spark, staged)
    assert versions.damaged_files(spark, base, "parquet", one.schema).isEmpty()


def test_nothing_is_read_before_the_first_publish(spark):
    base = new_folder(spark, "published")
    assert versions.current(spark, base) is None and versions.clean(spark, base) == []
    for call in (lambda: versions.rollback(spark, base), lambda: read(spark, base, spark.range(1))):
        with pytest.raises(versions.PublishError):
            call()


def test_a_staged_version_is_not_read_until_the_switch(spark):
    base, one, two = new_folder(spark, "published"), spark.range(3), spark.range(10, 15)
    put(spark, base, one)
    staged = versions.stage_version(spark, two, base, "parquet", two.schema)
    assert read(spark, base, one) == [0, 1, 2]
    open_reader = versions.read_current(spark, base, "parquet", one.schema)
    versions.switch(spark, base, staged)
    assert read(spark, base, one) == [10, 11, 12, 13, 14]
    # a reader that had begun still reads what it began with
    assert open_reader.count() == 3


def test_rollback_reads_the_version_before(spark):
    base = new_folder(spark, "published")
    names = [put(spark, base, spark.range(n)).name for n in (1, 2, 3)]
    assert versions.rollback(spark, base).name == names[1] and read(spark, base, spark.range(1)) == [0, 1]
    assert versions.rollback(spark, base).name == names[0]
    with pytest.raises(versions.PublishError):
        versions.rollback(spark, base)
    fourth = put(spark, base, spark.range(4))
    assert fourth.previous == names[0]
    assert set(versions.clean(spark, base)) == {names[1], names[2]} and read(spark, base, spark.range(1)) == [0, 1, 2, 3]
    assert versions.rollback(spark, base).name == names[0]


def test_damaged_files_are_found(spark):
    base, rows = new_folder(spark, "published"), spark.range(1_000).repartition(4)
    done = put(spark, base, rows)
    assert versions.damaged_files(spark, base, "parquet", rows.schema).isEmpty()
    spark.range(7).coalesce(1).write.mode("append").parquet(done.path)
    (found,) = versions.damaged_files(spark, base, "parquet", rows.schema).collect()
    assert found.described is None and found.found.row_count == 7


@pytest.mark.parametrize("fmt,options", [("parquet", {}), ("csv", writers.CSV_OPTIONS), ("json", {})])
def test_other_formats(spark, fmt, options):
    rows = spark.createDataFrame([(1, "a"), (2, 'x "y"\nz'), (3, None)], "id long, text string")
    base = new_folder(spark, "published")
    version = put(spark, base, rows, fmt=fmt, **options)
    assert version.row_count == 3
    assert versions.read_current(spark, base, fmt, rows.schema, **options).exceptAll(rows).isEmpty()


def test_small_files_are_replaced_in_one_step(spark):
    path = f"{new_folder(spark, 'texts')}/note"
    assert files.read_text(spark, path) is None
    for text in ("one", "zwei ä 日", ""):
        files.replace_text(spark, path, text)
        assert files.read_text(spark, path) == text
    assert files.children(spark, path.rsplit("/", 1)[0]) == ["note"]


# ---------------------------------------------------------------- key maps


def numbers(frame):
    return {r.name: r.no for r in frame.collect()}


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "name string")


def test_new_values_change_no_key(spark):
    base = new_folder(spark, "keys")
    first = numbers(keys.stable_keys(names(spark, "m", "c", "x", "c"), ["name"], "no", base))
    assert first == {"c": 1, "m": 2, "x": 3}
    second = numbers(keys.stable_keys(names(spark, "a", "m", None, "z", "c"), ["name"], "no", base))
    assert second == {None: 4, "a": 5, "z": 6, "m": 2, "c": 1}
    # values that no longer come keep their number
    assert numbers(keys.stable_keys(names(spark, "x", "b"), ["name"], "no", base)) == {"x": 3, "b": 7}


def test_a_rerun_adds_nothing(spark):
    base, rows = new_folder(spark, "keys"), names(spark, *"qwertyuiop", None)
    before = numbers(keys.stable_keys(rows, ["name"], "no", base))
    text = files.read_text(spark, f"{base}/KEYS")
    assert numbers(keys.stable_keys(rows, ["name"], "no", base)) == before
    assert files.read_text(spark, f"{base}/KEYS") == text and len(files.children(spark, f"{base}/parts")) == 1


def test_a_run_that_died_before_its_commit_counts_for_nothing(spark):
    base = new_folder(spark, "keys")
    keys.stable_keys(names(spark, "a"), ["name"], "no", base)
    spark.createDataFrame([("b", 99)], "name string, no long").write.parquet(f"{base}/parts/dead")
    assert numbers(keys.stable_keys(names(spark, "a", "b"), ["name"], "no", base)) == {"a": 1, "b": 2}


def test_no_rows_and_several_columns(spark):
    base = new_folder(spark, "keys")
    assert numbers(keys.stable_keys(names(spark), ["name"], "no", base)) == {}
    pairs = spark.createDataFrame([(1, "a"), (1, None), (None, "a"), (1, "a")], "x long, y string")
    found = keys.stable_keys(pairs, ["x", "y"], "no", new_folder(spark, "keys"))
    assert found.count() == 4 and {(r.x, r.y): r.no for r in found.collect()} == {(None, "a"): 1, (1, None): 2, (1, "a"): 3}


def test_many_values_are_numbered_without_gaps(spark):
    base = new_folder(spark, "keys")
    for size in (3_000, 5_000, 5_000):
        found = keys.stable_keys(spark.range(size).select((F.col("id") * 7 % 5_000).cast("string").alias("name")).distinct(), ["name"], "no", base)
        assert found.select("no").distinct().count() == found.count() == size
    assert found.agg(F.min("no"), F.max("no")).first()[:] == (1, 5_000)


def test_hash_sums_are_exact(spark):
    """Sums of hashes of either sign, by parts of them, are those of whole numbers, and no decimal is added per row."""
    rows = spark.range(5000).select("id", F.when(F.col("id") % 7 > 0, F.md5(F.col("id").cast("string"))).alias("text"))
    want = sum(r[0] for r in rows.select(F.xxhash64("id", "text")).collect())
    found = versions.fingerprint(rows)
    assert found.first() == (5000, want) and versions.fingerprint(rows.limit(0)).first() == (0, 0)
    sent, seen = versions.observed(rows)
    assert sent.columns == rows.columns and sent.count() == 5000 and seen.get["hash_sum"] == want
    assert "sum(cast(" not in found._jdf.queryExecution().optimizedPlan().toString()
    edges = spark.createDataFrame([(x,) for x in (-(1 << 63), (1 << 63) - 1, -1, 0, 1, -(1 << 43), (1 << 43) - 1, 1 << 22)] * 3, "h long")
    assert edges.agg(versions._hash_sum(F.col("h"))).first()[0] == sum(r.h for r in edges.collect())
