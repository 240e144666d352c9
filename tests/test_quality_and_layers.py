from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaymark.operators import cleaning, quality
from quaymark.plans import layers, records
from quaymark.session import new_folder
from quaymark.sources import files, readers, writers

SCHEMA = "a long, b string"


@pytest.mark.parametrize("wide", [False, True])
def test_profile(spark, wide):
    rows = [(1, "x"), (1, "x"), (1, None), (None, None), (None, None), (None, None)]
    found = quality.profile(spark.createDataFrame(rows, SCHEMA), wide).first()
    assert (found.row_count, found.duplicate_count, found.null_details) == (6, 3, {"a": 3, "b": 4})


@pytest.mark.parametrize(
    "rows",
    [
        [(1, "x"), (1, None), (None, "x"), (None, None), (2, "x")],
        [(1, "x"), (1, "x"), (1, None), (None, None), (None, None)],
        [],
    ],
)
def test_counted_profile(spark, rows):
    """Equal to the profile with and without copies; nulls are left out of a hash, so rows that differ by them have the same."""
    df = spark.createDataFrame(rows, SCHEMA)
    many = df.select("*", *[F.when(F.col("a") == 1, F.lit(i)).alias(f"c{i}") for i in range(130)], (F.col("a") * -0.0).alias("z"))
    for frame in (df, many, df.unionByName(df)):
        assert quality.counted_profile(frame).first() == quality.profile(frame).first()
        assert quality.counted_profile(frame).schema.simpleString() == quality.profile(frame).schema.simpleString()


def test_rows_without_copies_are_not_compared_whole(spark, monkeypatch):
    """The export of a table moves whole rows only if a hash comes twice."""
    monkeypatch.setattr(quality, "_distinct_rows", lambda *_: pytest.fail("whole rows were moved"))
    done = layers.run_bronze(spark.createDataFrame([(1, "x"), (None, "x"), (2, None)], SCHEMA), new_folder(spark, "bronze"), "bronze", "things")
    assert done.row_count == 3 and not any("duplicate" in w for w in done.warnings)


@pytest.mark.parametrize("wide", [False, True])
def test_empty_table(spark, wide):
    empty = spark.createDataFrame([], SCHEMA)
    bronze, silver = quality.bronze_report(empty, wide=wide).first(), quality.silver_report(empty, wide=wide).first()
    assert not bronze.is_valid and bronze.error_messages == ["the table is empty"] and bronze.null_details == {}
    assert silver.is_valid and silver.null_details == {"a": 0, "b": 0}


def test_schema_is_compared(spark):
    df = spark.createDataFrame([(1, "x")], SCHEMA)
    expected = T.StructType([T.StructField("a", T.StringType()), T.StructField("c", T.LongType())])
    report = quality.silver_report(df, expected).first()
    assert not report.is_valid and not report.schema_valid and len(report.error_messages) == 2


def test_quarantine_gives_every_reason_and_loses_nothing(spark):
    rows = [("k", 1, "p"), (None, None, "q"), ("k", 1, "q"), ("k", 1, None), ("k", 1, "p")]
    df = spark.createDataFrame(rows, "acc string, t long, product string")
    known = spark.createDataFrame([("p",), ("p",)], "product string")
    judged = cleaning.with_reasons(df, ["acc", "t", "product"], "product", known, "product", "product is unknown")
    valid, bad = cleaning.split_valid(judged)
    assert valid.count() + bad.count() == len(rows) and valid.count() == 2
    reasons = sorted(r.reasons for r in bad.collect())
    assert ["acc is null", "t is null", "product is unknown"] in reasons and ["product is null"] in reasons


def test_names_must_be_text(spark):
    for bad, error in ((7, TypeError), (" ", ValueError)):
        with pytest.raises(error):
            readers.read_table(spark, "spark_catalog", "default", bad)
    with pytest.raises(FileNotFoundError):
        readers.run_named(spark, "nothing")
    with pytest.raises(ValueError):
        writers.write_csv(spark.range(1), "/tmp", "bronze", "x", mode="sometimes")


def test_tables_are_listed_and_found(spark):
    name = "quaymark_listed"
    writers.write_table(spark.range(3), "spark_catalog", "default", name, path=new_folder(spark, "t"))
    assert name in readers.list_tables(spark, "spark_catalog", "default")
    assert readers.table_exists(spark, "spark_catalog", "default", name)
    assert not readers.table_exists(spark, "spark_catalog", "default", "missing_one")
    assert readers.read_table(spark, "spark_catalog", "default", name).count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_publish_checks_the_copy(spark):
    df = spark.range(100)
    staged = writers.write_path(df, new_folder(spark, "staged"))
    target = new_folder(spark, "target")
    assert writers.publish(spark, df, staged, target, "parquet", df.schema).first().row_count == 100
    empty = writers.write_path(df.limit(0), new_folder(spark, "staged"))
    with pytest.raises(writers.PublishError):
        writers.publish(spark, df.limit(0), empty, new_folder(spark, "target"), "parquet", df.schema)
    with pytest.raises(writers.PublishError):
        writers.publish(spark, spark.range(1, 101), staged, new_folder(spark, "target"), "parquet", df.schema)


def test_fingerprint_ignores_order_but_not_values(spark):
    a = spark.range(1000)
    assert writers.fingerprint(a).first() == writers.fingerprint(a.repartition(7).orderBy(F.desc("id"))).first()
    assert writers.fingerprint(a).first() != writers.fingerprint(spark.range(1, 1001)).first()


def test_bronze_layer(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], SCHEMA)
    done = layers.run_bronze(df, new_folder(spark, "bronze"), "bronze", "things")
    row = done.record.first()
    assert (row.dataset, row.format, row.row_count, row.null_details, row.columns) == ("things", "csv", 2, {"b": 1}, ["a", "b"])
    assert done.path and spark.read.option("header", True).csv(done.path).count() == 2
    with pytest.raises(ValueError):
        layers.run_bronze(df.limit(0), new_folder(spark, "bronze"), "bronze", "things")


def test_bronze_keeps_one_copy(spark):
    base = new_folder(spark, "bronze")
    done = layers.run_bronze(spark.createDataFrame([(1, "x"), (2, None)], SCHEMA), base, "bronze", "things")
    assert done.path and done.staged is None and files.children(spark, f"{base}/staging/bronze/things") == []


def test_texts_survive_the_publish(spark):
    texts = ["two\nlines", "", None, '"quoted", with comma', "  blanks  ", "\r\n", "back\\slash", "é 日本"]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    done = layers.run_bronze(df, new_folder(spark, "bronze"), "bronze", "texts")
    assert done.path
    back = readers.read_path(spark, done.path, "csv", df.schema, **writers.CSV_OPTIONS)
    assert {r.a: r.b for r in back.collect()} == dict(enumerate(texts))


def test_silver_layer_runs_its_transform_once(spark):
    calls = []

    def transform(df):
        calls.append(1)
        return df.withColumn("c", F.col("a") + 1)

    df = spark.createDataFrame([(1, "x")], SCHEMA)
    args = ("spark_catalog", "default", "quaymark_things")
    done = layers.run_silver(df, transform, new_folder(spark, "silver"), *args, table_path=new_folder(spark, "table"))
    again = layers.run_silver(df, transform, new_folder(spark, "silver"), *args, table_path=new_folder(spark, "table"))
    assert len(calls) == 2 and done.row_count == again.row_count == 1
    assert spark.read.parquet(done.path).collect() == spark.read.table("quaymark_things").collect()
    spark.sql("DROP TABLE quaymark_things")


def test_layer_rules_on_failure(spark):
    def good():
        return layers.Outcome(None, 5, spark.range(1))

    def bad():
        raise ValueError("no")

    jobs = {"one": good, "two": bad, "three": good}
    on = layers.run_layer(spark, jobs, stop_on_error=False, raise_at_end=False).collect()
    assert [r.status for r in on] == ["SUCCESS", "FAILED", "SUCCESS"]
    with pytest.raises(layers.LayerFailed) as failure:
        layers.run_layer(spark, jobs, stop_on_error=True)
    assert [r.table_name for r in failure.value.summary.collect()] == ["one", "two"]


def test_bronze_record_knows_its_formats(spark):
    report = quality.bronze_report(spark.range(1))
    with pytest.raises(ValueError):
        records.bronze_record(report, ["id"], "d", "bronze", "/p", "orc")
    with pytest.raises(ValueError):
        records.bronze_record(report, ["id"], " ", "bronze", "/p")
    assert '"dataset":"d"' in records.as_json(records.bronze_record(report, ["id"], "d", "bronze", "/p")).first().record
