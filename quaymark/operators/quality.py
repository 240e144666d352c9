"""Data quality profile: rows, duplicate rows and nulls per column in one job."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from ..sources import files

VALIDATION_SCHEMA = T.StructType(
    [
        T.StructField("is_valid", T.BooleanType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("column_count", T.IntegerType()),
        T.StructField("duplicate_count", T.LongType()),
        T.StructField("null_count", T.LongType()),
        T.StructField("null_details", T.MapType(T.StringType(), T.LongType())),
        T.StructField("schema_valid", T.BooleanType()),
        T.StructField("error_messages", T.ArrayType(T.StringType())),
        T.StructField("warning_messages", T.ArrayType(T.StringType())),
    ]
)


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column with its number of nulls, from a single aggregate."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "null_count")


def row_digest(columns: Sequence[str]) -> Column:
    """256-bit fingerprint of a row, for tables too wide to shuffle as grouping keys."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def _distinct_rows(df: DataFrame, wide: bool) -> DataFrame:
    """One row per distinct input row with its number of copies and one null mark per column."""
    if not wide:
        grouped = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
        return grouped.select("_copies", *[F.col(c).isNull().alias(c) for c in df.columns])
    marks = [F.col(c).isNull().alias(c) for c in df.columns]
    keyed = df.select(row_digest(df.columns).alias("_digest"), *marks)
    return keyed.groupBy("_digest", *df.columns).agg(F.count(F.lit(1)).alias("_copies")).drop("_digest")


def profile(df: DataFrame, wide: bool = False) -> DataFrame:
    """One row: row_count, duplicate_count and a map of null counts, from one pass over the data.

    Copies of a row combine on the map side. With `wide`, rows are compared by fingerprint, so the
    shuffle carries 64 characters per row and not whole texts.
    """
    rows = _distinct_rows(df, wide)
    nulls = [F.coalesce(F.sum(F.when(F.col(c), F.col("_copies"))), F.lit(0)).alias(c) for c in df.columns]
    totals = rows.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("_duplicates"),
        *nulls,
    )
    pairs = [p for c in df.columns for p in (F.lit(c), F.col(c))]
    return totals.select(
        F.col("_rows").alias("row_count"),
        F.col("_duplicates").alias("duplicate_count"),
        F.create_map(*pairs).alias("null_details"),
    )


#: Columns whose null marks share a number.
MARKS = 62


def counted_profile(df: DataFrame, wide: bool = False) -> DataFrame:
    """The row of `profile`, counted now. Rows without copies move as a hash of 8 bytes and their null marks.

    Equal rows have equal hashes, so as many hashes as rows means that no row is there twice. Only if a hash comes again,
    from a copy or by chance, are whole rows compared, in a second pass. Texts with a collation are equal in other ways.
    """
    if "collate" in df.schema.simpleString():
        return profile(df, wide)
    groups = [df.columns[i : i + MARKS] for i in range(0, len(df.columns), MARKS)]
    marks = [f"_marks_{i}" for i in range(len(groups))]
    bits = {c: (name, F.lit(1 << i).cast("bigint")) for name, own in zip(marks, groups) for i, c in enumerate(own)}

    def mark(own: Sequence[str]) -> Column:
        out = F.lit(0).cast("bigint")
        for c in own:
            out = out.bitwiseOR(F.when(F.col(c).isNull(), bits[c][1]).otherwise(F.lit(0).cast("bigint")))
        return out

    hashed = df.select(F.xxhash64(*df.columns).alias("_hash"), *[mark(own).alias(name) for name, own in zip(marks, groups)])
    found = hashed.groupBy("_hash", *marks).agg(F.count(F.lit(1)).alias("_copies"))
    nulls = [F.coalesce(F.sum(F.when(F.col(name).bitwiseAND(bit) != 0, F.col("_copies"))), F.lit(0)) for name, bit in bits.values()]
    hashes, rows, *null_totals = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("_copies"), F.lit(0)), *nulls).first()
    if hashes < rows:
        return profile(df, wide)
    pairs = [F.lit(x) for c, n in zip(df.columns, null_totals) for x in (c, n)]
    counts = {"row_count": F.lit(rows), "duplicate_count": F.lit(0), "null_details": F.create_map(*pairs)}
    types = {"null_details": "map<string,bigint>"}
    return df.sparkSession.range(1).select(*[c.cast(types.get(name, "bigint")).alias(name) for name, c in counts.items()])


def extended_profile(rows: DataFrame, base: str, part: str) -> DataFrame:
    """Profile of all partitions so far, after adding one: the row of `profile` over all their rows, reading only new ones.

    Kept at `base` are the totals and one digest per distinct row. A partition's rows become digests with their copies and
    null marks; digests that are not there yet are written as one more file set, and the text that names the file sets
    and totals is replaced in one step. A partition that is there already is not added again. One run at a time extends a
    profile, and all partitions have the same columns.
    """
    spark, base = rows.sparkSession, base.rstrip("/")
    text = files.read_text(spark, f"{base}/PROFILE")
    known = json.loads(text) if text else {"columns": rows.columns, "rows": 0, "distinct": 0, "nulls": dict.fromkeys(rows.columns, 0), "parts": {}}
    if known["columns"] != rows.columns:
        raise ValueError(f"the profile is of the columns {known['columns']}")
    if part not in known["parts"]:
        marks = [F.col(c).isNull().alias(f"null_{i}") for i, c in enumerate(rows.columns)]
        digests = rows.select(F.unhex(row_digest(rows.columns)).alias("digest"), *marks).groupBy("digest")
        # rows of one digest are equal, and so are their marks
        counted = stage(digests.agg(F.count(F.lit(1)).alias("copies"), *[F.max(f"null_{i}").alias(f"null_{i}") for i in range(len(marks))]), "counted")
        nulls = [F.coalesce(F.sum(F.when(F.col(f"null_{i}"), F.col("copies"))), F.lit(0)) for i in range(len(marks))]
        total, *null_totals = counted.agg(F.coalesce(F.sum("copies"), F.lit(0)), *nulls).first()
        old = [p for p in known["parts"].values() if p]
        new = counted.select("digest")
        if old:
            new = new.join(spark.read.schema("digest binary").parquet(*old), "digest", "left_anti")
        path = f"{base}/digests/{uuid.uuid4().hex}"
        new.write.parquet(path)
        known["rows"] += total
        known["distinct"] += spark.read.schema("digest binary").parquet(path).count()
        known["nulls"] = {c: known["nulls"][c] + n for c, n in zip(rows.columns, null_totals)}
        known["parts"][part] = path
        files.replace_text(spark, f"{base}/PROFILE", json.dumps(known))
    row = (known["rows"], known["rows"] - known["distinct"], known["nulls"])
    return spark.createDataFrame([row], "row_count long, duplicate_count long, null_details map<string, long>")


def schema_problems(df: DataFrame, expected: T.StructType | None) -> list[str]:
    """Differences between a frame and the schema it should have."""
    if not df.columns:
        return ["the frame has no columns"]
    if expected is None:
        return []
    have = {f.name: f.dataType for f in df.schema}
    problems = [f"column {f.name} is missing" for f in expected if f.name not in have]
    problems += [
        f"column {f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}"
        for f in expected
        if f.name in have and have[f.name] != f.dataType
    ]
    return problems


def _report(df: DataFrame, counts: DataFrame, problems: list[str], empty_is_error: bool, all_nulls: bool) -> DataFrame:
    null_count = F.aggregate(F.map_values("null_details"), F.lit(0).cast("bigint"), lambda a, b: a + b)
    some = F.map_filter("null_details", lambda _, n: n > 0)
    empty = F.when(F.col("row_count") == 0, F.lit("the table is empty")) if empty_is_error else F.lit(None)
    errors = F.array_compact(F.array(empty.cast("string"), *[F.lit(p) for p in problems]))
    duplicates = F.when(
        F.col("duplicate_count") > 0, F.format_string("%d duplicate rows", F.col("duplicate_count"))
    )
    in_columns = F.concat(F.lit("nulls in "), F.array_join(F.array_sort(F.map_keys(some)), ", "))
    nulls = F.when(F.size(some) > 0, in_columns)
    return counts.select(
        (F.size(errors) == 0).alias("is_valid"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        "duplicate_count",
        null_count.alias("null_count"),
        (F.col("null_details") if all_nulls else some).alias("null_details"),
        F.lit(not problems).alias("schema_valid"),
        errors.alias("error_messages"),
        F.array_compact(F.array(duplicates, nulls)).alias("warning_messages"),
    )


def bronze_report(df: DataFrame, expected: T.StructType | None = None, wide: bool = False) -> DataFrame:
    """Valid unless empty or off its schema; null details keep only columns that have nulls."""
    return _report(df, profile(df, wide), schema_problems(df, expected), True, False)


def counted_bronze_report(df: DataFrame, expected: T.StructType | None = None, wide: bool = False) -> DataFrame:
    """The row of `bronze_report`, counted now and with less moved."""
    return _report(df, counted_profile(df, wide), schema_problems(df, expected), True, False)


def silver_report(df: DataFrame, expected: T.StructType | None = None, wide: bool = False) -> DataFrame:
    """Valid unless the schema is wrong; null details keep every column."""
    return _report(df, profile(df, wide), schema_problems(df, expected), False, True)
