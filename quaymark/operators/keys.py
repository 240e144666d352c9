"""Numbers over a whole table: row numbers, dense keys, tiles, zip and bucket joins.

None of these uses a window over the whole table. Rows are range partitioned, numbered inside each
slice, and shifted by the number of rows in the slices before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import key_number
from ..session import stage
from ..sources import files
from .ordered import POS, SLICE, slice_rows


def number_rows(
    df: DataFrame, order: Sequence[str | Column], name: str = "row_no", total: str | None = None
) -> DataFrame:
    """1 .. N over the whole table in a total order; optionally N itself in a second column."""
    placed = slice_rows(df, order)
    # one row per slice, so the window without keys below is over a bounded summary
    sizes = placed.groupBy(SLICE).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = sizes.select(
        SLICE,
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
        F.sum("_size").over(everything).alias("_all"),
    )
    # starts are as few as the slices; without the hint their size is taken for the table's and all rows move again
    out = placed.join(F.broadcast(starts), SLICE).withColumn(name, F.col("_start") + F.col(POS) + 1)
    if total:
        out = out.withColumn(total, F.col("_all"))
    return out.drop(SLICE, POS, "_start", "_all")


def dense_keys(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Number the distinct values of some columns from 1 without gaps and give each row its number.

    Duplicates combine on the map side, so the numbered table has one row per value. The join back
    has unique keys on that side; adaptive execution broadcasts it or splits a skewed side.
    """
    values = df.select(*columns).distinct()
    numbered = number_rows(values, columns, name)
    renamed = numbered.select(*[F.col(c).alias(f"_key_{c}") for c in columns], name)
    same = [df[c].eqNullSafe(renamed[f"_key_{c}"]) for c in columns]
    return df.join(renamed, same).drop(*[f"_key_{c}" for c in columns])


def _key_map(spark: SparkSession, base: str) -> dict:
    text = files.read_text(spark, f"{base}/KEYS")
    return json.loads(text) if text else {"parts": [], "last": 0}


def stable_keys(df: DataFrame, columns: Sequence[str], name: str, base: str) -> DataFrame:
    """Give each row the number of its values in a key map kept at `base`; new values are numbered behind the last one.

    Numbers never change: values already in the map are found by an anti join, and only the others are sorted, numbered
    and written, as one more part. A small text names the parts that count and is replaced in one step, so a run that
    dies leaves the map as it was, and a run over the same rows adds nothing. One run at a time extends a map.
    """
    spark, base = df.sparkSession, base.rstrip("/")
    known = _key_map(spark, base)
    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in columns] + [T.StructField(name, T.LongType())])

    def named(part_paths: list[str]) -> DataFrame:
        found = spark.read.schema(schema).parquet(*part_paths) if part_paths else spark.createDataFrame([], schema)
        return found.select(*[F.col(c).alias(f"_key_{c}") for c in columns], name)

    def same(left: DataFrame, right: DataFrame) -> list[Column]:
        return [left[c].eqNullSafe(right[f"_key_{c}"]) for c in columns]

    values, old = df.select(*columns).distinct(), named(known["parts"])
    new = number_rows(values.join(old, same(values, old), "left_anti"), columns, name)
    part = f"{base}/parts/{uuid.uuid4().hex}"
    new.select(*columns, (F.col(name) + known["last"]).alias(name)).write.parquet(part)
    added = spark.read.schema(schema).parquet(part).count()
    if added:
        known = {"parts": [*known["parts"], part], "last": known["last"] + added}
        files.replace_text(spark, f"{base}/KEYS", json.dumps(known))
    else:
        files.remove(spark, part)
    keyed = named(known["parts"])
    return df.join(keyed, same(df, keyed)).drop(*[f"_key_{c}" for c in columns])


def tile(row_no: Column, rows: Column, tiles: int) -> Column:
    """NTILE from a row number: the first (rows mod tiles) tiles get one row more."""
    small = F.floor(rows / tiles)
    extra = rows % tiles
    edge = extra * (small + 1)
    in_large = F.floor(F.try_divide(row_no - 1, small + 1)) + 1
    in_small = extra + F.floor(F.try_divide(row_no - 1 - edge, small)) + 1
    return F.when(row_no <= edge, in_large).otherwise(in_small).cast("int")


def ntile(df: DataFrame, order: Sequence[str | Column], tiles: int, name: str) -> DataFrame:
    numbered = number_rows(df, order, "_row_no", "_rows")
    return numbered.withColumn(name, tile(F.col("_row_no"), F.col("_rows"), tiles)).drop("_row_no", "_rows")


def zip_join(
    left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str]
) -> DataFrame:
    """Pair the n-th row of one side with the n-th row of the other."""
    first = number_rows(left, left_order, "row_no")
    second = number_rows(right, right_order, "row_no")
    return first.join(second, "row_no")


def round_robin(df: DataFrame, order: Sequence[str], choices: DataFrame, slot: str) -> DataFrame:
    """Deal the rows of a table, in order, over choices whose slots run from 0 without gaps."""
    count = choices.agg(F.max(slot) + 1).scalar()
    turn = number_rows(df, order, "_turn").withColumn("_slot", F.pmod(F.col("_turn") - 1, count))
    return turn.join(choices, F.col("_slot") == choices[slot]).drop("_turn", "_slot")


def bucket_lookup(
    df: DataFrame, key: Sequence[str], choices: DataFrame, order: Sequence[str], salt: str = ""
) -> DataFrame:
    """Give each row one row of another table, picked by a hash of the row's key.

    The choices are numbered from 0 and joined on that number, so they may be a table of any size. The numbered choices
    are written, so that their size is known and few of them are sent to the rows, not the rows to them.
    """
    numbered = number_rows(choices, order, "_choice", "_choices").withColumn("_choice", F.col("_choice") - 1)
    numbered = stage(numbered, "choices")
    size = numbered.agg(F.max("_choices")).scalar()
    seed = [F.lit(salt)] if salt else []
    slot = F.pmod(key_number(*seed, *[F.col(k) for k in key]), size)
    picked = df.withColumn("_slot", slot)
    return picked.join(numbered, F.col("_slot") == F.col("_choice"), "left").drop("_slot", "_choice", "_choices")
