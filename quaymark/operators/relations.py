"""Join, aggregate, sort and set forms that the tables above them are built from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import percent
from ..session import stage


def known_rows(df: DataFrame, reference: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key occurs in the reference."""
    return df.join(reference, on, "left_semi")


def unknown_rows(df: DataFrame, reference: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key does not occur in the reference."""
    return df.join(reference, on, "left_anti")


def roll_up(
    parent: DataFrame, child: DataFrame, key: str, totals: dict[str, Column], empty: dict[str, object]
) -> DataFrame:
    """Aggregate a child table per parent key and attach it, with defaults for parents without children."""
    sums = child.groupBy(key).agg(*[c.alias(n) for n, c in totals.items()])
    joined = parent.join(sums, key, "left")
    fills = {n: F.coalesce(F.col(n), F.lit(v).cast(joined.schema[n].dataType)) for n, v in empty.items()}
    return joined.withColumns(fills)


def group_count(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top_groups(df: DataFrame, keys: Sequence[str], name: str, n: int | None = None) -> DataFrame:
    """Groups by descending size; with `n`, only the largest (a top-k, not a full sort)."""
    ranked = group_count(df, keys, name).orderBy(F.desc(name), *keys)
    return ranked if n is None else ranked.limit(n)


def with_shares(df: DataFrame, names: Mapping[str, str], places: int = 2) -> DataFrame:
    """Percentage of each column's total.

    The (already aggregated) rows are written first, so that the totals and the rows read them without
    computing them twice; the totals come from one scalar subquery.
    """
    held = stage(df, "shares")
    totals = held.agg(F.struct(*[F.sum(c).alias(c) for c in names])).scalar()
    return held.withColumns({n: percent(F.col(c), totals[c], places) for c, n in names.items()})


def distinct_counts(df: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    """Distinct values of several columns per key: name -> column.

    Each column's values are made distinct on their own, partly before the shuffle, so rows are not multiplied by the
    number of columns. Nulls are not counted; a key without values counts zero.
    """
    out = None
    for name, column in columns.items():
        values = df.select(key, column).distinct().groupBy(key).agg(F.count(column).alias(name))
        renamed = values.withColumnRenamed(key, "_key")
        out = values if out is None else out.join(renamed, out[key].eqNullSafe(renamed["_key"])).drop("_key")
    return out
