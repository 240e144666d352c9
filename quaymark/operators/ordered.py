"""Ordered scans per key that never put an unbounded group into one task.

Lag, running sums and numbering need the rows of a key in order, and one key may hold a large part of the
table. So rows are range partitioned on (key, order), which splits a key over as many slices as its rows
need. Every (slice, key) is scanned on its own, and what a slice must know of the slices before it (the last
value, the sum so far) comes from a summary with at most two rows per slice. There is one way for every size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage, unstage

SLICE, POS, CROSSES = "_slice", "_pos", "_crosses"
_POS_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def _as_columns(columns: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in columns]


def slice_rows(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Range partition and sort, then write each row with its slice and its position in the slice.

    The written copy fixes the slices: counting them and reading them see the same rows, also after
    an executor is lost. `order` must identify a row, so that equal sort values can be split too. There
    are at most spark.sql.shuffle.partitions slices; adaptive execution joins small neighbours.
    """
    columns = _as_columns(order)
    mark = F.monotonically_increasing_id()
    laid = (
        df.repartitionByRange(*columns)
        .sortWithinPartitions(*columns)
        .withColumn("_mark", mark)
        .withColumn(SLICE, F.shiftright("_mark", _POS_BITS))
        .withColumn(POS, F.col("_mark").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
        .drop("_mark")
    )
    return stage(laid, "slices")


@dataclass(frozen=True)
class OrderedRows:
    """Rows arranged so that values can flow from one row of a key to the next."""

    frame: DataFrame
    keys: tuple[str, ...]
    order: tuple[str | Column, ...]

    @property
    def window(self):
        # the mark depends on the slice and key; as a window key, a filter on it moves below the window
        return Window.partitionBy(SLICE, CROSSES, *self.keys).orderBy(*self.order)

    def previous(self, frame: DataFrame, column: str, name: str) -> DataFrame:
        """Value of a column in the row before, null in the first row of a key."""
        tails = self._crossing(frame).groupBy(SLICE, *self.keys).agg(F.max_by(column, POS).alias("_tail"))
        carry = tails.withColumn("_carry", F.lag("_tail").over(self._across)).drop("_tail")
        marked = frame.withColumns(
            {"_here": F.lag(column).over(self.window), "_head": F.lag(F.lit(1)).over(self.window).isNull()}
        )
        value = F.when(F.col("_head"), F.col("_carry")).otherwise(F.col("_here"))
        return self._attach(marked, carry).withColumn(name, value).drop("_here", "_head", "_carry")

    def running_sum(self, frame: DataFrame, value: Column, name: str, inclusive: bool = True) -> DataFrame:
        """Sum of the rows so far, with or without the row itself; zero before the first."""
        last = Window.currentRow if inclusive else -1
        here = F.coalesce(F.sum(value).over(self.window.rowsBetween(Window.unboundedPreceding, last)), F.lit(0))
        totals = self._crossing(frame).groupBy(SLICE, *self.keys).agg(F.sum(value).alias("_total"))
        before = self._across.rowsBetween(Window.unboundedPreceding, -1)
        carry = totals.withColumn("_carry", F.sum("_total").over(before)).drop("_total")
        summed = self._attach(frame.withColumn("_here", here), carry)
        return summed.withColumn(name, F.col("_here") + F.coalesce("_carry", F.lit(0))).drop("_here", "_carry")

    def number(self, frame: DataFrame, name: str) -> DataFrame:
        """1, 2, 3 ... within a key."""
        return self.running_sum(frame, F.lit(1), name).withColumn(name, F.col(name).cast("bigint"))

    def done(self, frame: DataFrame) -> DataFrame:
        return frame.drop(SLICE, POS, CROSSES)

    @property
    def _across(self):
        return Window.partitionBy(*self.keys).orderBy(SLICE)

    def _crossing(self, frame: DataFrame) -> DataFrame:
        return frame.filter(F.col(CROSSES))

    def _attach(self, frame: DataFrame, carry: DataFrame) -> DataFrame:
        renamed = carry.select(
            F.col(SLICE).alias("_carry_slice"), *[F.col(k).alias(f"_carry_{k}") for k in self.keys], "_carry"
        )
        same = [F.col(SLICE) == F.col("_carry_slice")]
        same += [F.col(k).eqNullSafe(F.col(f"_carry_{k}")) for k in self.keys]
        helper = ["_carry_slice", *[f"_carry_{k}" for k in self.keys]]
        # at most two rows per slice
        return frame.join(F.broadcast(renamed), same, "left").drop(*helper)


def _mark_crossing(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mark the rows of keys that may span slices: a key found at the start of a slice, one per slice."""
    if not keys:
        return placed.withColumn(CROSSES, F.lit(True))
    starts = placed.filter(F.col(POS) == 0).select(*[F.col(k).alias(f"_start_{k}") for k in keys]).distinct()
    marks = starts.withColumn(CROSSES, F.lit(True))
    same = [F.col(k).eqNullSafe(F.col(f"_start_{k}")) for k in keys]
    marked = placed.join(F.broadcast(marks), same, "left").drop(*[f"_start_{k}" for k in keys])
    return marked.withColumn(CROSSES, F.coalesce(CROSSES, F.lit(False)))


def ordered(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> OrderedRows:
    """Arrange rows by key and order; together they must identify a row."""
    return OrderedRows(_mark_crossing(slice_rows(df, [*keys, *order]), keys), tuple(keys), tuple(order))


#: Rows of one key that a task sorts; larger keys are split over slices.
TASK_ROWS = 200_000
#: Parts that parents are dealt to for a first, coarse count.
COARSE = 1 << 14


def item_sequence(
    df: DataFrame, parent: str | Sequence[str], order: Sequence[str | Column], name: str, task_rows: int = TASK_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Number the rows of a parent from 1 in a total order.

    Rows are counted per bucket of parents first, and per parent only in buckets of more than `task_rows` rows, as no parent
    has more rows than its bucket. Parents of few rows move once, to the task that sorts them; only the rows of
    larger ones are written in slices. The large parents are fewer than the rows divided by `task_rows`. `counted`: rows
    with the same parents that are cheaper to count, if `df` is a join.
    """
    keys = [parent] if isinstance(parent, str) else list(parent)
    counted = df if counted is None else counted
    bucket = F.pmod(F.xxhash64(*keys), F.lit(COARSE))
    coarse = counted.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > task_rows)
    full = [r[0] for r in coarse.select("_bucket").collect()]
    if not full:
        return _numbered(df, keys, order, name)
    counts = counted.filter(bucket.isin(full)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > task_rows)
    large = stage(counts.select(*[F.col(k).alias(f"_large_{k}") for k in keys]), "large")

    if large.isEmpty():
        unstage(large)
        return _numbered(df, keys, order, name)
    same = [F.col(k).eqNullSafe(F.col(f"_large_{k}")) for k in keys]
    rows = ordered(df.join(F.broadcast(large), same, "left_semi"), keys, order)
    split = rows.done(rows.number(rows.frame, name))
    small = df.join(F.broadcast(large), same, "left_anti")
    return _numbered(small, keys, order, name).unionByName(split)


def _numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, place.cast("bigint"))


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    The filter on row number 1 lets Spark keep one row per key on the map side, so a large key sends
    only one row per input partition.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")
