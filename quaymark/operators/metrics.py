"""Metric analytics over long samples (ts, measurement, field, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import ratio
from .ordered import ordered

# Percentiles reported for timings, and alert thresholds.
PERCENTILES = (0.5, 0.9, 0.95, 0.99, 0.999)
FAILURE_WARNING, FAILURE_CRITICAL = 0.10, 0.25
P95_FACTOR, P99_FACTOR = 2.0, 5.0
HEARTBEAT_SECONDS = 60


def tumbling(samples: DataFrame, every: str, by: Sequence[str], aggs: Sequence[Column], ts: str = "ts") -> DataFrame:
    """Aggregate per fixed window; works on batch and streaming frames. Empty windows give no row."""
    out = samples.groupBy(F.window(ts, every).alias("_window"), *by).agg(*aggs)
    names = [c for c in out.columns if c not in ("_window", *by)]
    return out.select(
        F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *by, *names
    )


def exact_mean(column: str, places: int = 6) -> Column:
    """Mean through a decimal sum, so that it does not depend on row order."""
    return ratio(F.sum(F.col(column).cast(f"decimal(28,{places})")), F.count(column))


def nanos_to_millis(c: Column) -> Column:
    return c / F.lit(1000000.0)


def downsample(samples: DataFrame, every: str = "1 hour") -> DataFrame:
    return tumbling(samples, every, ["measurement", "field"], [exact_mean("value").alias("mean_value")])


def slowest(samples: DataFrame, fields: Sequence[str], rank_by: str, every: str, n: int | None = None) -> DataFrame:
    """Window means, one column per field, then the mean per measurement, slowest first."""
    means = tumbling(samples, every, ["measurement", "field"], [exact_mean("value").alias("value")])
    wide = means.groupBy("measurement", "window_start").pivot("field", list(fields)).agg(F.max("value"))
    ranked = (
        wide.groupBy("measurement")
        .agg(*[exact_mean(f).alias(f) for f in fields])
        .orderBy(F.desc_nulls_last(rank_by), "measurement")
    )
    return ranked if n is None else ranked.limit(n)


def last_values(samples: DataFrame, by: Sequence[str], ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """Newest value per series; partial results keep one row per series and partition."""
    newest = F.max(F.struct(ts, tie, "value")).alias("_last")
    out = samples.groupBy(*by).agg(newest)
    return out.select(*by, F.col(f"_last.{ts}").alias("last_ts"), F.col("_last.value").alias("last_value"))


def percentiles(
    samples: DataFrame, by: Sequence[str], value: str = "value", at: Sequence[float] = PERCENTILES,
) -> DataFrame:
    """Exact interpolated percentiles per series, for series of any size.

    Equal values are counted first. A running count then tells which ranks each value covers, and a
    percentile reads the two ranks around it, so no task has to hold a whole series.
    """
    keys = list(by)
    present = samples.filter(F.col(value).isNotNull())
    counted = present.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    rows = ordered(counted, keys, [value])
    placed = rows.done(rows.running_sum(rows.frame, F.col("_n"), "_before", inclusive=False))
    sizes = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("samples"))
    renamed = sizes.select(*[F.col(k).alias(f"_size_{k}") for k in keys], "samples")
    same = [F.col(k).eqNullSafe(F.col(f"_size_{k}")) for k in keys]
    ranked = placed.join(renamed, same)
    aggs, out = [], []
    for i, p in enumerate(at):
        rank = F.lit(p) * (F.col("samples") - 1)
        for side, position in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            covers = (F.col("_before") <= position) & (position < F.col("_before") + F.col("_n"))
            aggs.append(F.max(F.when(covers, F.col(value))).alias(f"_{side}{i}"))
        part = rank - F.floor(rank)
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        out.append((low * (F.lit(1.0) - part) + high * part).alias(f"p{f'{p * 100:g}'.replace('.', '_')}"))
    return ranked.groupBy(*keys, "samples").agg(*aggs).select(*keys, "samples", *out)


def approximate_percentiles(
    samples: DataFrame, by: Sequence[str], value: str = "value", at: Sequence[float] = PERCENTILES
) -> DataFrame:
    """Sketch-based percentiles in one pass, where a small rank error is acceptable."""
    found = samples.groupBy(*by).agg(F.percentile_approx(value, list(at), 10000).alias("_p"))
    names = [f"p{f'{p * 100:g}'.replace('.', '_')}" for p in at]
    return found.select(*by, *[F.get("_p", F.lit(i)).alias(n) for i, n in enumerate(names)])


def rate(
    points: DataFrame, by: Sequence[str], ts: str = "window_start", value: str = "value"
) -> DataFrame:
    """Change per second against the point before; null where a counter went down."""
    rows = ordered(points, list(by), [ts])
    seen = rows.previous(rows.frame, ts, "_ts")
    seen = rows.done(rows.previous(seen, value, "_value"))
    seconds = F.unix_micros(ts).cast("double") - F.unix_micros("_ts").cast("double")
    change = F.col(value) - F.col("_value")
    per_second = F.when(change >= 0, F.try_divide(change * 1000000.0, seconds))
    return seen.filter(F.col("_ts").isNotNull()).withColumn("per_second", per_second).drop("_ts", "_value")


def failure_alerts(samples: DataFrame, failed: Column, every: str = "5 minutes") -> DataFrame:
    """Share of failures per window and its alert level."""
    counts = tumbling(
        samples, every, [], [F.count(F.lit(1)).alias("events"), F.count_if(failed).alias("failures")]
    )
    share = ratio(F.col("failures"), F.col("events"))
    alert = F.when(share > FAILURE_CRITICAL, "CRITICAL").when(share > FAILURE_WARNING, "WARNING")
    return counts.withColumn("failure_rate", share).withColumn("alert", alert).filter(F.col("alert").isNotNull())


def latency_alerts(samples: DataFrame, every: str = "1 day") -> DataFrame:
    """Windows whose p95 is over twice, or p99 over five times, the value of the window before."""
    found = samples.withColumn("window_start", F.window("ts", every)["start"])
    levels = percentiles(found, ["measurement", "window_start"], at=(0.95, 0.99))
    rows = ordered(levels, ["measurement"], ["window_start"])
    seen = rows.previous(rows.frame, "p95", "base_p95")
    seen = rows.done(rows.previous(seen, "p99", "base_p99"))
    slow95 = F.col("p95") > F.col("base_p95") * P95_FACTOR
    slow99 = F.col("p99") > F.col("base_p99") * P99_FACTOR
    return seen.filter(slow95 | slow99)


BASELINE_DAYS = 7


def moving_alerts(levels: DataFrame, by: Sequence[str], days: int = BASELINE_DAYS) -> DataFrame:
    """Windows whose p95 is over twice, or p99 over five times, the mean of the windows of the days before them.

    `levels` has one row per group and window (window_start, p95, p99), exact or read from sketches, so a group's rows are
    as many as its windows. A window without earlier windows in that time has no baseline and gives no alert.
    """
    earlier = Window.partitionBy(*by).orderBy(F.unix_seconds("window_start")).rangeBetween(-days * 86_400, -1)
    means = {f"base_{p}": F.avg(p).over(earlier) for p in ("p95", "p99")}
    seen = levels.withColumns({**means, "base_windows": F.count("p95").over(earlier)})
    slow95 = F.col("p95") > F.col("base_p95") * P95_FACTOR
    slow99 = F.col("p99") > F.col("base_p99") * P99_FACTOR
    return seen.filter(slow95 | slow99)


def heartbeat_gaps(
    beats: DataFrame, by: Sequence[str], ts: str = "ts", tie: str = "event_id", seconds: int = HEARTBEAT_SECONDS,
) -> DataFrame:
    """Silences longer than the limit between two beats of a source."""
    rows = ordered(beats, list(by), [ts, tie])
    seen = rows.done(rows.previous(rows.frame, ts, "gap_start"))
    length = (F.unix_micros(ts) - F.unix_micros("gap_start")).cast("double") / 1000000.0
    return (
        seen.withColumn("gap_seconds", length)
        .filter(F.col("gap_seconds") > seconds)
        .select(*by, "gap_start", F.col(ts).alias("gap_end"), "gap_seconds")
    )
