"""Sketches per window that are stored and merged into larger windows, so raw samples are read once.

A stored row holds how many samples a window has, their smallest and largest value, a quantile sketch of the values and a
distinct sketch of some key. Rows of small windows merge into rows of large ones, in any grouping, with the same bounds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .metrics import PERCENTILES

#: Size of the quantile sketch, and by how much of the samples a quantile's rank may be off (the sketch promises less than
#: half of it with 99 % certainty).
QUANTILE_SIZE, RANK_ERROR = 1_600, 0.005
#: Logarithm of the distinct sketch's size, and its relative standard error.
DISTINCT_BITS, DISTINCT_ERROR = 12, 0.0165


def _named(out: DataFrame, by: Sequence[str]) -> DataFrame:
    names = ("samples", "lowest", "highest", "quantiles", "keys")
    return out.select(F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *by, *names)


def window_sketches(samples: DataFrame, every: str, by: Sequence[str], key: str, ts: str = "ts", value: str = "value") -> DataFrame:
    """One row per window and group, from batch or stream. Null values are left out, keys of null too."""
    number, known = F.col(value).cast("double"), F.when(F.col(value).isNotNull(), F.col(key))
    # a filter on values would move below a stream's watermark, which then misses the times of the rows it drops
    found = samples.groupBy(F.window(ts, every).alias("_window"), *by).agg(
        F.count(value).alias("samples"), F.min(number).alias("lowest"), F.max(number).alias("highest"),
        F.kll_sketch_agg_double(number, QUANTILE_SIZE).alias("quantiles"), F.hll_sketch_agg(known, DISTINCT_BITS).alias("keys"),
    )
    return _named(found.where("samples > 0"), by)


def merged(stored: DataFrame, every: str, by: Sequence[str]) -> DataFrame:
    """Rows of larger windows from rows of smaller ones that fit into them."""
    found = stored.groupBy(F.window("window_start", every).alias("_window"), *by).agg(
        F.sum("samples").alias("samples"), F.min("lowest").alias("lowest"), F.max("highest").alias("highest"),
        F.kll_merge_agg_double("quantiles", QUANTILE_SIZE).alias("quantiles"), F.hll_union_agg("keys").alias("keys"),
    )
    return _named(found, by)


def read_sketches(stored: DataFrame, at: Mapping[str, float] | None = None) -> DataFrame:
    """The rows with their quantiles (name -> share) and the number of distinct keys, in place of the sketches."""
    shares = at or {f"p{f'{p * 100:g}'.replace('.', '_')}": p for p in PERCENTILES}
    quantiles = {name: F.kll_sketch_get_quantile_double("quantiles", F.lit(share)) for name, share in shares.items()}
    return stored.withColumns({**quantiles, "distinct_keys": F.hll_sketch_estimate("keys")}).drop("quantiles", "keys")
