"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymark.session import stage

#: Far more rounds than a graph that fits any table needs; the count grows with the logarithm of its size.
MOST_ROUNDS = 100


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours on the least of its neighbours and itself."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.min("b").alias("_least"))
    joined = both.join(least, "a").where(F.col("b") > F.col("a"))
    return joined.select(F.col("b").alias("a"), F.least("a", "_least").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hangs itself and its smaller neighbours on the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("_least"))
    own = least.select("a", F.col("_least").alias("b"))
    others = down.join(least, "a").where(F.col("b") != F.col("_least")).select(F.col("b").alias("a"), F.col("_least").alias("b"))
    return own.unionByName(others).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) for every node of the links (a, b).

    Minima are partly taken before the shuffle and joined back, so a hub's neighbours never meet in one task: the
    joins can be split. Each round is written. It ends when every node hangs on a root, that is, when a round
    changes nothing. Links of a node with itself and repeated links are allowed; no links give no rows.
    """
    edges = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    for _ in range(MOST_ROUNDS):
        edges = stage(_small_star(_large_star(edges)), "star")
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        seen = state
    raise RuntimeError("components did not settle")
