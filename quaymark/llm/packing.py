"""Best-fit packing: a configuration linear program over the length histogram, rounded and laid out.

Every text becomes its ids and a closing id, is cut into pieces of at most the sequence length, and the
pieces are packed. The program has one variable per configuration (a multiset of lengths that fits one
sequence) and one covering row per length. Multiplicative weights hold a price per length; a knapsack
dynamic program finds the configuration of highest price; lengths it covers well lose weight. Rounding takes
each configuration a whole number of times, as long as pieces are left for it; what remains is packed best fit,
largest first. All of that sees only the histogram, which has as many rows as a sequence has tokens.

Pieces get their places by Spark: a rank within their length, from counts per (length, slice), and a join
with the layout, whose size is bounded by the number of configurations, whatever the input.

Cases: a null or empty text is one piece with the closing id alone; repeated rows are packed each; an empty
table gives an empty result; a text of any length is cut, none is dropped.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quaymark.session import stage

from .common import key_and_text, slices
from .word_bpe import WordFile

#: Rounds of pricing; also bounds the number of configurations.
ROUNDS = 40
#: Configurations taken from one pricing table.
BATCH = 64
#: Pieces of one length that are numbered together.
RANK_GROUP = 20_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
LAYOUT = "length long, first long, stop long, each long, sequence_id long, offset long"


def cut(docs: DataFrame, vocabulary: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of every text: doc_id, piece, start, length, ids_crc32."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = WordFile(vocabulary)
        close = (0).to_bytes(4, "little")
        for batch in slices(batches):
            rows: tuple[list, ...] = ([], [], [], [], [])
            keys = batch["doc_id"].to_pylist()
            for key, ids in zip(keys, file.encode([t or "" for t in batch["text"].to_pylist()])):
                ids += close
                for n, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at : at + 4 * limit]
                    for column, value in zip(rows, (key, n, at // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(rows, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return key_and_text(docs, key, text).mapInArrow(work, PIECES)


def price(values: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The knapsack table: best[c] is the highest value of pieces that fit c tokens, chosen[c] one of their
    lengths (0: leave a token free). values[s] is the price of length s, 0 if none is wanted."""
    best, chosen = np.zeros(limit + 1), np.zeros(limit + 1, dtype=np.int64)
    wanted = np.flatnonzero(values)
    worth = values[wanted]
    for c in range(1, limit + 1):
        best[c] = best[c - 1]
        if n := int(np.searchsorted(wanted, c, side="right")):
            total = worth[:n] + best[c - wanted[:n]]
            k = int(total.argmax())
            if total[k] > best[c]:
                best[c], chosen[c] = total[k], wanted[k]
    return best, chosen


def configuration(first: int, chosen: np.ndarray, limit: int, room: np.ndarray) -> dict[int, int]:
    """The best configuration that holds `first`, with no length more often than there are pieces (`room`)."""
    config, c = {first: 1}, limit - first
    while c > 0:
        s = int(chosen[c])
        if s and config.get(s, 0) < room[s]:
            config[s] = config.get(s, 0) + 1
            c -= s
        else:
            c -= 1
    return config


def solve(counts: dict[int, int], limit: int, rounds: int = ROUNDS, step: float = 0.25) -> list[tuple[dict[int, int], float]]:
    """Configurations with fractional multiplicities that cover the counts.

    A length's price is its weight over its count. Each round prices by one knapsack table and takes the
    configurations of highest value, each as often as its scarcest length allows within `step` of what it
    still lacks; the weight of what is covered falls accordingly.
    """
    need = np.zeros(limit + 1)
    for s, n in counts.items():
        need[s] = n
    # long pieces are hard to place, so they start a little dearer than their share of a sequence
    weight = need * np.arange(limit + 1, dtype=float) ** 1.15
    covered, found = np.zeros(limit + 1), {}
    for _ in range(rounds):
        room = need - covered
        values = np.divide(weight, need, out=np.zeros(limit + 1), where=room >= 1)
        wanted = np.flatnonzero(values)
        if not len(wanted):
            break
        best, chosen = price(values / values.max(), limit)
        for s in wanted[np.argsort(-(values[wanted] / values.max() + best[limit - wanted]), kind="stable")][:BATCH].tolist():
            if room[s] < 1:
                continue
            config = configuration(s, chosen, limit, room)
            times = max(1.0, step * min(room[s] / a for s, a in config.items()))
            for s, a in config.items():
                covered[s] += a * times
                room[s] -= a * times
                weight[s] *= np.exp(-a * times / need[s])
            key = tuple(sorted(config.items()))
            found[key] = found.get(key, 0.0) + times
    return [(dict(k), x) for k, x in found.items()]


def best_fit(left: dict[int, int], limit: int) -> list[dict[int, int]]:
    """Best fit, largest first, of what rounding left; equal lengths are placed one at a time."""
    open_bins: list[tuple[int, int]] = []  # (room, bin), sorted
    bins: list[dict[int, int]] = []
    for size in sorted(left, reverse=True):
        for _ in range(left[size]):
            at = bisect_left(open_bins, (size, -1))
            if at < len(open_bins):
                room, number = open_bins.pop(at)
            else:
                room, number = limit, len(bins)
                bins.append({})
            bins[number][size] = bins[number].get(size, 0) + 1
            if room > size:
                insort(open_bins, (room - size, number))
    return bins


def plan(counts: dict[int, int], limit: int) -> list[tuple[dict[int, int], int]]:
    """Configurations with whole multiplicities that use every piece once.

    The fractions are rounded down. The program is then solved anew for what is left, until that is a few
    pieces per length, which best fit places. A solve places at least one piece, and all but a number that
    depends on the limit alone, so the size of the plan is bounded for any counts.
    """
    left = {s: n for s, n in counts.items() if n > 0}
    out: list[tuple[dict[int, int], int]] = []
    while sum(left.values()) > 4 * limit:
        for config, x in solve(left, limit):
            out.append((config, int(x)))
            for s, a in config.items():
                left[s] -= a * int(x)
        left = {s: n for s, n in left.items() if n}
    return out + [(b, 1) for b in best_fit(left, limit)]


def layout(counts: dict[int, int], limit: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first, stop, each, sequence_id, offset): pieces of that length with rank in [first, stop)
    go to sequence_id + (rank - first) // each at offset + (rank - first) % each * length."""
    used, number, rows = dict.fromkeys(counts, 0), 0, []
    for config, times in plan(counts, limit):
        offset = 0
        for s, a in sorted(config.items(), reverse=True):
            rows.append((s, used[s], used[s] + a * times, a, number, offset))
            used[s] += a * times
            offset += a * s
        number += times
    return rows


def ranked(pieces: DataFrame, rows: int) -> DataFrame:
    """Each piece's rank within its length, without bringing a length together in one task."""
    groups = rows // RANK_GROUP + 1
    pieces = pieces.withColumn("_slice", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        pieces.groupBy("length", "_slice").agg(F.count("*").alias("_n"))
        .select("length", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    order = Window.partitionBy("length", "_slice").orderBy("doc_id", "piece", "ids_crc32")
    numbered = pieces.withColumn("_row", F.row_number().over(order) - 1)
    return numbered.join(starts, ["length", "_slice"]).withColumn("rank", F.col("_start") + F.col("_row")).drop("_slice", "_start", "_row")


def pack(docs: DataFrame, vocabulary: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every piece with its sequence and its place there."""
    spark = docs.sparkSession
    pieces = stage(cut(docs, vocabulary, limit, key, text), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `limit` rows
    places = spark.createDataFrame(layout(counts, limit), LAYOUT)
    at = F.col("rank") - F.col("first")
    return (
        ranked(pieces, sum(counts.values()))
        .join(F.broadcast(places), "length")  # bounded by the configurations
        .where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("stop")))
        .select(
            "doc_id", "piece", "start", "length", "ids_crc32",
            (F.col("sequence_id") + F.floor(at / F.col("each"))).alias("sequence_id"),
            (F.col("offset") + at % F.col("each") * F.col("length")).alias("offset"),
        )
    )
