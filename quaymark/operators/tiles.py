"""Tiles (NTILE) over a whole table without sorting it.

A tile starts at a known rank. The row at a rank is found by narrowing an interval of (value, id) pairs: a sample of the
interval says where the rank must lie but for bad luck, one pass counts the rows below that narrower interval, and when
few rows are left they are put in order. All edges of all measures are searched in the same passes, which read only the
measures and the id. A row's tile is then the number of edges at or below it, an expression: no row is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..session import stage

#: Rows of an interval that are put in order at once, and rows of its sample.
FEW, SAMPLE = 4_096, 4_096
#: Standard deviations of a rank's place in the sample that the next interval covers on each side.
SPREAD = 4.0
#: Each round leaves about a tenth of an interval, so this is beyond any table.
MOST_ROUNDS = 40


@dataclass(frozen=True)
class _Search:
    """A rank's interval: pairs from `low` on and below `high`; `before` rows lie below it, `size` rows in it."""

    measure: str
    rank: int
    before: int
    size: int
    low: Row | None = None
    high: Row | None = None


def _pair(measure: str, key: str) -> Column:
    return F.struct(F.col(measure).alias("value"), F.col(key).alias("id"))


def _below(df: DataFrame, measure: str, key: str, pair: Row) -> Column:
    """Rows before a pair; on plain columns, which is much cheaper than comparing structs. Never null."""
    value, own_id = F.col(measure), F.col(key)
    edge, edge_id = (F.lit(x).cast(df.schema[c].dataType) for x, c in ((pair.value, measure), (pair.id, key)))
    tied = F.lit(False) if pair.id is None else own_id.isNull() | (own_id < edge_id)
    if pair.value is None:
        return value.isNull() & tied
    return F.when(value.isNull(), True).otherwise((value < edge) | ((value == edge) & tied))


def _within(df: DataFrame, key: str, s: _Search) -> Column:
    inside = F.lit(True)
    if s.low is not None:
        inside = inside & ~_below(df, s.measure, key, s.low)
    if s.high is not None:
        inside = inside & _below(df, s.measure, key, s.high)
    return inside


def _gathered(df: DataFrame, key: str, searches: list[_Search], chosen: list[Column], first: Column) -> dict[_Search, list[Row]]:
    """The chosen pairs of each interval, in order. Rows that no search wants are left out before they are gathered."""
    wanted = [c & _within(df, key, s) for s, c in zip(searches, chosen)]
    rows = df.where(first & reduce(Column.__or__, wanted))
    parts = [F.array_sort(F.collect_list(F.when(w, _pair(s.measure, key)))).alias(f"s{i}") for i, (w, s) in enumerate(zip(wanted, searches))]
    return dict(zip(searches, rows.agg(*parts).first()))


def _places(searches: list[_Search]) -> dict[tuple, _Search]:
    """One search for each interval: ranks of a measure may still be in the same one."""
    return {(s.measure, s.low, s.high): s for s in searches}


def _sampled(df: DataFrame, key: str, searches: list[_Search], number: int) -> list[list[Row]]:
    """Pairs of each interval in order, chosen by a hash of the id, about SAMPLE of them."""
    slots, places = 1 << 30, _places(searches)
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(number)), F.lit(slots))
    limits = [min(slots, -(-SAMPLE * slots // s.size)) for s in places.values()]
    found = _gathered(df, key, list(places.values()), [draw < n for n in limits], draw < max(limits))
    return [found[places[s.measure, s.low, s.high]] for s in searches]


def _narrowed(df: DataFrame, key: str, searches: list[_Search], samples: list[list[Row]]) -> list[_Search]:
    bounds = []
    for s, sample in zip(searches, samples):
        share = (s.rank - s.before + 0.5) / s.size
        # a sample of everything is no sample; of a small one, a wide margin would leave all of the interval
        margin = 0 if len(sample) == s.size else min(SPREAD * (len(sample) * share * (1 - share)) ** 0.5 + 2, len(sample) / 8)
        low, high = int(len(sample) * share - margin), int(len(sample) * share + margin) + 1
        bounds.append((sample[low] if low >= 0 else s.low, sample[high] if high < len(sample) else s.high))
    counts = []
    for i, (s, pair) in enumerate(zip(searches, bounds)):
        for side, edge, none in (("a", pair[0], s.low), ("b", pair[1], s.high)):
            below = F.lit(side == "b") if edge is none else _below(df, s.measure, key, edge)
            counts.append(F.count_if(_within(df, key, s) & below).alias(f"{side}{i}"))
    found = df.agg(*counts).first()
    out = []
    for i, (s, (low, high)) in enumerate(zip(searches, bounds)):
        first, last = found[f"a{i}"], found[f"b{i}"]
        offset = s.rank - s.before
        if offset < first:  # bad luck with the sample: the rank lies beside the interval
            out.append(replace(s, high=low, size=first))
        elif offset >= last:
            out.append(replace(s, low=high, before=s.before + last, size=s.size - last))
        else:
            out.append(replace(s, low=low, high=high, before=s.before + first, size=last - first))
    return out


def pairs_at(df: DataFrame, key: str, wanted: list[tuple[str, int]], rows: int) -> list[Row]:
    """The (value, id) pair at each rank, from 0, of each measure in ascending order, nulls first, ties by id."""
    searches = [_Search(measure, rank, 0, rows) for measure, rank in wanted]
    for number in range(MOST_ROUNDS):
        wide = [s for s in searches if s.size > FEW]
        if not wide:
            break
        done = dict(zip(map(id, wide), _narrowed(df, key, wide, _sampled(df, key, wide, number))))
        searches = [done.get(id(s), s) for s in searches]
    else:
        raise RuntimeError("ranks were not found; the id must tell rows apart")
    if not searches:
        return []
    places = _places(searches)
    found = _gathered(df, key, list(places.values()), [F.lit(True)] * len(places), F.lit(True))
    return [found[places[s.measure, s.low, s.high]][s.rank - s.before] for s in searches]


def tile_starts(rows: int, tiles: int) -> list[int]:
    """Ranks, from 0, of the first rows of the second and later tiles that have rows; the first tiles take what is over."""
    small, over = divmod(rows, tiles)
    return [r for r in (k * small + min(k, over) for k in range(1, tiles)) if r < rows]


def with_tiles(df: DataFrame, key: str, measures: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Add NTILE columns: name -> (measure, tiles), over all rows by the measure and then the id.

    The rows are written once; `key` must tell them apart. No rows give no rows, and with fewer rows than tiles each row
    has a tile of its own.
    """
    written = stage(df, "tiled")
    # only these columns are read in the passes
    narrow = written.select(key, *dict.fromkeys(m for m, _ in measures.values()))
    rows = narrow.count()
    wanted = list(dict.fromkeys((m, r) for m, tiles in measures.values() for r in tile_starts(rows, tiles)))
    edges = dict(zip(wanted, pairs_at(narrow, key, wanted, rows)))
    added = {}
    for name, (measure, tiles) in measures.items():
        passed = F.lit(1)
        for rank in tile_starts(rows, tiles):
            passed = passed + F.when(_below(narrow, measure, key, edges[measure, rank]), 0).otherwise(1)
        added[name] = passed.cast("int")
    return written.withColumns(added)
