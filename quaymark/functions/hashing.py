"""Deterministic choices from a key hash, in place of random numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_number(*parts: Column) -> Column:
    """First 60 bits of the md5 of the joined key, as a long. Equal in any engine with md5."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def bucket(buckets: int, *parts: Column) -> Column:
    return F.pmod(key_number(*parts), F.lit(buckets))


def weighted_choice(options: Sequence[tuple[object, float]], *parts: Column) -> Column:
    """Pick an option by key; weights are percentages that add up to 100."""
    slot = bucket(10000, *parts)
    edge, out = 0.0, None
    for value, weight in options[:-1]:
        edge += weight
        test = slot < F.lit(round(edge * 100))
        out = F.when(test, F.lit(value)) if out is None else out.when(test, F.lit(value))
    last = F.lit(options[-1][0])
    return last if out is None else out.otherwise(last)


def pick(options: Sequence[object], *parts: Column) -> Column:
    """Pick from a short fixed list by key."""
    place = bucket(len(options), *parts).cast("int") + 1
    return F.try_element_at(F.array(*[F.lit(o) for o in options]), place)


def offset(low: int, high: Column | int, *parts: Column) -> Column:
    """A number from low to high inclusive, by key."""
    high = F.lit(high) if isinstance(high, int) else high
    return F.lit(low) + F.pmod(key_number(*parts), high - F.lit(low) + F.lit(1))
