"""Dates and times. Parsing never raises: text that does not match becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RAW_FORMAT = "M/d/yyyy H:mm"
DAY_FORMAT = "yyyy-MM-dd"


def parse_time(c: Column, fmt: str = RAW_FORMAT) -> Column:
    return F.try_to_timestamp(c, F.lit(fmt))


def parse_day(c: Column, fmt: str = DAY_FORMAT) -> Column:
    return F.try_to_timestamp(c, F.lit(fmt)).cast("date")


def whole_seconds(c: Column) -> Column:
    return F.unix_timestamp(c)


def age_years(born: Column, as_of: Column) -> Column:
    return F.floor(F.datediff(as_of, born) / 365)


def days_since(c: Column, as_of: Column) -> Column:
    return F.datediff(as_of, c)


def is_weekend(c: Column) -> Column:
    return F.dayofweek(c).isin(1, 7)


def days_late(actual: Column, due: Column) -> Column:
    """Days after the due date; zero when on time or unknown."""
    return F.greatest(F.coalesce(F.datediff(actual, due), F.lit(0)), F.lit(0))


def shift(c: Column, days: Column | int = 0, seconds: Column | int = 0) -> Column:
    """Move a time by whole days and seconds, keeping its fraction."""
    days = F.lit(days) if isinstance(days, int) else days
    seconds = F.lit(seconds) if isinstance(seconds, int) else seconds
    return c + F.make_interval(days=days.cast("int"), secs=seconds)
