"""Calendar fields of an event time, and the two keys made from them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weeks are ISO weeks while years are calendar years; Sunday is day 1.
CALENDAR = {
    "hour": F.hour,
    "minute": F.minute,
    "second": F.second,
    "day": F.dayofmonth,
    "dayOfWeek": F.dayofweek,
    "week": F.weekofyear,
    "month": F.month,
    "year": F.year,
    "quarter": F.quarter,
}


def with_calendar(
    df: DataFrame, ts: str = "ts", fields: Iterable[str] = tuple(CALENDAR)
) -> DataFrame:
    """Add the named calendar columns of ``ts`` (all nine by default)."""
    return df.withColumns({name: CALENDAR[name](ts) for name in fields})


def date_key(ts: Column | str) -> Column:
    """``yyyyMMdd`` as text; integer arithmetic stays inside generated code."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("string")


def time_key(ts: Column | str) -> Column:
    """``HHmmss`` as text."""
    return clock_key(F.hour(ts), F.minute(ts), F.second(ts))


def clock_key(hour: Column, minute: Column, second: Column) -> Column:
    return F.lpad((hour * 10000 + minute * 100 + second).cast("string"), 6, "0")
