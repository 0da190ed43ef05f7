"""Deterministic surrogate keys.

A key is a function of the member's natural key, so a retried task, a replanned
query or a later load computes the same id, and a fact can be keyed from the
event row without looking the member up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _number(column: Column | str) -> Column:
    # Adding 0.0 turns -0.0 into 0.0: both are one join key, so one id.
    return (_text(column) + F.lit(0.0)).cast("string")


def surrogate_key(*parts: Column) -> Column:
    """md5 of the parts, each written as ``length:text``; NULL if any is NULL.

    The length prefix keeps ("ab", "c") and ("a", "bc") apart for any content.
    """
    sized = [F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]
    return F.md5(F.concat(*sized))


def song_key(title: Column | str, artist: Column | str, duration: Column | str) -> Column:
    return surrogate_key(_text(title), _text(artist), _number(duration))


def location_key(
    city: Column | str,
    zip_code: Column | str,
    state: Column | str,
    lon: Column | str,
    lat: Column | str,
) -> Column:
    return surrogate_key(
        _text(city), _text(zip_code), _text(state), _number(lon), _number(lat)
    )
