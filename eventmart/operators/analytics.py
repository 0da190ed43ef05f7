"""The analytical questions, answered from facts and dimensions.

Song-level answers expect facts with one row per event
(``user_match="version"``); facts matched on the user id alone repeat an event
once per user version.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.operators.dims import DIM_TIME_BYTES, Star
from eventmart.operators.lookup import lookup
from eventmart.operators.topk import top_k

# Columns that make up one period. Weeks are ISO weeks of a calendar year, so
# the week around New Year is split between two years.
GRAINS: dict[str, list[str]] = {
    "year": ["year"],
    "month": ["year", "month"],
    "week": ["year", "week"],
    "day": ["year", "month", "day"],
    "hour": ["year", "month", "day", "hour"],
    "minute": ["year", "month", "day", "hour", "minute"],
    "second": ["year", "month", "day", "hour", "minute", "second"],
}


def _grain(grain: str | None) -> list[str]:
    if grain is None:
        return []
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {sorted(GRAINS)}, not {grain!r}")
    return GRAINS[grain]


def at_grain(
    fact: DataFrame, star: Star, grain: str | None, keep: Sequence[str] = ()
) -> DataFrame:
    """``keep`` of the fact rows with the period columns of ``grain``.

    Only the dimensions the grain needs are joined, and only columns asked for
    are read. Both lookups are broadcasts: a day has 86,400 seconds, and the
    days are counted before.
    """
    columns = _grain(grain)
    by_date = [c for c in columns if c in schemas.DATE_KEY]
    by_time = [c for c in columns if c in schemas.TIME_KEY]
    ids = [*(["date_id"] if by_date else []), *(["time_id"] if by_time else [])]
    rows = fact.select(*ids, *keep)
    if by_date:
        rows = lookup(rows, star.date, {"date_id": "date_id"}, by_date)
    if by_time:
        rows = lookup(rows, star.time, {"time_id": "time_id"}, by_time, size=DIM_TIME_BYTES)
    return rows.select(*columns, *keep)


def _plays(fact: DataFrame, star: Star, grain: str | None, keys: Sequence[str]) -> DataFrame:
    events = at_grain(fact, star, grain, keys)
    return events.groupBy(*events.columns).agg(F.count(F.lit(1)).alias("plays"))


def logged_in_users(
    fact_auth: DataFrame, star: Star, grain: str, only_success: bool = True
) -> DataFrame:
    """Distinct users that logged in per period."""
    logins = fact_auth.where("success") if only_success else fact_auth
    users = at_grain(logins, star, grain, ["userId"])
    return users.groupBy(*_grain(grain)).agg(F.countDistinct("userId").alias("users"))


def songs_played(fact_listen: DataFrame, star: Star, grain: str) -> DataFrame:
    """Songs listened to per period."""
    return _plays(fact_listen, star, grain, [])


def top_songs(fact_listen: DataFrame, star: Star, grain: str | None, k: int = 10) -> DataFrame:
    """The k most played songs per period; ties go by title, artist, id."""
    periods = _grain(grain)
    plays = _plays(fact_listen, star, grain, ["song_id"])
    named = lookup(plays, star.song, {"song_id": "song_id"}, ["title", "artist"], salts=1)
    order = [F.desc("plays"), F.asc("title"), F.asc("artist"), F.asc("song_id")]
    return top_k(named, periods, order, k)


def top_artists(
    fact_listen: DataFrame, star: Star, grain: str | None, k: int = 10
) -> DataFrame:
    """The k most played artists per period; ties go by name."""
    periods = _grain(grain)
    songs = _plays(fact_listen, star, grain, ["song_id"])
    artists = (
        lookup(songs, star.song, {"song_id": "song_id"}, ["artist"], salts=1)
        .groupBy(*periods, "artist")
        .agg(F.sum("plays").alias("plays"))
    )
    return top_k(artists, periods, [F.desc("plays"), F.asc("artist")], k)


def top_locations(
    fact_listen: DataFrame, star: Star, grain: str | None = None, k: int = 10
) -> DataFrame:
    """The k places with most listens, overall or per period."""
    periods = _grain(grain)
    plays = _plays(fact_listen, star, grain, ["location_id"])
    on = {"location_id": "location_id"}
    named = lookup(plays, star.location, on, ["city", "zip", "state"], salts=1)
    order = [F.desc("plays"), F.asc("city"), F.asc("zip"), F.asc("state"), F.asc("location_id")]
    return top_k(named, periods, order, k)


def user_distribution(dim_user: DataFrame) -> DataFrame:
    """Distinct users per gender and level."""
    return dim_user.groupBy("gender", "level").agg(F.countDistinct("userId").alias("users"))


def avg_songs_per_user(fact_listen: DataFrame) -> DataFrame:
    """Mean number of songs over the users that listened to any."""
    per_user = fact_listen.groupBy("userId").agg(F.count(F.lit(1)).alias("plays"))
    return per_user.agg(
        F.avg("plays").alias("avg_songs"), F.count(F.lit(1)).alias("users")
    )


def _instant(moment: datetime) -> datetime:
    """A time without zone means UTC, whatever the zone of the driver."""
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def latest_minutes(
    table: DataFrame,
    n: int,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """The n newest rows of a minute table, newest first, within [start, end)."""
    if start is not None:
        table = table.where(F.col("ingest_ts") >= F.lit(_instant(start)))
    if end is not None:
        table = table.where(F.col("ingest_ts") < F.lit(_instant(end)))
    rest = [F.asc(c) for c in table.columns if c != "ingest_ts"]
    return table.orderBy(F.desc("ingest_ts"), *rest).limit(n)
