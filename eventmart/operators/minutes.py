"""One-minute counts over event time, and the login feed.

Every function takes normalised events, a batch or a stream, and gives the rows
of one serving table. On a stream a minute is emitted once, when the watermark
reaches its end, and later rows for it are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.functions.calendar import CALENDAR

NO_DELAY = "0 seconds"

# Event columns each serving table is computed from.
INPUT_COLUMNS = {
    "listen_count_minute": ["ts"],
    "song_chart_minute": ["song", "ts"],
    "artist_chart_minute": ["artist", "ts"],
    "user_activity_minute": ["state", "ts"],
    "gender_distribution_minute": ["gender", "level", "ts"],
    "user_login": [
        "userId",
        "lastName",
        "firstName",
        "gender",
        "level",
        "registration",
        "ts",
    ],
}
# Topic each serving table is fed from.
INPUT_TOPIC = {
    "listen_count_minute": "listen_events",
    "song_chart_minute": "listen_events",
    "artist_chart_minute": "listen_events",
    "user_activity_minute": "page_view_events",
    "gender_distribution_minute": "auth_events",
    "user_login": "auth_events",
}


def _minute_counts(events: DataFrame, keys: Sequence[str], delay: str) -> DataFrame:
    """Rows per key and minute; tasks count their own rows before the shuffle."""
    return (
        events.select(*keys, "ts")
        .withWatermark("ts", delay)
        .groupBy(*keys, F.window("ts", "1 minute"))
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("ingest_ts", F.col("window.start"))
    )


def _calendar_rows(table: str, counts: DataFrame) -> DataFrame:
    columns = schemas.SERVING[table].names
    fields = {c: CALENDAR[c]("ingest_ts") for c in columns if c in CALENDAR}
    return counts.withColumns(fields).select(*columns)


def listen_count_minute(events: DataFrame, delay: str = NO_DELAY) -> DataFrame:
    """Listens per minute."""
    return _calendar_rows("listen_count_minute", _minute_counts(events, [], delay))


def song_chart_minute(events: DataFrame, delay: str = NO_DELAY) -> DataFrame:
    """Listens per song and minute; listens without a song are a group."""
    return _calendar_rows("song_chart_minute", _minute_counts(events, ["song"], delay))


def artist_chart_minute(events: DataFrame, delay: str = NO_DELAY) -> DataFrame:
    """Listens per artist and minute."""
    return _calendar_rows("artist_chart_minute", _minute_counts(events, ["artist"], delay))


def user_activity_minute(events: DataFrame, delay: str = NO_DELAY) -> DataFrame:
    """Page views per state (as ``US-`` and its code) and minute."""
    counts = _minute_counts(events, ["state"], delay)
    named = counts.withColumn("state", F.concat(F.lit("US-"), "state"))
    return _calendar_rows("user_activity_minute", named)


def gender_distribution_minute(events: DataFrame, delay: str = NO_DELAY) -> DataFrame:
    """Login attempts per known gender, level and minute."""
    known = events.dropna(subset=["gender", "level"])
    counts = _minute_counts(known, ["gender", "level"], delay)
    return counts.select(*schemas.SERVING["gender_distribution_minute"].names)


def user_login(events: DataFrame, only_success: bool = False) -> DataFrame:
    """Login attempts of known users; all of them unless ``only_success``."""
    rows = events.where("success") if only_success else events
    return (
        rows.select(*schemas.SERVING["user_login"].names)
        .dropna(subset=["userId"])
        .withColumn("userId", F.col("userId").cast("string"))
    )


TABLES = {
    "listen_count_minute": listen_count_minute,
    "song_chart_minute": song_chart_minute,
    "artist_chart_minute": artist_chart_minute,
    "user_activity_minute": user_activity_minute,
    "gender_distribution_minute": gender_distribution_minute,
    "user_login": user_login,
}
