"""The five conformed dimensions.

Each is one narrow scan per topic (only its own columns are read), rows with a
NULL or NaN part dropped before one distinct. Equal members collapse within the
scan tasks, so a very frequent song or place costs one row per task in the
shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventmart import schemas, session
from eventmart.functions.calendar import clock_key, with_calendar
from eventmart.functions.keys import location_key, song_key
from eventmart.operators import membership
from eventmart.operators.conform import Activity
from eventmart.operators.lookup import BROADCAST_BYTES, row_bytes
from eventmart.operators.sets import except_distinct, union_all

SECONDS_PER_DAY = 86_400
# Its keys are six digits: no row takes more than 64 bytes.
DIM_TIME_BYTES = 64 * SECONDS_PER_DAY


class Star(NamedTuple):
    """The dimensions, in the order facts look them up; unneeded ones may be None."""

    time: DataFrame | None = None
    date: DataFrame | None = None
    song: DataFrame | None = None
    user: DataFrame | None = None
    location: DataFrame | None = None


def dim_time(spark: SparkSession) -> DataFrame:
    """Every second of a day."""
    second_of_day = F.col("id").cast("int")
    clock = spark.range(0, SECONDS_PER_DAY, 1, 1).select(
        F.expr("cast(id div 3600 as int)").alias("hour"),
        F.expr("cast(id div 60 % 60 as int)").alias("minute"),
        (second_of_day % 60).alias("second"),
    )
    return clock.select(
        clock_key(F.col("hour"), F.col("minute"), F.col("second")).alias("time_id"),
        *schemas.TIME_KEY,
    )


def _members(frames: Sequence[DataFrame]) -> DataFrame:
    return union_all([frame.dropna("any") for frame in frames]).distinct()


def _dates(activity: Activity) -> DataFrame:
    # One column through the shuffle; the calendar is a function of the day.
    days = _members([topic.select(F.to_date("ts").alias("_day")) for topic in activity])
    return with_calendar(days, "_day", schemas.DATE_KEY)


def _songs(activity: Activity) -> DataFrame:
    return _members(
        [
            topic.select(F.col("song").alias("title"), "artist", "duration")
            for topic in (activity.listen, activity.page_view)
        ]
    )


def _users(activity: Activity) -> DataFrame:
    return _members([topic.select(*schemas.USER_KEY) for topic in activity])


def _locations(activity: Activity) -> DataFrame:
    return _members([topic.select(*schemas.LOCATION_KEY) for topic in activity])


def _identified(name: str, members: DataFrame) -> DataFrame:
    """Add the surrogate key and put columns in stored order."""
    key = {
        "dim_date": lambda: F.col("year") * 10000 + F.col("month") * 100 + F.col("day"),
        "dim_song": lambda: song_key(*schemas.SONG_KEY),
        "dim_location": lambda: location_key(*schemas.LOCATION_KEY),
    }
    if name in key:
        id_column = schemas.DIMENSIONS[name].names[0]
        members = members.withColumn(id_column, key[name]().cast("string"))
    return members.select(*schemas.DIMENSIONS[name].names)


_BUILDERS = {
    "dim_date": (_dates, schemas.DATE_KEY),
    "dim_song": (_songs, schemas.SONG_KEY),
    "dim_user": (_users, schemas.USER_KEY),
    "dim_location": (_locations, schemas.LOCATION_KEY),
}


def dim_date(activity: Activity) -> DataFrame:
    """Days seen in any topic, with their calendar fields."""
    return _identified("dim_date", _dates(activity))


def dim_song(activity: Activity) -> DataFrame:
    """Songs listened to or viewed; page views without one give (empty, empty, 0.0)."""
    return _identified("dim_song", _songs(activity))


def dim_user(activity: Activity) -> DataFrame:
    """User versions: one row per id, names, gender, level and registration."""
    return _identified("dim_user", _users(activity))


def dim_location(activity: Activity) -> DataFrame:
    """Places seen in any topic."""
    return _identified("dim_location", _locations(activity))


def _candidates(name: str, activity: Activity) -> tuple[DataFrame, int]:
    """The members of ``activity``, stored once, and their bytes, measured as they are
    written: the events are read by this one job only."""
    build, natural_key = _BUILDERS[name]
    found = build(activity).select(*natural_key)
    spark, seen = found.sparkSession, Observation()
    path = session.work_dir(spark, f"candidates-{name}")
    found.observe(seen, F.sum(row_bytes(found)).alias("bytes")).write.parquet(path)
    return spark.read.schema(found.schema).parquet(path), seen.get["bytes"] or 0


def natural_key(name: str) -> list[str]:
    return list(_BUILDERS[name][1])


def new_members(
    name: str, activity: Activity, stored: DataFrame, known_filter: DataFrame | None = None
) -> DataFrame:
    """Members of ``activity`` that the stored dimension ``name`` lacks.

    The candidates are grouped once and, if their measured bytes allow, sent to
    the scan of the stored dimension, which gives back those it has: stored rows
    are read and not moved. Beyond that size both sides meet in one grouping.
    ``known_filter`` has the parts of the dimension's membership filter: only what it
    may know is looked for, and where that is nothing the dimension isn't read.
    """
    candidates, size = _candidates(name, activity)
    keys = natural_key(name)
    known = stored.select(*keys)
    if size > BROADCAST_BYTES:
        return _identified(name, except_distinct(candidates, known))
    asked = candidates
    blocks = known_filter.agg(F.max("blocks")).first()[0] if known_filter is not None else None
    if blocks:
        path = session.work_dir(stored.sparkSession, f"possible-{name}")
        membership.possible(candidates, keys, known_filter, blocks).write.parquet(path)
        asked = stored.sparkSession.read.schema(candidates.schema).parquet(path)
        if asked.isEmpty():
            return _identified(name, candidates)
    # Members are complete, so plain equality finds them; those met are no more than sent.
    met = known.join(F.broadcast(asked), keys, "left_semi")
    return _identified(name, candidates.join(F.broadcast(met), keys, "left_anti"))


def star(spark: SparkSession, activity: Activity) -> Star:
    """All five dimensions of one set of events."""
    return Star(
        dim_time(spark),
        dim_date(activity),
        dim_song(activity),
        dim_user(activity),
        dim_location(activity),
    )
