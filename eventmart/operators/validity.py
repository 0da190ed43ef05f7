"""User versions with the time they were valid, and the version an event met.

Both carry a value along time per user. A user with a third of all events would be one
window, so windows are cut by time as well: rows are carried within (user, stretch of
``STRETCH`` seconds), and what a stretch begins with comes from the last value of the
stretches before it, one row per user and stretch. Those rows are stored, so that they
meet the events in a join of two plain shuffles, which Spark may split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart import schemas, session
from eventmart.operators.conform import Activity
from eventmart.operators.sets import union_all

STRETCH = 24 * 3600
VALUES = [c for c in schemas.USER_KEY if c != "userId"]


def _stretch(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000)).cast("long")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = session.work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _before(rows: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """Per ``key`` and ``stretch`` the last ``value`` of the stretches before it."""
    last = rows.where(F.col(value).isNotNull()).groupBy(key, "stretch").agg(
        F.max_by(value, F.struct(*order)).alias("last")
    )
    every = rows.select(key, "stretch").distinct().join(last, [key, "stretch"], "left")
    earlier = Window.partitionBy(key).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    found = every.select(key, "stretch", F.last("last", ignorenulls=True).over(earlier).alias("before"))
    return _stored(found.where("before is not null"), "stretches")


def user_validity(activity: Activity, stretch: int = STRETCH) -> DataFrame:
    """A row per stay of a user in one version: USER_KEY, valid_from, valid_to.

    A version is valid from the first event that shows it until the first that shows
    another one; the last has no end. Of versions seen at one time the greatest stands.
    Events that lack the user or the time show nothing.
    """
    seen = union_all([topic.select(*schemas.USER_KEY, "ts") for topic in activity])
    # One version per user and time, which combines before the shuffle.
    at = (
        seen.where("userId is not null and ts is not null")
        .groupBy("userId", "ts")
        .agg(F.max(F.struct(*VALUES)).alias("version"))
        .withColumn("stretch", _stretch(F.col("ts"), stretch))
    )
    at = _stored(at, "versions-seen")
    within = Window.partitionBy("userId", "stretch").orderBy("ts")
    lagged = at.withColumn("previous", F.lag("version").over(within))
    carried = lagged.join(_before(at, "userId", "version", ["ts"]), ["userId", "stretch"], "left")
    changes = carried.where(~F.coalesce("previous", "before").eqNullSafe(F.col("version")))
    # Stays are few per user, as only changes are left.
    stay = Window.partitionBy("userId").orderBy("ts")
    return changes.withColumn("valid_to", F.lead("ts").over(stay)).select(
        "userId", "version.*", F.col("ts").alias("valid_from"), "valid_to"
    )


def as_of(
    events: DataFrame, versions: DataFrame, take: Sequence[str], stretch: int = STRETCH
) -> DataFrame:
    """``events`` with ``take`` of the version that was valid at their time.

    One row per event; without a version yet, or without user or time, the values are
    null. A version counts from its very time on. Columns of ``take`` get the prefix
    ``valid_``.
    """
    columns = F.struct(*[F.col(c) for c in events.columns]).alias("event")
    is_null = F.lit(None)
    value = F.struct(*[F.col(c).alias(f"valid_{c}") for c in take])
    shape = versions.select(value.alias("v")).schema["v"].dataType
    one = events.select("userId", "ts", F.lit(1).alias("kind"), is_null.cast(shape).alias("version"), columns)
    two = versions.select(
        "userId", F.col("valid_from").alias("ts"), F.lit(0).alias("kind"), value.alias("version"),
        is_null.cast(one.schema["event"].dataType).alias("event"),
    )
    timed = "userId is not null and ts is not null"
    rows = one.where(timed).union(two.where(timed)).withColumn("stretch", _stretch(F.col("ts"), stretch))
    rows = _stored(rows, "as-of")
    within = Window.partitionBy("userId", "stretch").orderBy("ts", "kind").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("local", F.last("version", ignorenulls=True).over(within)).where("kind = 1")
    found = local.join(_before(rows, "userId", "version", ["ts"]), ["userId", "stretch"], "left")
    met = found.select("event.*", F.coalesce("local", "before").alias("_met"))
    rest = one.where(f"not coalesce({timed}, false)").select("event.*", is_null.cast(shape).alias("_met"))
    return met.union(rest).select(*events.columns, "_met.*")
