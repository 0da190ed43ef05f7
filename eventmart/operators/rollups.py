"""Roll-ups kept beside the facts: counts and exact sets of users, changed by each load.

A load adds what its own facts come to (a delta) as one more part of each roll-up, in
the same commit as the facts. Questions add parts up: counts by sums, sets of users by
OR of bitmaps, so both are exact at any coarser grain and no fact is read again.

* ``rollup_songs``, ``rollup_places``: plays per day, hour and song or place.
* ``rollup_logins``: users that logged in per day and hour, as bitmaps. Users have dense
  numbers (``user_numbers``), so a bitmap of 32,768 users (one bucket, 4 KB) is well
  filled; a user keeps their number for good. Those who came in the same month have
  numbers beside each other, so an hour has bitmaps of the months its users came in,
  however many users there are before and after.

Both are grouped within the scan tasks first, so a song or an hour with a third of all
rows is one row per task. Finer grains than an hour are asked of the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart import schemas
from eventmart.operators.analytics import GRAINS
from eventmart.operators.dims import Star
from eventmart.operators.lookup import lookup
from eventmart.operators.topk import top_k

_DAY_HOUR = [T.StructField("date_id", T.StringType()), T.StructField("hour", T.IntegerType())]
ROLLUPS = {
    "rollup_songs": T.StructType([*_DAY_HOUR, T.StructField("song_id", T.StringType()), T.StructField("plays", T.LongType())]),
    "rollup_places": T.StructType([*_DAY_HOUR, T.StructField("location_id", T.StringType()), T.StructField("plays", T.LongType())]),
    "rollup_logins": T.StructType([*_DAY_HOUR, T.StructField("bucket", T.LongType()), T.StructField("users", T.BinaryType())]),
}
USER_NUMBERS = T.StructType([T.StructField("userId", T.StringType()), T.StructField("number", T.LongType())])
# Grains an hour divides.
COARSE = ("year", "month", "week", "day", "hour")


def _hour() -> F.Column:
    return F.substring("time_id", 1, 2).cast("int").alias("hour")


def plays(fact_listen: DataFrame, key: str) -> DataFrame:
    """Plays per day, hour and ``key`` of some facts."""
    return fact_listen.groupBy("date_id", _hour(), key).agg(F.count(F.lit(1)).alias("plays"))


def number_users(users: DataFrame, known: DataFrame | None, first: int) -> DataFrame:
    """Numbers from ``first`` on, without gaps, for the users ``known`` has not.

    ``users`` are facts, with repeats. Users are dealt to the month of their first fact
    and hash partitions of it, ranked within each, and moved up by the counts of the
    parts before, one row per part.
    """
    month = F.substring("date_id", 1, 6)
    new = users.where("userId is not null").groupBy("userId").agg(F.min(month).alias("month"))
    if known is not None:
        new = new.join(known.select("userId"), "userId", "left_anti")
    parts = int(users.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = new.withColumn("part", F.struct("month", F.pmod(F.xxhash64("userId"), F.lit(parts)).cast("int").alias("piece")))
    counts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    moved = counts.select("part", (F.coalesce(F.sum("n").over(before), F.lit(0)) + first).alias("base"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy("userId")) - 1
    return dealt.withColumn("rank", rank).join(F.broadcast(moved), "part").select("userId", (F.col("base") + F.col("rank")).alias("number"))


def logins(fact_auth: DataFrame, numbers: DataFrame) -> DataFrame:
    """Users with a successful login per day and hour, as bitmaps.

    Numbers are brought together by day and bucket before bitmaps are made of them, so
    eight bytes a user are moved rather than the 4 KB bitmaps of every task, and the
    hours of a day stay together for the questions.
    """
    seen = fact_auth.where("success").select("date_id", _hour(), "userId").distinct()
    numbered = seen.join(numbers, "userId").select("date_id", "hour", F.col("number") + 1)
    numbered = numbered.toDF("date_id", "hour", "number")
    dealt = numbered.withColumn("bucket", F.bitmap_bucket_number("number")).repartition("date_id", "bucket")
    return dealt.groupBy("date_id", "hour", "bucket").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users")
    )


def _periods(rollup: DataFrame, star: Star, grain: str | None) -> tuple[DataFrame, list[str]]:
    """A roll-up with the columns of a period; its days are looked up."""
    if grain is None:
        return rollup, []
    if grain not in COARSE:
        raise ValueError(f"grain must be one of {COARSE}, not {grain!r}")
    columns = GRAINS[grain]
    by_date = [c for c in columns if c in schemas.DATE_KEY]
    return lookup(rollup, star.date, {"date_id": "date_id"}, by_date, salts=1), columns


def logged_in_users(rollup_logins: DataFrame, star: Star, grain: str) -> DataFrame:
    """Distinct users that logged in per period: OR of bitmaps, then their bits."""
    rows, columns = _periods(rollup_logins, star, grain)
    merged = rows.groupBy(*columns, "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    counted = merged.groupBy(*columns).agg(F.sum(F.bitmap_count("users")).alias("users"))
    return counted.select(*columns, "users")


def songs_played(rollup_songs: DataFrame, star: Star, grain: str) -> DataFrame:
    rows, columns = _periods(rollup_songs, star, grain)
    return rows.groupBy(*columns).agg(F.sum("plays").alias("plays"))


def _top(
    rollup: DataFrame, star: Star, grain: str | None, key: str, members: DataFrame, take: Sequence[str],
    keep: Sequence[str], order: Sequence[str], k: int,
) -> DataFrame:
    rows, columns = _periods(rollup, star, grain)
    summed = rows.groupBy(*columns, key).agg(F.sum("plays").alias("plays"))
    named = lookup(summed, members, {key: key}, take, salts=1).groupBy(*columns, *keep).agg(F.sum("plays").alias("plays"))
    named = named.select(*columns, keep[0], "plays", *keep[1:])
    return top_k(named, columns, [F.desc("plays"), *[F.asc(c) for c in order]], k)


def top_songs(rollup_songs: DataFrame, star: Star, grain: str, k: int = 10) -> DataFrame:
    keep = ["song_id", "title", "artist"]
    return _top(rollup_songs, star, grain, "song_id", star.song, keep[1:], keep, ["title", "artist", "song_id"], k)


def top_artists(rollup_songs: DataFrame, star: Star, grain: str, k: int = 10) -> DataFrame:
    return _top(rollup_songs, star, grain, "song_id", star.song, ["artist"], ["artist"], ["artist"], k)


def top_locations(rollup_places: DataFrame, star: Star, grain: str | None = None, k: int = 10) -> DataFrame:
    keep = ["location_id", "city", "zip", "state"]
    return _top(
        rollup_places, star, grain, "location_id", star.location, keep[1:], keep, ["city", "zip", "state", "location_id"], k
    )
