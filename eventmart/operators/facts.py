"""The three fact tables.

A dimension id is a function of the event row and every complete natural key is
a member of its dimension (dimensions are built from the same events), so the
lookups of time, date, song and location reduce to "drop incomplete rows and
compute the key": one scan, no join, no shuffle. ``method="join"`` does the
lookups for real and gives the same rows.

Users are different: a user has one dimension row per version, and a match on
``userId`` alone yields one fact per version (``user_match="id"``), while a
match on the whole version yields one (``user_match="version"``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.functions.calendar import date_key, time_key, with_calendar
from eventmart.functions.keys import location_key, song_key
from eventmart.operators import dims
from eventmart.operators.lookup import lookup, measure
from eventmart.operators.sets import except_distinct

EVENT_SONG_KEY = ("song", "artist", "duration")


def _check(user_match: str, method: str) -> None:
    if user_match not in ("id", "version"):
        raise ValueError(f"user_match must be 'id' or 'version', not {user_match!r}")
    if method not in ("key", "join"):
        raise ValueError(f"method must be 'key' or 'join', not {method!r}")


def lookup_time(events: DataFrame, dim_time: DataFrame) -> DataFrame:
    on = {c: c for c in schemas.TIME_KEY}
    return lookup(events, dim_time, on, ["time_id"], size=dims.DIM_TIME_BYTES)


def lookup_date(events: DataFrame, dim_date: DataFrame) -> DataFrame:
    return lookup(events, dim_date, {c: c for c in schemas.DATE_KEY}, ["date_id"])


def lookup_song(events: DataFrame, dim_song: DataFrame) -> DataFrame:
    on = {"song": "title", "artist": "artist", "duration": "duration"}
    return lookup(events, dim_song, on, ["song_id"])


def lookup_location(events: DataFrame, dim_location: DataFrame) -> DataFrame:
    return lookup(events, dim_location, {c: c for c in schemas.LOCATION_KEY}, ["location_id"])


def lookup_user(
    events: DataFrame,
    dim_user: DataFrame,
    user_match: str = "id",
    user_bytes: int | None = None,
    copies: bool = True,
) -> DataFrame:
    """Join with user versions; facts keep the id only.

    On ``id`` the versions are counted per user first, so the joined side has
    one row per user, and the copies are made after the join, if they are wanted.
    ``user_bytes`` is the measured size of ``dim_user`` where it is known.
    """
    if user_match == "version":
        on = {c: c for c in schemas.USER_KEY}
        return lookup(events, dim_user.withColumn("_seen", F.lit(True)), on, ["_seen"]).drop(
            "_seen"
        )
    versions = dim_user.groupBy("userId").agg(F.count(F.lit(1)).cast("int").alias("_versions"))
    # Ids with a count take no more than the versions they are taken from.
    size = measure(dim_user) if user_bytes is None else user_bytes
    matched = lookup(events, versions, {"userId": "userId"}, ["_versions"], size=size)
    if not copies:
        return matched.select(*events.columns)
    copy = F.explode(F.sequence(F.lit(1), F.col("_versions"))).alias("_copy")
    return matched.select(*events.columns, copy).drop("_copy")


def _stored_form(name: str, rows: DataFrame) -> DataFrame:
    """Fact columns in stored order and type (``status`` becomes text)."""
    return rows.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.FACTS[name].fields]
    )


def _by_key(
    name: str, events: DataFrame, star: dims.Star | None, user_match: str, **users: object
) -> DataFrame:
    has_song = "song_id" in schemas.FACTS[name].names
    needed = ["ts", *schemas.LOCATION_KEY, *(EVENT_SONG_KEY if has_song else ())]
    needed += schemas.USER_KEY if user_match == "version" else ["userId"]
    keys = {
        "time_id": time_key("ts"),
        "date_id": date_key("ts"),
        "location_id": location_key(*schemas.LOCATION_KEY),
    }
    if has_song:
        keys["song_id"] = song_key(*EVENT_SONG_KEY)
    complete = events.dropna("any", subset=list(dict.fromkeys(needed)))
    keyed = _stored_form(name, complete.withColumns(keys))
    if user_match == "version":
        return keyed
    if star is None or star.user is None:
        raise ValueError("user_match='id' needs the user dimension")
    return lookup_user(keyed, star.user, **users)


def _by_join(
    name: str, events: DataFrame, star: dims.Star | None, user_match: str, **users: object
) -> DataFrame:
    if star is None or any(dim is None for dim in star):
        raise ValueError("method='join' needs the dimensions")
    rows = lookup_time(with_calendar(events), star.time)
    rows = lookup_date(rows, star.date)
    if "song_id" in schemas.FACTS[name].names:
        rows = lookup_song(rows, star.song)
    rows = lookup_user(rows, star.user, user_match, **users)
    return _stored_form(name, lookup_location(rows, star.location))


def fact(
    name: str,
    events: DataFrame,
    star: dims.Star | None = None,
    *,
    user_match: str = "version",
    method: str = "key",
    user_bytes: int | None = None,
    copies: bool = True,
) -> DataFrame:
    """Build the fact table ``name`` from its topic's conformed events.

    ``copies=False`` leaves out the repeats that matching on the id makes.
    """
    _check(user_match, method)
    build = _by_key if method == "key" else _by_join
    return build(name, events, star, user_match, user_bytes=user_bytes, copies=copies)


def fact_listen(events: DataFrame, star: dims.Star | None = None, **options: str) -> DataFrame:
    """One row per song listened to."""
    return fact("fact_listen", events, star, **options)


def fact_auth(events: DataFrame, star: dims.Star | None = None, **options: str) -> DataFrame:
    """One row per login attempt, failed ones included."""
    return fact("fact_auth", events, star, **options)


def fact_page_view(events: DataFrame, star: dims.Star | None = None, **options: str) -> DataFrame:
    """One row per page view, guests included."""
    return fact("fact_page_view", events, star, **options)


def new_facts(built: DataFrame, stored: DataFrame, user_match: str = "version") -> DataFrame:
    """Facts not stored yet.

    One fact per event (``version``): as many of equal facts as are missing, so
    that loads day by day and all at once agree. On ``id``, where copies mean
    nothing, equal new facts are one.
    """
    if user_match == "version":
        return built.exceptAll(stored)
    return except_distinct(built, stored)
