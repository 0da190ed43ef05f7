"""The four topics derived from the sample tables.

Users are customers, songs are parts, places are nations. The mapping yields on
purpose users with two levels, users without a gender, listens without a song,
guest page views and failed logins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.operators.lookup import BROADCAST_BYTES, row_bytes

# Schemas are declared, so planning opens no file. Only these columns are used.
TABLES = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_size INT",
}

_DERIVED = {
    "level": "case when user_id % 3 = 0 and dayofmonth(ts) > 15 then 'paid' else 'free' end",
    "sessionId": "user_id * 100 + dayofmonth(ts)",
    "itemInSession": "cast(event_id % 1000 as int)",
    "city": "n_name",
    "zip": "cast(10000 + n_nationkey as string)",
    "state": "r_name",
    "userAgent": "'agent-' || cast(event_id % 5 as string)",
    "lon": "cast(n_nationkey * 1.5 - 20 as double)",
    "lat": "cast(n_nationkey * 0.5 + 10 as double)",
    "userId": "user_id",
    "lastName": "c_name",
    "firstName": "'F' || cast(user_id % 10 as string)",
    "gender": "case when user_id % 11 = 5 then null when user_id % 2 = 0 then 'F' else 'M' end",
    "registration": (
        "make_timestamp(2023, cast(1 + user_id % 12 as int), "
        "cast(1 + user_id % 28 as int), 0, 0, 0)"
    ),
    "artist": "p_brand",
    "song": "case when event_id % 97 = 0 then null else p_name end",
    "duration": "cast(p_size as double) + 0.5",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _sized(side: DataFrame, most: int) -> tuple[DataFrame, int]:
    """A side of a join, to be merged if its measured rows take more than ``most`` bytes,
    and the number of its rows."""
    rows, size = side.agg(F.count(F.lit(1)), F.sum(row_bytes(side))).first()
    return (side if (size or 0) <= most else side.hint("merge")), rows


def base(spark: SparkSession, sf_dir: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Events with their user, place and song.

    Nations and regions are 25 and 5 rows at every scale, so these are broadcast.
    Customers and parts grow with the data: those joins are left to Spark, which
    broadcasts a side while it is small and splits hot partitions otherwise. It guesses
    sizes by compressed files, so they are measured, and merged beyond ``broadcast_bytes``.
    Every part is a song.
    """
    events = table(spark, sf_dir, "events")
    region = F.broadcast(table(spark, sf_dir, "region"))
    places = table(spark, sf_dir, "nation").join(region, F.expr("n_regionkey = r_regionkey"))
    users, _ = _sized(table(spark, sf_dir, "customer"), broadcast_bytes)
    songs, number = _sized(table(spark, sf_dir, "part"), broadcast_bytes)
    song = F.col("event_id") % F.lit(max(number, 1))
    return (
        events.withColumn("ts", F.col("ts").cast("timestamp"))
        .join(users, F.expr("user_id = c_custkey"))
        .join(F.broadcast(places), F.expr("c_nationkey = n_nationkey"))
        .join(songs, song == F.col("p_partkey"))
        .selectExpr(
            "event_id", "ts", "event_type", *[f"{sql} as {c}" for c, sql in _DERIVED.items()]
        )
    )


_LISTENS = "event_type in ('view', 'click', 'purchase')"
_GUEST = "event_id % 20 = 0"
_UNKNOWN_TO_GUESTS = ("userId", "lastName", "firstName", "gender", "registration")

# Per topic: which events, and the columns that differ from the base rows.
_TOPICS: dict[str, tuple[str, dict[str, str]]] = {
    "listen_events": (_LISTENS, {"auth": "'Logged In'"}),
    "auth_events": (
        "event_type in ('signup', 'error')",
        {"success": "event_type = 'signup'"},
    ),
    "page_view_events": (
        "true",
        {
            "page": "event_type",
            "auth": f"if({_GUEST}, 'Guest', 'Logged In')",
            "method": "if(event_type = 'view', 'GET', 'PUT')",
            "status": "if(event_type = 'error', 404, 200)",
            **{c: f"if({_GUEST}, null, {c})" for c in _UNKNOWN_TO_GUESTS},
            **{c: f"if({_LISTENS}, {c}, null)" for c in ("artist", "song", "duration")},
        },
    ),
    "status_change_events": ("event_type = 'signup'", {"auth": "'Logged In'"}),
}


def as_topic(base_rows: DataFrame, name: str) -> DataFrame:
    """The rows of one topic in landed form, without the partition column."""
    condition, own = _TOPICS[name]
    columns = [f"{own.get(c, c)} as {c}" for c in schemas.TOPIC_COLUMNS[name]]
    return base_rows.where(condition).selectExpr(*columns)


def topic(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return as_topic(base(spark, sf_dir), name)


def as_json(rows: DataFrame) -> DataFrame:
    """Rows as the JSON messages a broker would deliver, times in epoch ms."""
    epoch = rows.withColumns({c: F.unix_millis(c) for c in schemas.EPOCH_COLUMNS})
    return epoch.select(F.to_json(F.struct(*epoch.columns)).alias("value"))
