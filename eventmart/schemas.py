"""Schemas of every table the engine reads or writes.

The wire, landed, dimension, fact and serving layouts below are fixed values:
they are the data contract, so names, types and order are stated plainly.
"""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, BIGINT = T.StringType(), T.IntegerType(), T.LongType()
DOUBLE, BOOLEAN = T.DoubleType(), T.BooleanType()
TIMESTAMP, DATE = T.TimestampType(), T.DateType()

# One type per event attribute; the same name has the same type in all topics.
EVENT_TYPES: dict[str, T.DataType] = {
    "artist": STRING,
    "song": STRING,
    "duration": DOUBLE,
    "ts": TIMESTAMP,
    "sessionId": BIGINT,
    "page": STRING,
    "auth": STRING,
    "method": STRING,
    "status": INT,
    "level": STRING,
    "itemInSession": INT,
    "city": STRING,
    "zip": STRING,
    "state": STRING,
    "userAgent": STRING,
    "lon": DOUBLE,
    "lat": DOUBLE,
    "userId": BIGINT,
    "lastName": STRING,
    "firstName": STRING,
    "gender": STRING,
    "registration": TIMESTAMP,
    "success": BOOLEAN,
}

# The columns of every topic, in order.
TOPIC_COLUMNS: dict[str, list[str]] = {
    "listen_events": [
        "artist", "song", "duration", "ts", "sessionId", "auth", "level", "itemInSession", "city",
        "zip", "state", "userAgent", "lon", "lat", "userId", "lastName", "firstName", "gender",
        "registration",
    ],
    "auth_events": [
        "ts", "sessionId", "level", "itemInSession", "city", "zip", "state", "userAgent", "lon",
        "lat", "userId", "lastName", "firstName", "gender", "registration", "success",
    ],
    "page_view_events": [
        "ts", "sessionId", "page", "auth", "method", "status", "level", "itemInSession", "city",
        "zip", "state", "userAgent", "lon", "lat", "userId", "lastName", "firstName", "gender",
        "registration", "artist", "song", "duration",
    ],
    "status_change_events": [
        "ts", "sessionId", "auth", "level", "itemInSession", "city", "zip", "state", "userAgent",
        "lon", "lat", "userId", "lastName", "firstName", "gender", "registration",
    ],
}

# Topics with song and artist text that needs repair on the way in.
TEXT_TOPICS = ("listen_events", "page_view_events")
# The three topics the star schema is built from.
STAR_TOPICS = ("listen_events", "auth_events", "page_view_events")

# On the wire these two are epoch milliseconds.
EPOCH_COLUMNS = ("ts", "registration")


def _struct(columns: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


def wire(topic: str) -> T.StructType:
    """JSON schema of a topic: times are BIGINT epoch milliseconds."""
    return _struct(
        {c: BIGINT if c in EPOCH_COLUMNS else EVENT_TYPES[c] for c in TOPIC_COLUMNS[topic]}
    )


def landed(topic: str, partitioned: bool = True) -> T.StructType:
    """Parquet schema of a landed topic, with its ``date`` partition column."""
    columns = {c: EVENT_TYPES[c] for c in TOPIC_COLUMNS[topic]}
    return _struct({**columns, "date": DATE} if partitioned else columns)


DIMENSIONS: dict[str, T.StructType] = {
    "dim_time": _struct({"time_id": STRING, "hour": INT, "minute": INT, "second": INT}),
    "dim_date": _struct(
        {
            "date_id": STRING,
            "day": INT,
            "dayOfWeek": INT,
            "week": INT,
            "month": INT,
            "year": INT,
            "quarter": INT,
        }
    ),
    "dim_song": _struct(
        {"song_id": STRING, "title": STRING, "artist": STRING, "duration": DOUBLE}
    ),
    "dim_location": _struct(
        {
            "location_id": STRING,
            "city": STRING,
            "zip": STRING,
            "state": STRING,
            "lon": DOUBLE,
            "lat": DOUBLE,
        }
    ),
    "dim_user": _struct(
        {
            "userId": STRING,
            "lastName": STRING,
            "firstName": STRING,
            "gender": STRING,
            "level": STRING,
            "registration": STRING,
        }
    ),
}

FACTS: dict[str, T.StructType] = {
    "fact_listen": _struct(
        {
            "time_id": STRING,
            "date_id": STRING,
            "song_id": STRING,
            "userId": STRING,
            "location_id": STRING,
            "sessionId": BIGINT,
            "itemInSession": INT,
            "auth": STRING,
            "userAgent": STRING,
        }
    ),
    "fact_auth": _struct(
        {
            "time_id": STRING,
            "date_id": STRING,
            "userId": STRING,
            "location_id": STRING,
            "sessionId": BIGINT,
            "itemInSession": INT,
            "userAgent": STRING,
            "success": BOOLEAN,
        }
    ),
    "fact_page_view": _struct(
        {
            "time_id": STRING,
            "date_id": STRING,
            "song_id": STRING,
            "userId": STRING,
            "location_id": STRING,
            "sessionId": BIGINT,
            "itemInSession": INT,
            "page": STRING,
            "auth": STRING,
            "method": STRING,
            "status": STRING,
            "userAgent": STRING,
        }
    ),
}

# Which topic feeds which fact.
FACT_TOPIC = {
    "fact_listen": "listen_events",
    "fact_auth": "auth_events",
    "fact_page_view": "page_view_events",
}

# Natural keys: the columns that identify one dimension member.
SONG_KEY = ("title", "artist", "duration")
LOCATION_KEY = ("city", "zip", "state", "lon", "lat")
USER_KEY = ("userId", "lastName", "firstName", "gender", "level", "registration")
DATE_KEY = ("day", "dayOfWeek", "week", "month", "year", "quarter")
TIME_KEY = ("hour", "minute", "second")

_MINUTE = {
    "year": INT,
    "week": INT,
    "month": INT,
    "day": INT,
    "hour": INT,
    "minute": INT,
    "ingest_ts": TIMESTAMP,
    "count": BIGINT,
}

# Serving tables: rows with the same key replace each other.
SERVING: dict[str, T.StructType] = {
    "listen_count_minute": _struct(_MINUTE),
    "song_chart_minute": _struct({"song": STRING, **_MINUTE}),
    "artist_chart_minute": _struct({"artist": STRING, **_MINUTE}),
    "user_activity_minute": _struct({"state": STRING, **_MINUTE}),
    "gender_distribution_minute": _struct(
        {"gender": STRING, "level": STRING, "count": BIGINT, "ingest_ts": TIMESTAMP}
    ),
    "user_login": _struct(
        {
            "userId": STRING,
            "lastName": STRING,
            "firstName": STRING,
            "gender": STRING,
            "level": STRING,
            "registration": TIMESTAMP,
            "ts": TIMESTAMP,
        }
    ),
}

# (partition key, clustering column); clustering order is newest first.
SERVING_KEYS: dict[str, tuple[tuple[str, ...], str]] = {
    "listen_count_minute": (("year", "month", "week", "day", "hour", "minute"), "ingest_ts"),
    "song_chart_minute": (("song",), "ingest_ts"),
    "artist_chart_minute": (("artist",), "ingest_ts"),
    "user_activity_minute": (("state",), "ingest_ts"),
    "gender_distribution_minute": (("gender", "level"), "ingest_ts"),
    "user_login": (("userId",), "ts"),
}


def serving_key(table: str) -> list[str]:
    """All columns of a serving table's primary key."""
    partition, clustering = SERVING_KEYS[table]
    return [*partition, clustering]
