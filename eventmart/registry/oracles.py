"""The registered queries in plain SQL over the same tables, for DuckDB.

Written from the meaning of each query, with real joins and ``EXCEPT``, so that
it shares no shortcut with the Spark side.
"""

from __future__ import annotations

from eventmart import schemas
from eventmart.operators.analytics import GRAINS
from eventmart.registry.queries import DELIVERIES, LATE_BY, LATE_DELAY, LATEST, TOP

_BASE = """
base AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type,
    CASE WHEN e.user_id % 3 = 0 AND dayofmonth(e.ts) > 15 THEN 'paid' ELSE 'free' END AS level,
    e.user_id * 100 + dayofmonth(e.ts) AS sessionId,
    CAST(e.event_id % 1000 AS INTEGER) AS itemInSession,
    n.n_name AS city, CAST(10000 + n.n_nationkey AS VARCHAR) AS zip, r.r_name AS state,
    'agent-' || CAST(e.event_id % 5 AS VARCHAR) AS userAgent,
    CAST(n.n_nationkey * 1.5 - 20 AS DOUBLE) AS lon,
    CAST(n.n_nationkey * 0.5 + 10 AS DOUBLE) AS lat,
    c.c_name AS lastName, 'F' || CAST(e.user_id % 10 AS VARCHAR) AS firstName,
    CASE WHEN e.user_id % 11 = 5 THEN NULL WHEN e.user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    make_timestamp(2023, CAST(1 + e.user_id % 12 AS INTEGER), CAST(1 + e.user_id % 28 AS INTEGER),
      0, 0, 0) AS registration,
    p.p_brand AS artist,
    CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE p.p_name END AS song,
    CAST(p.p_size AS DOUBLE) + 0.5 AS duration
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON p.p_partkey = e.event_id % (SELECT count(*) FROM part)
)"""

_PLACE = "city, zip, state, userAgent, lon, lat"
_PERSON = "user_id AS userId, lastName, firstName, gender, registration"
_UNLESS_GUEST = ", ".join(
    f"CASE WHEN event_id % 20 = 0 THEN NULL ELSE {source} END AS {name}"
    for source, name in [
        ("user_id", "userId"),
        ("lastName", "lastName"),
        ("firstName", "firstName"),
        ("gender", "gender"),
        ("registration", "registration"),
    ]
)
_IF_PLAYED = ", ".join(
    f"CASE WHEN event_type IN ('view', 'click', 'purchase') THEN {c} END AS {c}"
    for c in ("artist", "song", "duration")
)

_TOPICS = f"""
listen_events AS (
  SELECT artist, song, duration, ts, sessionId, 'Logged In' AS auth, level, itemInSession,
    {_PLACE}, {_PERSON}
  FROM base WHERE event_type IN ('view', 'click', 'purchase')
),
auth_events AS (
  SELECT ts, sessionId, level, itemInSession, {_PLACE}, {_PERSON},
    event_type = 'signup' AS success
  FROM base WHERE event_type IN ('signup', 'error')
),
page_view_events AS (
  SELECT ts, sessionId, event_type AS page,
    CASE WHEN event_id % 20 = 0 THEN 'Guest' ELSE 'Logged In' END AS auth,
    CASE WHEN event_type = 'view' THEN 'GET' ELSE 'PUT' END AS method,
    CASE WHEN event_type = 'error' THEN 404 ELSE 200 END AS status,
    level, itemInSession, {_PLACE}, {_UNLESS_GUEST}, {_IF_PLAYED}
  FROM base
),
status_change_events AS (
  SELECT ts, sessionId, 'Logged In' AS auth, level, itemInSession, {_PLACE}, {_PERSON}
  FROM base WHERE event_type = 'signup'
)"""

_TEXT_ID = "CAST(userId AS VARCHAR) AS userId, CAST(registration AS VARCHAR) AS registration"


def _filled(*columns: str) -> str:
    return ", ".join(f"coalesce({c}, 'empty') AS {c}" for c in columns)


# Conformed events: text ids, guests completed.
_CONFORMED = f"""
listen AS (SELECT * EXCLUDE (userId, registration), {_TEXT_ID} FROM listen_events),
auth AS (SELECT * EXCLUDE (userId, registration), {_TEXT_ID} FROM auth_events),
page_view AS (
  SELECT ts, sessionId, status, itemInSession, lon, lat,
    {_filled("page", "auth", "method", "level", "city", "zip", "state", "userAgent")},
    coalesce(CAST(userId AS VARCHAR), CASE WHEN level = 'free' THEN '0' ELSE '1' END) AS userId,
    {_filled("lastName", "firstName", "gender", "artist", "song")},
    coalesce(CAST(registration AS VARCHAR), 'empty') AS registration,
    coalesce(duration, 0.0) AS duration
  FROM page_view_events
)"""


def _sized(*parts: str) -> str:
    """md5 of the parts, each as length:text."""
    texts = [f"CAST({p} AS VARCHAR)" for p in parts]
    return "md5(" + " || ".join(f"CAST(length({t}) AS VARCHAR) || ':' || {t}" for t in texts) + ")"


def _not_null(columns) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


_CALENDAR = (
    "CAST(dayofmonth(ts) AS INTEGER) AS day, CAST(dayofweek(ts) + 1 AS INTEGER) AS dayOfWeek, "
    "CAST(weekofyear(ts) AS INTEGER) AS week, CAST(month(ts) AS INTEGER) AS month, "
    "CAST(year(ts) AS INTEGER) AS year, CAST(quarter(ts) AS INTEGER) AS quarter"
)
_CLOCK = (
    "CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute, "
    "CAST(second(ts) AS INTEGER) AS second"
)


def _dims(days: str = "TRUE", prefix: str = "") -> str:
    """The dimensions of the events on ``days`` (a condition on ts), as CTEs."""
    user = ", ".join(schemas.USER_KEY)
    place = ", ".join(schemas.LOCATION_KEY)
    three = lambda columns: " UNION ".join(
        f"SELECT {columns} FROM {t} WHERE {days}" for t in ("listen", "auth", "page_view")
    )
    return f"""
{prefix}dim_date AS (
  SELECT strftime(make_date(year, month, day), '%Y%m%d') AS date_id,
    day, dayOfWeek, week, month, year, quarter
  FROM ({three(_CALENDAR)}) WHERE {_not_null(schemas.DATE_KEY)}
),
{prefix}dim_user AS (SELECT {user} FROM ({three(user)}) WHERE {_not_null(schemas.USER_KEY)}),
{prefix}dim_location AS (
  SELECT {_sized(*schemas.LOCATION_KEY)} AS location_id, {place}
  FROM ({three(place)}) WHERE {_not_null(schemas.LOCATION_KEY)}
),
{prefix}dim_song AS (
  SELECT {_sized(*schemas.SONG_KEY)} AS song_id, title, artist, duration
  FROM (SELECT song AS title, artist, duration FROM listen WHERE {days}
        UNION SELECT song, artist, duration FROM page_view WHERE {days})
  WHERE {_not_null(schemas.SONG_KEY)}
)"""


_DIM_TIME = """
dim_time AS (
  SELECT lpad(CAST(h.h * 10000 + m.m * 100 + s.s AS VARCHAR), 6, '0') AS time_id,
    CAST(h.h AS INTEGER) AS hour, CAST(m.m AS INTEGER) AS minute, CAST(s.s AS INTEGER) AS second
  FROM range(24) h(h), range(60) m(m), range(60) s(s)
)"""

_FACT_SOURCE = {"fact_listen": "listen", "fact_auth": "auth", "fact_page_view": "page_view"}


def _fact_select(name: str, user_match: str, days: str = "TRUE", prefix: str = "") -> str:
    """A fact table by joining every dimension."""
    columns = []
    for column in schemas.FACTS[name].names:
        alias = {
            "time_id": "t.time_id",
            "date_id": "d.date_id",
            "song_id": "s.song_id",
            "location_id": "l.location_id",
            "userId": "u.userId",
            "status": "CAST(e.status AS VARCHAR)",
        }.get(column, f"e.{column}")
        columns.append(f"{alias} AS {column}")
    same = lambda alias, names: " AND ".join(f"e.{c} = {alias}.{c}" for c in names)
    song = (
        f"JOIN {prefix}dim_song s ON e.song = s.title AND e.artist = s.artist"
        " AND e.duration = s.duration"
        if "song_id" in schemas.FACTS[name].names
        else ""
    )
    users = schemas.USER_KEY if user_match == "version" else ("userId",)
    return f"""
  SELECT {", ".join(columns)}
  FROM (SELECT *, {_CALENDAR}, {_CLOCK} FROM {_FACT_SOURCE[name]} WHERE {days}) e
  JOIN dim_time t ON {same("t", schemas.TIME_KEY)}
  JOIN {prefix}dim_date d ON {same("d", schemas.DATE_KEY)}
  {song}
  JOIN {prefix}dim_user u ON {same("u", users)}
  JOIN {prefix}dim_location l ON {same("l", schemas.LOCATION_KEY)}"""


def _with(*parts: str, query: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n" + query.strip()


def _topics_query(query: str) -> str:
    return _with(_BASE, _TOPICS, query=query)


def _star_query(query: str, *extra: str) -> str:
    return _with(_BASE, _TOPICS, _CONFORMED, _DIM_TIME, _dims(), *extra, query=query)


# --- minute tables -----------------------------------------------------------

_MINUTE_FIELDS = (
    "CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month, "
    "CAST(weekofyear(m) AS INTEGER) AS week, CAST(dayofmonth(m) AS INTEGER) AS day, "
    "CAST(hour(m) AS INTEGER) AS hour, CAST(minute(m) AS INTEGER) AS minute, "
    'm AS ingest_ts, n AS "count"'
)


def _minute_sql(table: str, closed: bool = False, delay: str = "") -> str:
    """A minute table; ``closed`` leaves out the minutes a stream still holds open."""
    topic, keys, shown = {
        "listen_count_minute": ("listen_events", [], ""),
        "song_chart_minute": ("listen_events", ["song"], "song,"),
        "artist_chart_minute": ("listen_events", ["artist"], "artist,"),
        "user_activity_minute": ("page_view_events", ["state"], "'US-' || state AS state,"),
        "gender_distribution_minute": ("auth_events", ["gender", "level"], ""),
    }[table]
    source = f"(SELECT * FROM {topic})"
    fields = f"{shown} {_MINUTE_FIELDS}"
    if table == "gender_distribution_minute":
        source = f"(SELECT * FROM {topic} WHERE gender IS NOT NULL AND level IS NOT NULL)"
        fields = 'gender, level, n AS "count", m AS ingest_ts'
    group = ", ".join([*keys, "date_trunc('minute', ts)"])
    named = "".join(f"{k}, " for k in keys)
    conditions = []
    if closed:
        conditions = [f"m + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM {source}){delay}"]
    where = f"WHERE {' AND '.join(conditions)}" if conditions else ""
    return f"""
SELECT {fields}
FROM (SELECT {named} date_trunc('minute', ts) AS m, count(*) AS n FROM {source} x GROUP BY {group})
{where}"""


_LOGIN = """
SELECT DISTINCT_ CAST(userId AS VARCHAR) AS userId, lastName, firstName, gender, level,
  registration, TS_ AS ts
FROM auth_events WHERE userId IS NOT NULL"""


def _login_sql(condition: str = "", distinct: str = "", ts: str = "ts") -> str:
    return _LOGIN.replace("DISTINCT_", distinct).replace("TS_", ts) + condition


_MS = "date_trunc('millisecond', ts)"


def _decoded_sql(topic: str, extra: str = "") -> str:
    columns = [f"{_MS} AS ts" if c == "ts" else c for c in schemas.TOPIC_COLUMNS[topic]]
    return _topics_query(f"SELECT {', '.join(columns)}{extra} FROM {topic}")


# Every tenth listen comes two deliveries after its time. It counts if its minute is
# not over when that delivery comes: rows are late by the clock that the delivery
# before it began with, the latest listen of all deliveries before that one.
_LATE_BASE = _BASE.replace("SELECT e.event_id, e.ts,", f"""SELECT
    CAST(floor((epoch_us(date_trunc('second', e.ts)) // 1000000 - (SELECT min(epoch_us(date_trunc('second', ts)) // 1000000) FROM events))
      * {DELIVERIES} / (SELECT max(epoch_us(date_trunc('second', ts)) // 1000000) - min(epoch_us(date_trunc('second', ts)) // 1000000) + 1 FROM events)) AS INTEGER)
      + CASE WHEN e.event_id % 10 = 0 THEN {LATE_BY} ELSE 0 END AS delivery,
    e.event_id, e.ts,""")
_LATE_SQL = f"""
SELECT artist, {_MINUTE_FIELDS}
FROM (
  SELECT artist, date_trunc('minute', ts) AS m, count(*) AS n
  FROM base b
  WHERE event_type IN ('view', 'click', 'purchase')
    AND date_trunc('minute', ts) + INTERVAL 1 MINUTE > coalesce(
      (SELECT max(o.ts) FROM base o WHERE o.event_type IN ('view', 'click', 'purchase')
       AND o.delivery < b.delivery - 1), TIMESTAMP '1970-01-01')
  GROUP BY ALL
)
WHERE m + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM listen_events)"""


# --- loads -------------------------------------------------------------------

_LAST_DAY = "(SELECT max(CAST(ts AS DATE)) FROM events)"
_FIRST_DAY = "(SELECT min(CAST(ts AS DATE)) FROM events)"
_FIRST_HOUR_END = "(SELECT min(ts) + INTERVAL 1 HOUR FROM events)"
_BEFORE_LAST = f"CAST(ts AS DATE) < {_LAST_DAY}"
_ON_LAST = f"CAST(ts AS DATE) = {_LAST_DAY}"


def _count_rows(tables: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"
        for name, source in tables.items()
    )


def _loaded_fact_sql(name: str, user_match: str) -> str:
    """Full load of the first days, then the last day; on ``id`` without duplicates."""
    distinct = "DISTINCT" if user_match == "id" else ""
    return f"""(
  SELECT * FROM ({_fact_select(name, user_match, _BEFORE_LAST, "old_")})
  UNION ALL
  SELECT {distinct} * FROM ({_fact_select(name, user_match, _ON_LAST)})
)"""


def _load_query(query: str) -> str:
    return _with(
        _BASE, _TOPICS, _CONFORMED, _DIM_TIME, _dims(), _dims(_BEFORE_LAST, "old_"), query=query
    )


def _load_counts_sql(incremental: bool) -> str:
    prefix = "" if incremental else "old_"
    tables = {"dim_time": "dim_time"}
    tables |= {n: f"{prefix}{n}" for n in schemas.DIMENSIONS if n != "dim_time"}
    for name in schemas.FACTS:
        tables[name] = (
            _loaded_fact_sql(name, "id")
            if incremental
            else f"({_fact_select(name, 'id', _BEFORE_LAST, 'old_')})"
        )
    return _load_query(_count_rows(tables))


def _stream_job_sql() -> str:
    tables = {t: f"({_minute_sql(t, closed=True)})" for t in schemas.SERVING if t != "user_login"}
    key = f"userId, {_MS} AS ts"
    tables["user_login"] = (
        f"(SELECT DISTINCT {key} FROM auth_events WHERE userId IS NOT NULL)"
    )
    tables |= {t: t for t in schemas.STAR_TOPICS}
    return _topics_query(_count_rows(tables))


# --- analytical questions ----------------------------------------------------


def _grain_select(grain: str | None) -> tuple[str, str]:
    columns = GRAINS[grain] if grain else []
    qualified = [
        f"t.{c}" if c in ("hour", "minute", "second") else f"d.{c}" for c in columns
    ]
    return "".join(f"{q}, " for q in qualified), ", ".join(columns)


def _at_grain(name: str, grain: str | None, measure: str, joins: str = "", where: str = "") -> str:
    select, group = _grain_select(grain)
    return f"""
SELECT {select} {measure}
FROM ({_fact_select(name, "version")}) f
JOIN dim_date d ON f.date_id = d.date_id JOIN dim_time t ON f.time_id = t.time_id {joins}
{where} {"GROUP BY ALL" if group or "," in measure else ""}"""


def _top_sql(grain: str | None, keys: list[str], joins: str, order: list[str]) -> str:
    columns = ", ".join(keys)
    counted = _at_grain("fact_listen", grain, f"{columns}, count(*) AS plays", joins)
    _, group = _grain_select(grain)
    partition = f"PARTITION BY {group}" if group else ""
    names = [k.split(" AS ")[-1].split(".")[-1] for k in keys]
    return _star_query(
        f"""
SELECT * FROM (
  SELECT {group + "," if group else ""} {", ".join(names)}, plays,
    CAST(row_number() OVER ({partition} ORDER BY plays DESC, {", ".join(order)}) AS INTEGER)
      AS "rank"
  FROM ({counted})
) WHERE "rank" <= {TOP}"""
    )


_SONG_JOIN = "JOIN dim_song s ON f.song_id = s.song_id"
_PLACE_JOIN = "JOIN dim_location l ON f.location_id = l.location_id"


def all_oracles() -> dict[str, str]:
    sql: dict[str, str] = {}
    minute_tables = [t for t in schemas.SERVING if t != "user_login"]
    for table in minute_tables:
        sql[table] = _topics_query(_minute_sql(table))
        sql[f"stream_{table}"] = _topics_query(_minute_sql(table, closed=True))
    sql["user_login"] = _topics_query(_login_sql())
    sql["user_login_success"] = _topics_query(_login_sql(" AND success"))
    # One row per key (userId, ts); rows sharing a key resolve to the largest.
    sql["stream_user_login"] = _topics_query(
        f"""
SELECT userId, last.lastName AS lastName, last.firstName AS firstName, last.gender AS gender,
  last.level AS level, last.registration AS registration, ts
FROM (
  SELECT userId, ts, max(struct_pack(lastName := lastName, firstName := firstName,
    gender := gender, level := level, registration := registration)) AS last
  FROM ({_login_sql(ts=_MS)}) GROUP BY userId, ts
)"""
    )
    sql["stream_late_rows_admitted"] = _topics_query(
        _minute_sql("artist_chart_minute", closed=True, delay=f" - INTERVAL {LATE_DELAY}")
    )
    sql["stream_late_rows_dropped"] = _with(_LATE_BASE, _TOPICS, query=_LATE_SQL)
    middle = "(SELECT min(CAST(ts AS DATE)) + CAST((max(CAST(ts AS DATE)) - min(CAST(ts AS DATE))) // 2 AS INTEGER) FROM events)"
    sql["keyed_sink_restart"] = _topics_query(
        f"""
SELECT * REPLACE (CASE WHEN ingest_ts >= {middle} THEN "count" + 100 ELSE "count" END AS "count")
FROM ({_minute_sql("song_chart_minute")})"""
    )
    noon = f"({_LAST_DAY} + INTERVAL 12 HOUR)"
    sql["latest_minutes_range"] = _topics_query(
        f"""
SELECT * FROM ({_minute_sql("song_chart_minute")})
WHERE ingest_ts >= {noon} - INTERVAL 2 DAY AND ingest_ts < {noon}
ORDER BY ingest_ts DESC, song NULLS FIRST, year, week, month, day, hour, minute LIMIT {LATEST}"""
    )
    sql["keyed_sink_latest"] = _topics_query(_minute_sql("artist_chart_minute"))
    everything = ", ".join(
        ["ingest_ts DESC", "song NULLS FIRST", "year", "week", "month", "day", "hour", "minute"]
    )
    sql["latest_minutes"] = _topics_query(
        f"{_minute_sql('song_chart_minute')}\nORDER BY {everything} LIMIT {LATEST}"
    )

    for name in ("dim_date", "dim_song", "dim_user", "dim_location"):
        sql[name] = _star_query(f"SELECT * FROM {name}")
    sql["dim_time_logins"] = _star_query(
        f"""
SELECT t.time_id, t.hour, t.minute, t.second, count(*) AS logins
FROM dim_time t JOIN ({_fact_select("fact_auth", "version")}) f ON f.time_id = t.time_id
GROUP BY ALL"""
    )
    for name in schemas.FACTS:
        sql[name] = _star_query(_fact_select(name, "id"))
        sql[f"{name}_by_version"] = _star_query(_fact_select(name, "version"))
        sql[f"{name}_by_join"] = sql[name]
    sql["fact_listen_by_version_join"] = sql["fact_listen_by_version"]

    conformed = lambda query: _with(_BASE, _TOPICS, _CONFORMED, query=query)
    level = "CASE WHEN hour(ts) % 12 < 6 THEN 'paid' ELSE 'free' END AS level"
    person = f"userId, lastName, firstName, gender, {level}, registration, ts"

    def validity(topics: list[str]) -> str:
        seen = " UNION ALL ".join(f"SELECT {person} FROM {t}" for t in topics)
        # NULL is the least value, as in the engine.
        order = ", ".join(f"coalesce({c}, '')" for c in ("lastName", "firstName", "gender", "level", "registration"))
        values = "lastName := lastName, firstName := firstName, gender := gender, level := level, registration := registration"
        return f"""
  SELECT userId, v.lastName AS lastName, v.firstName AS firstName, v.gender AS gender, v.level AS level,
    v.registration AS registration, ts AS valid_from, lead(ts) OVER (PARTITION BY userId ORDER BY ts) AS valid_to
  FROM (
    SELECT *, lag(v) OVER (PARTITION BY userId ORDER BY ts) AS previous
    FROM (SELECT userId, ts, arg_max(struct_pack({values}), [{order}]) AS v FROM ({seen}) WHERE userId IS NOT NULL AND ts IS NOT NULL GROUP BY ALL)
  ) WHERE previous IS DISTINCT FROM v"""

    sql["user_validity"] = conformed(validity(["listen", "auth", "page_view"]))
    sql["listen_as_of_user"] = conformed(
        f"""
SELECT l.userId, l.ts, l.song, v.level AS valid_level, v.gender AS valid_gender, v.valid_from AS valid_valid_from
FROM listen l ASOF LEFT JOIN ({validity(["auth", "page_view"])}) v ON l.userId = v.userId AND l.ts >= v.valid_from"""
    )
    sql["page_view_guest_defaults"] = conformed(
        f"SELECT {', '.join(schemas.TOPIC_COLUMNS['page_view_events'])} FROM page_view"
    )
    shared = ", ".join(c for c in schemas.TOPIC_COLUMNS["auth_events"] if c != "success")
    sql["union_all_topics"] = conformed(
        " UNION ALL ".join(f"SELECT {shared} FROM {t}" for t in ("auth", "listen", "page_view"))
    )
    sql["page_view_only_users"] = conformed(
        "SELECT userId, gender, level FROM page_view EXCEPT "
        "SELECT userId, gender, level FROM listen"
    )
    for name in ("dim_user", "dim_date", "dim_song", "dim_location"):
        sql[f"new_{name}"] = _with(
            _BASE,
            _TOPICS,
            _CONFORMED,
            _dims(f"ts < {_FIRST_HOUR_END}", "old_"),
            _dims(f"ts >= {_FIRST_HOUR_END}", "late_"),
            query=f"SELECT * FROM late_{name} EXCEPT SELECT * FROM old_{name}",
        )
    for name in schemas.FACTS:
        old = _fact_select(name, "version", f"ts < {_FIRST_HOUR_END}")
        sql[f"new_{name}"] = _star_query(
            f"SELECT * FROM ({_fact_select(name, 'version')}) EXCEPT ALL SELECT * FROM ({old})"
        )

    landed = "SELECT *, CAST(ts AS DATE) AS date FROM auth_events"
    sql["landed_full"] = _topics_query(landed)
    sql["landed_day"] = _topics_query(f"{landed} WHERE CAST(ts AS DATE) = {_LAST_DAY}")
    sql["landed_stream"] = _decoded_sql("page_view_events", ", CAST(ts AS DATE) AS date")
    sql["fact_by_date_ids"] = _star_query(
        f"""
SELECT * FROM ({_fact_select("fact_listen", "version")})
WHERE date_id IN (strftime({_FIRST_DAY}, '%Y%m%d'), strftime({_LAST_DAY}, '%Y%m%d'))"""
    )
    sql["full_load_counts"] = _load_counts_sql(False)
    sql["incremental_load_counts"] = _load_counts_sql(True)
    sql["loaded_fact_listen"] = _load_query(
        f"SELECT * FROM {_loaded_fact_sql('fact_listen', 'id')}"
    )
    sql["loaded_fact_page_view"] = _load_query(
        f"SELECT * FROM {_loaded_fact_sql('fact_page_view', 'version')}"
    )
    sql["catalog_sql"] = _star_query(
        f"""
SELECT d.year, d.month, d.day, l.state, count(*) AS plays
FROM ({_fact_select("fact_listen", "version")}) f
JOIN dim_date d ON f.date_id = d.date_id
JOIN dim_location l ON f.location_id = l.location_id
GROUP BY ALL"""
    )
    for topic in schemas.TOPIC_COLUMNS:
        sql[f"decode_{topic}"] = _decoded_sql(topic)
    sql["decode_open_listen_events"] = _decoded_sql("listen_events", ", length(song) AS build")
    sql["stream_job_counts"] = _stream_job_sql()

    for grain in GRAINS:
        sql[f"logged_in_users_{grain}"] = _star_query(
            _at_grain(
                "fact_auth", grain, "count(DISTINCT f.userId) AS users", where="WHERE f.success"
            )
        )
        sql[f"songs_played_{grain}"] = _star_query(
            _at_grain("fact_listen", grain, "count(*) AS plays")
        )
    for grain in [*GRAINS, None]:
        suffix = f"_{grain}" if grain else ""
        sql[f"top_locations{suffix}"] = _top_sql(
            grain,
            ["f.location_id", "l.city", "l.zip", "l.state"],
            _PLACE_JOIN,
            ["city", "zip", "state", "location_id"],
        )
        if grain:
            sql[f"top_songs{suffix}"] = _top_sql(
                grain,
                ["f.song_id", "s.title", "s.artist"],
                _SONG_JOIN,
                ["title", "artist", "song_id"],
            )
            sql[f"top_artists{suffix}"] = _top_sql(grain, ["s.artist"], _SONG_JOIN, ["artist"])
    sql["user_distribution"] = _star_query(
        "SELECT gender, level, count(DISTINCT userId) AS users FROM dim_user GROUP BY ALL"
    )
    sql["avg_songs_per_user"] = _star_query(
        f"""
SELECT avg(plays) AS avg_songs, count(*) AS users
FROM (SELECT userId, count(*) AS plays FROM ({_fact_select("fact_listen", "version")})
      GROUP BY userId)"""
    )

    marked = [f"{_MS} AS ts" if c == "ts" else "mark AS userAgent" if c == "userAgent" else c for c in schemas.TOPIC_COLUMNS["page_view_events"]]
    sql["landed_stream_restart"] = _topics_query(
        f"SELECT {', '.join(marked)}, CAST(ts AS DATE) AS date FROM page_view_events, (VALUES ('first'), ('second'), ('batch')) AS m(mark)"
    )
    sql["landed_absent_day"] = sql["landed_day"]
    sql["stream_resumed"] = sql["stream_song_chart_minute"]
    sql["serving_by_key"] = _topics_query(
        f"""
SELECT * REPLACE ("count" + 2 AS "count") FROM ({_minute_sql("artist_chart_minute")})
WHERE artist = (SELECT artist FROM listen_events GROUP BY artist ORDER BY count(*) DESC, artist LIMIT 1)"""
    )
    for table in minute_tables:
        sql[f"by_topic_{table}"] = sql[table]
    sql["by_topic_landed_counts"] = _topics_query(_count_rows({t: t for t in schemas.STAR_TOPICS}))
    tables = {"dim_time": "dim_time"} | {n: f"old_{n}" for n in schemas.DIMENSIONS if n != "dim_time"}
    tables |= {n: f"({_fact_select(n, 'version', _BEFORE_LAST, 'old_')})" for n in schemas.FACTS}
    sql["load_seen_by_old_reader"] = _load_query(_count_rows(tables))
    tables = {"dim_time": "dim_time"} | {n: n for n in schemas.DIMENSIONS if n != "dim_time"}
    tables |= {n: _loaded_fact_sql(n, "version") for n in schemas.FACTS}
    sql["filtered_load_counts"] = _load_query(_count_rows(tables))
    # Roll-ups answer as the facts do.
    for grain in ("year", "month", "week", "day", "hour"):
        for question in ("logged_in_users", "songs_played"):
            sql[f"rollup_{question}_{grain}"] = sql[f"{question}_{grain}"]
    for grain in ("year", "month", "day"):
        for question in ("top_songs", "top_artists"):
            sql[f"rollup_{question}_{grain}"] = sql[f"{question}_{grain}"]
    sql["rollup_top_locations"] = sql["top_locations"]

    sql["repair_text"] = "SELECT doc_id, trim(text, '\"') AS text FROM documents"
    sql["repair_song_text"] = _topics_query("SELECT song, artist FROM listen_events")
    return sql
