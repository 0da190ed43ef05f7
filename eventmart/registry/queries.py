"""Registered queries: every operator over the whole sample tables.

Each takes a session and the folder of the sample tables. The topics are derived
from the tables, whose join is stored once per application and folder. Queries on
loads and streams start from the two forms the engine stores, landed parquet and JSON
messages.
Times leave as timestamps without zone (they are UTC).
"""

from __future__ import annotations

import time as time_
from collections.abc import Callable
from datetime import date, datetime, time, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart import schemas, session
from eventmart.functions.nulls import default_guests
from eventmart.functions.text import repair_text
from eventmart.operators import analytics, dims, facts, minutes, rollups, validity
from eventmart.operators.conform import Activity, conform
from eventmart.operators.sets import except_distinct, union_all
from eventmart.plans import catalog, loads
from eventmart.plans.tables import land, merge_folders, run_together
from eventmart.sources import landed, sample, warehouse
from eventmart.sources.files import path_exists
from eventmart.sources.topics import topic_stream
from eventmart.streaming import ingest, job, sinks

Query = Callable[[SparkSession, str], DataFrame]
TOP = 10
LATEST = 100
LATE_DELAY = "20 days"  # longer than a delivery


def without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as UTC wall-clock times."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def _day_span(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """First and last day of the events, two values."""
    day = F.to_date("ts")
    return tuple(sample.table(spark, sf_dir, "events").agg(F.min(day), F.max(day)).first())


_WRITTEN: dict[tuple, str] = {}


def _once(
    spark: SparkSession, sf_dir: str, kind: str, build: Callable[[str], None], *options: object
) -> str:
    """A folder ``build`` filled, made once per application, input and options.

    Landed topics and loaded warehouses are the stored inputs of the queries on
    them, so they are written by the first query that needs them and kept.
    """
    known = (spark.sparkContext.applicationId, sf_dir, kind, *options)
    root = _WRITTEN.get(known)
    if root is None or not path_exists(spark, root):
        root = session.work_dir(spark, kind)
        build(root)
        _WRITTEN[known] = root
    return root


# --- stored inputs -----------------------------------------------------------


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their user, place and song, joined once for all that is stored."""

    def build(root: str) -> None:
        sample.base(spark, sf_dir).write.parquet(root)

    return spark.read.parquet(_once(spark, sf_dir, "base", build))


def _land_all(spark: SparkSession, sf_dir: str) -> str:
    """The three topics derived from the sample tables, landed by day."""

    def build(root: str) -> None:
        base = _base(spark, sf_dir)
        run_together(
            spark,
            [partial(land, sample.as_topic(base, t), root, t) for t in schemas.STAR_TOPICS],
        )

    return _once(spark, sf_dir, "landed", build)


def _topic(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A topic's rows from the stored base, so that a query is its operator's own work."""
    return sample.as_topic(_base(spark, sf_dir), name)


def _activity(spark: SparkSession, sf_dir: str) -> Activity:
    return conform(*[_topic(spark, sf_dir, name) for name in schemas.STAR_TOPICS])


DELIVERIES, FILES = 3, 4
LATE_BY = 2  # deliveries; a stream's clock stands where the one before last left it


def _delivery(spark: SparkSession, sf_dir: str) -> F.Column:
    """Which delivery an event belongs to: equal parts of the time the events span."""
    ts = F.unix_seconds(F.col("ts").cast("timestamp"))
    first, last = sample.table(spark, sf_dir, "events").agg(F.min(ts), F.max(ts)).first()
    span = max((last or 0) - (first or 0) + 1, 1)
    return F.floor((ts - F.lit(first or 0)) * F.lit(DELIVERIES) / F.lit(span)).cast("int")


def _send_all(spark: SparkSession, sf_dir: str, late: bool = False) -> str:
    """The messages of all topics, in deliveries that follow each other in time.

    Each delivery is ``FILES`` files per topic, and a stream takes so many per
    batch. With ``late``, every tenth event comes ``LATE_BY`` deliveries after its time.
    """

    def build(root: str) -> None:
        number = _delivery(spark, sf_dir)
        if late:
            number = F.when(F.col("event_id") % 10 == 0, number + LATE_BY).otherwise(number)
        base = _base(spark, sf_dir).withColumn("_delivery", number)
        for i in range(DELIVERIES + LATE_BY * late):
            part = base.where(F.col("_delivery") == i)
            sent = {
                t: sample.as_json(sample.as_topic(part, t)).repartition(FILES)
                for t in schemas.TOPIC_COLUMNS
            }
            run_together(
                spark,
                [partial(df.write.mode("append").parquet, f"{root}/{t}") for t, df in sent.items()],
            )

    return _once(spark, sf_dir, "messages", build, late)


def stored_topics(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Folders of the landed topics and of the messages."""
    session.prepare(spark)
    return _land_all(spark, sf_dir), _send_all(spark, sf_dir)


def _messages(spark: SparkSession, sf_dir: str, topic: str, late: bool = False) -> DataFrame:
    """A topic as a stream, one delivery per batch."""
    options = {"maxFilesPerTrigger": str(FILES)}
    return topic_stream(spark, topic, options, fmt="parquet", path=_send_all(spark, sf_dir, late))


def _split(spark: SparkSession, sf_dir: str) -> tuple[Activity, Activity]:
    """The first hour's events, and those of all the time after it."""
    start = sample.table(spark, sf_dir, "events").agg(F.min("ts")).first()[0]
    cut = F.lit(str(start + timedelta(hours=1))).cast("timestamp")
    activity = _activity(spark, sf_dir)
    before = Activity(*[t.where(F.col("ts") < cut) for t in activity])
    after = Activity(*[t.where(F.col("ts") >= cut) for t in activity])
    return before, after


# --- minute tables -----------------------------------------------------------


def _minute_table(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return minutes.TABLES[table](_topic(spark, sf_dir, minutes.INPUT_TOPIC[table]))


def _successful_logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minutes.user_login(_topic(spark, sf_dir, "auth_events"), only_success=True)


def _latest_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.latest_minutes(_minute_table("song_chart_minute", spark, sf_dir), LATEST)


def _latest_minutes_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving view between two times, as a dashboard asks for it: two days of
    which the later one is half over."""
    table = "song_chart_minute"
    root = session.work_dir(spark, "serving")
    sinks.save_batch(_minute_table(table, spark, sf_dir), root, table, 0)
    last = datetime.combine(_day_span(spark, sf_dir)[1], time(12))
    start = last - timedelta(days=2)
    view = sinks.latest_by_key(spark, root, table, start, last)
    return analytics.latest_minutes(view, LATEST, start, last)


# --- streams -----------------------------------------------------------------


def _decoded(topic: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.events(sample.as_json(_topic(spark, sf_dir, topic)), topic)


def _decoded_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with a field the wire schema doesn't know, decoded to VARIANT once."""
    topic = "listen_events"
    sent = _topic(spark, sf_dir, topic).withColumn("client", F.struct(F.length("song").alias("build")))
    opened = ingest.normalize(ingest.decode_open(sample.as_json(sent), topic), topic)
    build = ingest.field("client.build", "bigint").alias("build")
    return opened.select(*schemas.TOPIC_COLUMNS[topic], build)


def _stream_table(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run one metric as a stream into its keyed sink and read the sink."""
    root = session.work_dir(spark, "serving")
    messages = _messages(spark, sf_dir, minutes.INPUT_TOPIC[table])
    writer = sinks.keyed_stream(
        job.metric(table, messages), table, root, f"{root}/checkpoint", sinks.AVAILABLE_NOW
    )
    job.drain([writer.start()])
    return sinks.latest_by_key(spark, root, table)


def _late_rows(delay: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth listen comes two deliveries late, over several batches: dropped where
    its minute is over by then, counted where the delay still admits it."""
    table = "artist_chart_minute"
    root = session.work_dir(spark, "serving")
    messages = _messages(spark, sf_dir, minutes.INPUT_TOPIC[table], late=True)
    writer = sinks.keyed_stream(
        job.metric(table, messages, delay), table, root, f"{root}/checkpoint", sinks.AVAILABLE_NOW
    )
    job.drain([writer.start()])
    return sinks.latest_by_key(spark, root, table)


def _keyed_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write one batch twice under one id and once more under the next."""
    table = "artist_chart_minute"
    root = session.work_dir(spark, "serving")
    rows = _minute_table(table, spark, sf_dir)
    for batch_id in (0, 0, 1):
        sinks.save_batch(rows, root, table, batch_id)
    return sinks.latest_by_key(spark, root, table)


def _keyed_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One serving table under two checkpoints: what the first run counted up to the
    middle stays, and where both have a minute the second run's count, a hundred
    higher, stands. Closed days are merged in between and after."""
    table = "song_chart_minute"
    root = session.work_dir(spark, "serving")
    rows = _minute_table(table, spark, sf_dir)
    first, last = _day_span(spark, sf_dir)
    middle = F.lit(str(first + (last - first) / 2)).cast("timestamp")
    again = rows.where(F.col("ingest_ts") >= middle).withColumn("count", F.col("count") + 100)
    for batch_id, part in enumerate((rows, rows.where(F.col("ingest_ts") >= middle))):
        sinks.save_batch(part, root, table, batch_id, sinks.run_of(spark, f"{root}/one"))
    sinks.compact(spark, root, table, last)
    time_.sleep(0.01)  # a later run has a later number
    sinks.save_batch(again, root, table, 0, sinks.run_of(spark, f"{root}/two"))
    sinks.compact(spark, root, table, last)
    return sinks.latest_by_key(spark, root, table)


def _landed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = "page_view_events"
    root = session.work_dir(spark, "landed")
    events = ingest.events(_messages(spark, sf_dir, topic), topic)
    writer = sinks.land_stream(events, root, topic, f"{root}/checkpoint", sinks.AVAILABLE_NOW)
    job.drain([writer.start()])
    return landed.landed(spark, root, topic)


def _landed_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed topic from two checkpoints and one batch landing: the deliveries go to
    the first stream, all messages again to a second one under a new checkpoint, whose rows
    are marked, and all events once more as a batch that is repeated."""
    topic = "page_view_events"
    root = session.work_dir(spark, "landed")
    for mark in ("first", "second"):
        events = ingest.events(_messages(spark, sf_dir, topic), topic).withColumn("userAgent", F.lit(mark))
        for _ in range(2):
            writer = sinks.land_stream(events, root, topic, f"{root}/checkpoint-{mark}", sinks.AVAILABLE_NOW)
            job.drain([writer.start()])
    batch = _decoded(topic, spark, sf_dir).withColumn("userAgent", F.lit("batch"))
    for _ in range(2):
        land(batch, root, topic, name="backfill")
    landed.merge_days(spark, root, topic, _day_span(spark, sf_dir)[1])
    return landed.landed(spark, root, topic)


def _absent_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days around the last one: those that were not landed have no rows."""
    root, last = _land_all(spark, sf_dir), _day_span(spark, sf_dir)[1]
    days = [last + timedelta(days=d) for d in (0, 1, 400)]
    return union_all([landed.landed_day(spark, root, "auth_events", day) for day in days])


def _resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metric that ends after the first delivery and is started again on its checkpoint
    once the others are there: its state and its place in the topic go on."""
    table, topic = "song_chart_minute", "listen_events"
    root = session.work_dir(spark, "serving")
    base = _base(spark, sf_dir).withColumn("_delivery", _delivery(spark, sf_dir))
    for numbers in ((0,), range(1, DELIVERIES)):
        for i in numbers:
            part = sample.as_json(sample.as_topic(base.where(F.col("_delivery") == i), topic))
            part.repartition(FILES).write.mode("append").parquet(f"{root}/in/{topic}")
        messages = topic_stream(spark, topic, {"maxFilesPerTrigger": str(FILES)}, fmt="parquet", path=f"{root}/in")
        writer = sinks.keyed_stream(
            job.metric(table, messages), table, root, f"{root}/checkpoint", sinks.AVAILABLE_NOW
        )
        job.drain([writer.start()])
    return sinks.latest_by_key(spark, root, table)


def _by_topic_root(spark: SparkSession, sf_dir: str) -> str:
    """The job with one query per topic over messages of which every tenth comes late."""

    def build(root: str) -> None:
        queries = job.start_by_topic(
            lambda t: _messages(spark, sf_dir, t, late=True), f"{root}/serving", f"{root}/landed", f"{root}/checkpoint", sinks.AVAILABLE_NOW
        )
        job.drain(queries)

    return _once(spark, sf_dir, "topics", build)


def _by_topic_table(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.merged_counts(spark, f"{_by_topic_root(spark, sf_dir)}/serving", table)


def _by_topic_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{_by_topic_root(spark, sf_dir)}/landed"
    return _row_counts({t: landed.landed(spark, root, t) for t in schemas.STAR_TOPICS})


def _serving_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minutes of the artist with most plays, of three batches merged in levels."""
    table = "artist_chart_minute"
    root = session.work_dir(spark, "serving")
    rows = _minute_table(table, spark, sf_dir)
    for number in range(3):
        sinks.save_batch(rows.withColumn("count", F.col("count") + number), root, table, number)
    sinks.compact(spark, root, table, _day_span(spark, sf_dir)[1], fan_in=3)
    most = rows.groupBy("artist").agg(F.sum("count").alias("n")).orderBy(F.desc("n"), F.asc("artist")).first()
    return sinks.latest_by_key(spark, root, table, where=F.col("artist") == F.lit(most["artist"]))


def _stream_job_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run all nine queries to the end of the input; rows per written table."""
    root = session.work_dir(spark, "job")
    serving, land_root = f"{root}/serving", f"{root}/landed"
    queries = job.start_all(
        lambda topic: _messages(spark, sf_dir, topic),
        serving,
        land_root,
        f"{root}/checkpoint",
        sinks.AVAILABLE_NOW,
    )
    job.drain(queries)
    tables = {t: sinks.latest_by_key(spark, serving, t) for t in schemas.SERVING}
    tables |= {t: landed.landed(spark, land_root, t) for t in schemas.STAR_TOPICS}
    return _row_counts(tables)


# --- dimensions and facts ----------------------------------------------------


def _dim(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    if name == "dim_time":
        return dims.dim_time(spark)
    return getattr(dims, name)(_activity(spark, sf_dir))


def _fact(
    name: str, user_match: str, method: str, spark: SparkSession, sf_dir: str
) -> DataFrame:
    """A fact from its events; dimensions, where it needs any, are the stored ones."""
    events = dict(zip(schemas.FACTS, _activity(spark, sf_dir), strict=True))[name]
    star = None
    if method == "join" or user_match == "id":
        star = warehouse.read_star(spark, stored_warehouse(spark, sf_dir))
    return facts.fact(name, events, star, user_match=user_match, method=method)


def _validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of users over time; a user's level changes with the hour of the day."""
    return validity.user_validity(_levelled(spark, sf_dir))


def _levelled(spark: SparkSession, sf_dir: str) -> Activity:
    """Events whose users change their level every quarter of a day."""
    paid = F.when(F.hour("ts") % 12 < 6, "paid").otherwise("free")
    return Activity(*[t.withColumn("level", paid) for t in _activity(spark, sf_dir)])


def _listen_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listens with the version that logins and page views show for their time."""
    activity = _levelled(spark, sf_dir)
    versions = validity.user_validity(activity._replace(listen=activity.listen.limit(0)))
    listens = activity.listen.select("userId", "ts", "song")
    return validity.as_of(listens, versions, ["level", "gender", "valid_from"])


def _second_at_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logins per second of the day: the generated clock joined with the facts."""
    logins = _fact("fact_auth", "version", "key", spark, sf_dir)
    per_second = logins.groupBy("time_id").agg(F.count(F.lit(1)).alias("logins"))
    clock = dims.dim_time(spark)
    return clock.join(per_second, "time_id").select(*clock.columns, "logins")


def _guest_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = schemas.TOPIC_COLUMNS["page_view_events"]
    return default_guests(_topic(spark, sf_dir, "page_view_events")).select(*columns)


def _union_all_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    activity = _activity(spark, sf_dir)
    shared = [c for c in schemas.TOPIC_COLUMNS["auth_events"] if c != "success"]
    return union_all([activity.auth.select(*shared), activity.listen, activity.page_view])


def _new_members(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _split(spark, sf_dir)
    return dims.new_members(name, after, getattr(dims, name)(before))


def _new_facts(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """All facts minus those of the first hour, as a late second run would add."""
    before, _ = _split(spark, sf_dir)
    part = schemas.STAR_TOPICS.index(schemas.FACT_TOPIC[name])
    everything = facts.fact(name, _activity(spark, sf_dir)[part])
    return facts.new_facts(everything, facts.fact(name, before[part]))


def _silent_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXCEPT DISTINCT on rows with NULLs: people seen in page views only."""
    activity = _activity(spark, sf_dir)
    person = ["userId", "gender", "level"]
    return except_distinct(activity.page_view.select(person), activity.listen.select(person))


# --- landed and warehouse tables ---------------------------------------------


def _landed(mode: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _land_all(spark, sf_dir)
    return landed.extract(spark, root, "auth_events", mode, _day_span(spark, sf_dir)[1])


def _fact_by_date_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = stored_warehouse(spark, sf_dir)
    days = [day.strftime("%Y%m%d") for day in _day_span(spark, sf_dir)]
    return warehouse.read_fact(spark, root, "fact_listen", days)


def _loaded(incremental: bool, user_match: str, spark: SparkSession, sf_dir: str) -> str:
    """Full load of all days but the last; then, if asked, the last one twice."""

    def build(root: str) -> None:
        landed_root = _land_all(spark, sf_dir)
        _, last = _day_span(spark, sf_dir)
        loads.full_load(spark, landed_root, root, last, user_match)
        for _ in range(2 if incremental else 0):
            tomorrow = last + timedelta(days=1)
            loads.incremental_load(spark, landed_root, root, last, tomorrow, user_match)

    return _once(spark, sf_dir, "warehouse", build, incremental, user_match)


def stored_warehouse(spark: SparkSession, sf_dir: str) -> str:
    """A full load of all days, which the questions below are asked of."""

    def build(root: str) -> None:
        as_of = _day_span(spark, sf_dir)[1] + timedelta(days=1)
        loads.full_load(spark, _land_all(spark, sf_dir), root, as_of)

    return _once(spark, sf_dir, "warehouse", build, "all")


def _old_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table as a reader has them that began before a load and two merges."""
    root = session.work_dir(spark, "warehouse")
    landed_root, last = _land_all(spark, sf_dir), _day_span(spark, sf_dir)[1]
    loads.full_load(spark, landed_root, root, last)
    seen = warehouse.snapshot(spark, root)
    loads.incremental_load(spark, landed_root, root, last, last + timedelta(days=1))
    merge_folders(spark, root)
    tables = {n: warehouse.read_dim(spark, root, n, seen) for n in schemas.DIMENSIONS}
    tables |= {n: warehouse.read_fact(spark, root, n, None, seen) for n in schemas.FACTS}
    return _row_counts(tables)


def _filtered_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As the incremental load twice, with candidates met through the stored filters."""
    root = session.work_dir(spark, "warehouse")
    landed_root, last = _land_all(spark, sf_dir), _day_span(spark, sf_dir)[1]
    loads.full_load(spark, landed_root, root, last, with_filters=True)
    for _ in range(2):
        loads.incremental_load(spark, landed_root, root, last, last + timedelta(days=1), with_filters=True)
    tables = {n: warehouse.read_dim(spark, root, n) for n in schemas.DIMENSIONS}
    tables |= {n: warehouse.read_fact(spark, root, n) for n in schemas.FACTS}
    return _row_counts(tables)


def _rolled_up(spark: SparkSession, sf_dir: str) -> str:
    """All days but the last by a full load, the last two by incremental ones, with roll-ups."""

    def build(root: str) -> None:
        landed_root, last = _land_all(spark, sf_dir), _day_span(spark, sf_dir)[1]
        loads.full_load(spark, landed_root, root, last - timedelta(days=1), with_rollups=True)
        for day in (last - timedelta(days=1), last):
            loads.incremental_load(spark, landed_root, root, day, day + timedelta(days=1), with_rollups=True)

    return _once(spark, sf_dir, "warehouse", build, "rollups")


def _rollup(question: Callable[..., DataFrame], name: str, grain: str | None, options: dict, spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _rolled_up(spark, sf_dir)
    state = warehouse.snapshot(spark, root)
    rollup = warehouse.read_rollup(spark, root, name, state)
    return question(rollup, warehouse.read_star(spark, root, state), grain, **options)


def _row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table_name"), F.col("rows").alias("row_count")
            )
            for name, df in tables.items()
        ]
    )


def _load_counts(incremental: bool, spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _loaded(incremental, "id", spark, sf_dir)
    tables = {n: warehouse.read_dim(spark, root, n) for n in schemas.DIMENSIONS}
    tables |= {n: warehouse.read_fact(spark, root, n) for n in schemas.FACTS}
    return _row_counts(tables)


def _loaded_fact(name: str, user_match: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _loaded(True, user_match, spark, sf_dir)
    return warehouse.read_fact(spark, root, name)


def _catalog_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays per day and state asked in SQL of the registered tables."""
    root = stored_warehouse(spark, sf_dir)
    database = "eventmart_" + root.rsplit("-", 1)[-1]
    catalog.register(spark, root, database)
    return spark.sql(
        f"""
        SELECT d.year, d.month, d.day, l.state, count(*) AS plays
        FROM {database}.fact_listen f
        JOIN {database}.dim_date d ON f.date_id = d.date_id
        JOIN {database}.dim_location l ON f.location_id = l.location_id
        GROUP BY d.year, d.month, d.day, l.state
        """
    )


# --- analytical questions ----------------------------------------------------


def _star_and(name: str, spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dims.Star]:
    root = stored_warehouse(spark, sf_dir)
    return warehouse.read_fact(spark, root, name), warehouse.read_star(spark, root)


def _logged_in_users(grain: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.logged_in_users(*_star_and("fact_auth", spark, sf_dir), grain)


def _songs_played(grain: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.songs_played(*_star_and("fact_listen", spark, sf_dir), grain)


def _top(
    question: Callable[..., DataFrame], grain: str | None, spark: SparkSession, sf_dir: str
) -> DataFrame:
    return question(*_star_and("fact_listen", spark, sf_dir), grain, k=TOP)


def _user_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.user_distribution(_star_and("fact_auth", spark, sf_dir)[1].user)


def _avg_songs_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _ = _star_and("fact_listen", spark, sf_dir)
    return analytics.avg_songs_per_user(fact)


# --- text repair -------------------------------------------------------------


def _repair_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Garble every document the way the repair undoes, then repair it."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    escaped = F.replace(F.col("text"), F.lit("\\"), F.lit("\\\\"))
    garbled = F.decode(F.encode(escaped, "UTF-8"), "ISO-8859-1")
    return documents.select("doc_id", repair_text(garbled).alias("text"))


def _song_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text that needs no repair but quotes stripped stays as it is."""
    songs = _topic(spark, sf_dir, "listen_events")
    quoted = F.concat(F.lit('"'), "song", F.lit('"'))
    return songs.select(repair_text(quoted).alias("song"), repair_text("artist").alias("artist"))


def all_queries() -> dict[str, Query]:
    queries: dict[str, Query] = {t: partial(_minute_table, t) for t in minutes.TABLES}
    queries["user_login_success"] = _successful_logins
    queries["latest_minutes"] = _latest_minutes
    queries |= {n: partial(_dim, n) for n in schemas.DIMENSIONS if n != "dim_time"}
    queries["dim_time_logins"] = _second_at_work
    for name in schemas.FACTS:
        queries[name] = partial(_fact, name, "id", "key")
        queries[f"{name}_by_version"] = partial(_fact, name, "version", "key")
        queries[f"{name}_by_join"] = partial(_fact, name, "id", "join")
    queries["fact_listen_by_version_join"] = partial(_fact, "fact_listen", "version", "join")
    queries["user_validity"] = _validity
    queries["listen_as_of_user"] = _listen_as_of
    queries["page_view_guest_defaults"] = _guest_defaults
    queries["union_all_topics"] = _union_all_topics
    queries["page_view_only_users"] = _silent_users
    for name in ("dim_user", "dim_date", "dim_song", "dim_location"):
        queries[f"new_{name}"] = partial(_new_members, name)
    for name in schemas.FACTS:
        queries[f"new_{name}"] = partial(_new_facts, name)
    queries["landed_full"] = partial(_landed, "full")
    queries["landed_day"] = partial(_landed, "incremental")
    queries["fact_by_date_ids"] = _fact_by_date_ids
    queries["full_load_counts"] = partial(_load_counts, False)
    queries["incremental_load_counts"] = partial(_load_counts, True)
    queries["loaded_fact_listen"] = partial(_loaded_fact, "fact_listen", "id")
    queries["loaded_fact_page_view"] = partial(_loaded_fact, "fact_page_view", "version")
    queries["catalog_sql"] = _catalog_sql
    for topic in schemas.TOPIC_COLUMNS:
        queries[f"decode_{topic}"] = partial(_decoded, topic)
    queries["decode_open_listen_events"] = _decoded_open
    for table in minutes.TABLES:
        queries[f"stream_{table}"] = partial(_stream_table, table)
    queries["stream_late_rows_dropped"] = partial(_late_rows, minutes.NO_DELAY)
    queries["stream_late_rows_admitted"] = partial(_late_rows, LATE_DELAY)
    queries["latest_minutes_range"] = _latest_minutes_range
    queries["keyed_sink_latest"] = _keyed_replay
    queries["keyed_sink_restart"] = _keyed_restart
    queries["landed_stream"] = _landed_stream
    queries["stream_job_counts"] = _stream_job_counts
    queries["landed_stream_restart"] = _landed_restart
    queries["landed_absent_day"] = _absent_day
    queries["stream_resumed"] = _resumed
    queries["serving_by_key"] = _serving_by_key
    for table in minutes.TABLES:
        if table != "user_login":
            queries[f"by_topic_{table}"] = partial(_by_topic_table, table)
    queries["by_topic_landed_counts"] = _by_topic_landed
    queries["load_seen_by_old_reader"] = _old_reader
    queries["filtered_load_counts"] = _filtered_load_counts
    for grain in rollups.COARSE:
        queries[f"rollup_logged_in_users_{grain}"] = partial(_rollup, rollups.logged_in_users, "rollup_logins", grain, {})
        queries[f"rollup_songs_played_{grain}"] = partial(_rollup, rollups.songs_played, "rollup_songs", grain, {})
    for grain in ("year", "month", "day"):
        queries[f"rollup_top_songs_{grain}"] = partial(_rollup, rollups.top_songs, "rollup_songs", grain, {"k": TOP})
        queries[f"rollup_top_artists_{grain}"] = partial(_rollup, rollups.top_artists, "rollup_songs", grain, {"k": TOP})
    queries["rollup_top_locations"] = partial(_rollup, rollups.top_locations, "rollup_places", None, {"k": TOP})
    for grain in analytics.GRAINS:
        queries[f"logged_in_users_{grain}"] = partial(_logged_in_users, grain)
        queries[f"songs_played_{grain}"] = partial(_songs_played, grain)
        queries[f"top_songs_{grain}"] = partial(_top, analytics.top_songs, grain)
        queries[f"top_artists_{grain}"] = partial(_top, analytics.top_artists, grain)
        queries[f"top_locations_{grain}"] = partial(_top, analytics.top_locations, grain)
    queries["top_locations"] = partial(_top, analytics.top_locations, None)
    queries["user_distribution"] = _user_distribution
    queries["avg_songs_per_user"] = _avg_songs_per_user
    queries["repair_text"] = _repair_text
    queries["repair_song_text"] = _song_text
    return {name: _checked(query) for name, query in queries.items()}


def _checked(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return without_zone(query(session.prepare(spark), sf_dir))

    return run
