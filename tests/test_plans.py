"""What the physical plans must and must not contain."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventmart import schemas, session
from eventmart.operators import analytics, dims, facts, lookup, minutes
from eventmart.operators.conform import Activity, conform
from eventmart.plans import loads
from eventmart.plans.tables import land
from eventmart.sources import landed, sample, warehouse
from eventmart.streaming import ingest, job, sinks

AS_OF = date(2024, 1, 31)


def plan(df):
    """The plan before adaptive execution changes it, filter lists in full."""
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "5000")
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning") + plan(df).count("Exchange rangepartitioning")


@pytest.fixture(scope="module")
def roots(spark, sf_dir):
    session.prepare(spark)
    landed_root = session.work_dir(spark, "landed")
    for topic in schemas.STAR_TOPICS:
        land(sample.topic(spark, sf_dir, topic), landed_root, topic)
    warehouse_root = session.work_dir(spark, "warehouse")
    loads.full_load(spark, landed_root, warehouse_root, AS_OF, "version")
    return landed_root, warehouse_root


@pytest.fixture(scope="module")
def events(spark, roots):
    return Activity(
        *conform(*[landed.landed_before(spark, roots[0], t, AS_OF) for t in schemas.STAR_TOPICS])
    )


@pytest.fixture(scope="module")
def stored(spark, roots):
    return warehouse.read_star(spark, roots[1])


def scan_of(df):
    return next(line for line in plan(df).splitlines() if "FileScan" in line)


def test_landed_filters_prune_partitions(spark, roots):
    for df in (
        landed.landed_day(spark, roots[0], "auth_events", date(2024, 1, 3)),
        landed.landed_before(spark, roots[0], "auth_events", AS_OF),
        warehouse.read_fact(spark, roots[1], "fact_auth", ["20240103"]),
    ):
        assert "PartitionFilters: [isnotnull(date" in scan_of(df)


def test_one_day_reads_one_partition(spark, roots):
    df = landed.landed_day(spark, roots[0], "auth_events", date(2024, 1, 3))
    executed = df._jdf.queryExecution().executedPlan()
    executed.executeCollect()
    scan = executed.collectLeaves().head()
    assert scan.metrics().get("numPartitions").get().value() == 1


def test_dimensions_read_only_their_columns(events):
    scan = scan_of(dims.dim_location(events))
    assert "ReadSchema: struct<city:string,zip:string,state:string,lon:double,lat:double>" in scan
    assert "ReadSchema: struct<ts:timestamp>" in scan_of(dims.dim_date(events))


def test_dimension_is_one_shuffle(events):
    for build in (dims.dim_date, dims.dim_song, dims.dim_user, dims.dim_location):
        assert shuffles(build(events)) == 1
        assert "Join" not in plan(build(events))


def test_keyed_facts_do_not_move_rows(events):
    for name, topic in zip(schemas.FACTS, events, strict=True):
        text = plan(facts.fact(name, topic))
        assert "Exchange" not in text and "Join" not in text and "Python" not in text


def test_user_fan_out_is_broadcast_when_counted_small_and_salted_otherwise(
    events, stored, monkeypatch
):
    small = plan(facts.fact_listen(events.listen, stored, user_match="id"))
    assert "BroadcastHashJoin" in small
    monkeypatch.setitem(lookup.lookup.__kwdefaults__, "broadcast_bytes", 0)
    spark = events.listen.sparkSession
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = plan(facts.fact_listen(events.listen, stored, user_match="id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin [userId" in large and "_salt" in large and "_piece" in large


def test_joined_facts_broadcast_time_and_date(events, stored):
    text = plan(facts.fact_auth(events.auth, stored, method="join"))
    assert text.count("BroadcastHashJoin") == 4


def test_new_facts_are_one_shuffle(events, spark, roots):
    built = facts.fact_auth(events.auth)
    added = facts.new_facts(built, warehouse.read_fact(spark, roots[1], "fact_auth", ["20240103"]))
    assert shuffles(added) == 1 and "Join" not in plan(added)


def test_minute_counts_combine_before_their_only_shuffle(spark, roots):
    source = landed.landed(spark, roots[0], "listen_events")
    for build in (minutes.listen_count_minute, minutes.song_chart_minute):
        df = build(source)
        assert shuffles(df) == 1 and "partial_count" in plan(df)
    assert "ReadSchema: struct<song:string,ts:timestamp>" in scan_of(minutes.song_chart_minute(source))


def test_questions_read_only_what_they_ask(spark, roots, stored):
    fact = warehouse.read_fact(spark, roots[1], "fact_listen")
    df = analytics.top_songs(fact, stored, "day")
    scans = [line for line in plan(df).splitlines() if "FileScan" in line]
    assert "ReadSchema: struct<song_id:string>" in scans[0]
    assert not any("dim_time" in line for line in scans)
    assert "BroadcastNestedLoopJoin" not in plan(df) and "Cartesian" not in plan(df)


def test_decode_parses_only_the_fields_a_metric_needs(spark):
    messages = spark.range(1).select(F.lit("{}").alias("value"))
    text = job.metric("listen_count_minute", messages)._jdf.queryExecution().analyzed().toString()
    assert "StructField(ts,LongType,true)" in text and "StructField(artist" not in text


def test_serving_reads_push_the_time_range_to_the_files(spark, roots):
    root = session.work_dir(spark, "serving")
    source = landed.landed(spark, roots[0], "listen_events")
    sinks.save_batch(minutes.song_chart_minute(source), root, "song_chart_minute", 0)
    table = sinks.latest_by_key(spark, root, "song_chart_minute")
    recent = table.where("ingest_ts >= timestamp'2024-01-20' and song = 'x'")
    assert "GreaterThanOrEqual(ingest_ts" in plan(recent) and "EqualTo(song,x)" in plan(recent)


def test_serving_reads_between_two_times_leave_out_other_days(spark, roots):
    root = session.work_dir(spark, "serving")
    source = landed.landed(spark, roots[0], "listen_events")
    sinks.save_batch(minutes.song_chart_minute(source), root, "song_chart_minute", 0)
    some = sinks.latest_by_key(
        spark, root, "song_chart_minute", datetime(2024, 1, 3), datetime(2024, 1, 4, 12)
    )
    text = plan(some)
    assert "PartitionFilters: [isnotnull(event_day" in text and "event_day" in text
    assert rows(some.selectExpr("cast(ingest_ts as date)").distinct()) == [
        (date(2024, 1, 3),), (date(2024, 1, 4),)
    ]


def test_new_members_move_no_stored_rows(events, spark, roots):
    stored = warehouse.read_dim(spark, roots[1], "dim_user")
    added = dims.new_members("dim_user", events, stored)
    text = plan(added)
    # The stored side is scanned and probed; only the day's candidates are grouped.
    assert "LeftSemi, BuildRight" in text and "LeftAnti, BuildRight" in text
    assert "SortMergeJoin" not in text


def test_nothing_runs_in_python_workers(spark):
    messages = spark.range(1).select(F.lit("{}").alias("value"))
    for topic in schemas.TOPIC_COLUMNS:
        assert "Python" not in plan(ingest.events(messages, topic))
