from __future__ import annotations

import json
import os
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventmart import schemas, session
from eventmart.operators import minutes
from eventmart.plans.tables import land
from eventmart.registry.queries import _messages
from eventmart.sources import commits, landed, sample
from eventmart.sources.topics import kafka_options, topic_stream
from eventmart.streaming import ingest, job, sinks

BASE_MS = int(datetime(2024, 1, 1, 10, 0, tzinfo=timezone.utc).timestamp() * 1000)


class Topic:
    """A folder of JSON-lines files, one micro-batch each, in order."""

    def __init__(self, folder, topic="listen_events"):
        self.folder = folder / topic
        self.folder.mkdir(parents=True)
        self.root, self.topic, self.files = str(folder), topic, 0

    def add(self, *lines):
        path = self.folder / f"{self.files:03d}.json"
        path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
        stamp = 1_700_000_000 + self.files
        os.utime(path, (stamp, stamp))
        self.files += 1

    def stream(self, spark):
        options = {"maxFilesPerTrigger": "1"}
        return topic_stream(spark, self.topic, options, fmt="text", path=self.root)


def play(second, song):
    return {"ts": BASE_MS + second * 1000, "song": song}


def run_chart(spark, topic, root):
    rows_ = job.metric("song_chart_minute", topic.stream(spark))
    writer = sinks.keyed_stream(
        rows_, "song_chart_minute", root, f"{root}/checkpoint", sinks.AVAILABLE_NOW
    )
    query = writer.start()
    query.awaitTermination()
    return query


def chart(spark, root):
    table = sinks.latest_by_key(spark, root, "song_chart_minute")
    return rows(table.select("song", "minute", "count"))


def observed(query, name, field):
    return sum(
        progress.observedMetrics[name][field]
        for progress in query.recentProgress
        if name in progress.observedMetrics
    )


def test_decode_literals(spark):
    messages = spark.createDataFrame(
        [("{bad",), ('{"ts":"x","song":"q"}',), ('{"ts":1,"song":3}',), ('{"song":"n"}',)],
        "value string",
    )
    got = ingest.decode(messages, "listen_events", ["ts", "song"])
    assert rows(got) == sorted([(None, None), (None, "q"), (1, "3"), (None, "n")], key=repr)
    kept = rows(ingest.rejected(messages))
    assert kept == sorted([("{bad",), ('{"ts":"x","song":"q"}',), ('{"song":"n"}',)], key=repr)


def test_decode_reads_bytes_and_all_topics(spark):
    for topic in schemas.TOPIC_COLUMNS:
        messages = spark.createDataFrame([(bytearray(b'{"ts":1500,"userId":4}'),)], "value binary")
        event = ingest.events(messages, topic)
        assert event.columns == schemas.TOPIC_COLUMNS[topic]
        assert event.select(F.unix_millis("ts"), "userId").first()[:] == (1500, 4)


def test_open_decode_keeps_unknown_fields(spark):
    texts = ['{"ts": 1704103200000, "song": "x", "client": {"build": 7}}', '{"ts": "soon", "userId": 3}', "{bad", "[]", ""]
    found = ingest.decode_open(spark.createDataFrame([(t,) for t in texts], "value string"), "listen_events")
    got = found.select("ts", "song", "userId", ingest.field("client.build", "int"), ingest.field("client.build", "boolean"))
    assert [tuple(r) for r in got.collect()] == [
        (1704103200000, "x", None, 7, True), (None, None, 3, None, None), *[(None,) * 5] * 3
    ]


def test_text_is_repaired_before_it_is_grouped(spark):
    messages = spark.createDataFrame(
        [(json.dumps(play(1, "BeyoncÃ©")),), (json.dumps(play(2, '"Beyoncé"')),)], "value string"
    )
    got = job.metric("song_chart_minute", messages)
    assert rows(got.select("song", "count")) == [("Beyoncé", 2)]


def test_late_rows_are_dropped_and_minutes_close_once(spark, tmp_path):
    """Each run takes up the checkpoint of the one before."""
    topic, root = Topic(tmp_path / "in"), str(tmp_path / "out")
    topic.add(play(1, "x"), play(59, "x"), play(30, None))
    run_chart(spark, topic, root)
    assert chart(spark, root) == []  # minute 0 is open

    topic.add(play(61, "x"))
    query = run_chart(spark, topic, root)
    first = [("x", 0, 2), (None, 0, 1)]  # NULL is a key like any other
    assert chart(spark, root) == first
    assert observed(query, "keyed_song_chart_minute", "rows") == 2

    topic.add(play(5, "late"), play(119, "x"))
    query = run_chart(spark, topic, root)
    assert chart(spark, root) == first  # 119 s does not end minute 1
    dropped = sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )
    assert dropped == 1

    topic.add(play(120, "y"))  # the watermark reaches the end of minute 1
    run_chart(spark, topic, root)
    assert chart(spark, root) == [("x", 0, 2), ("x", 1, 2), (None, 0, 1)]


def test_delay_admits_late_rows(spark, tmp_path):
    topic, checkpoint = Topic(tmp_path / "in"), str(tmp_path / "checkpoint")
    got = []
    for plays in ([play(61, "x")], [play(5, "late"), play(119, "x")], [play(600, "y")]):
        topic.add(*plays)
        counts = job.metric("song_chart_minute", topic.stream(spark), delay="5 minutes")
        writer = counts.writeStream.trigger(availableNow=True).option(
            "checkpointLocation", checkpoint
        )
        sink = writer.foreachBatch(lambda batch, _: got.extend(rows(batch.select("song", "count"))))
        sink.start().awaitTermination()
    assert sorted(got) == [("late", 1), ("x", 2)]


def test_replaying_a_batch_changes_nothing_and_later_batches_win(spark, make_topic):
    root = session.work_dir(spark, "replay")
    one = minutes.listen_count_minute(make_topic("listen_events", [dict()]))
    two = one.withColumn("count", F.lit(5).cast("bigint"))
    sinks.save_batch(one, root, "listen_count_minute", 0)
    before = rows(sinks.latest_by_key(spark, root, "listen_count_minute"))
    sinks.save_batch(one, root, "listen_count_minute", 0)
    assert rows(sinks.latest_by_key(spark, root, "listen_count_minute")) == before
    sinks.save_batch(two, root, "listen_count_minute", 10)
    sinks.save_batch(one, root, "listen_count_minute", 9)
    table = sinks.latest_by_key(spark, root, "listen_count_minute")
    assert [r["count"] for r in table.collect()] == [5]


def test_a_new_checkpoint_is_a_later_run_and_loses_nothing(spark, tmp_path):
    root = str(tmp_path / "out")
    for name, second, song in (("one", 1, "x"), ("two", 601, "y")):
        topic = Topic(tmp_path / name)
        topic.add(play(second, song), play(second + 1, None), play(second + 120, song))
        rows_ = job.metric("song_chart_minute", topic.stream(spark))
        checkpoint = f"{tmp_path}/checkpoint-{name}"
        sinks.keyed_stream(
            rows_, "song_chart_minute", root, checkpoint, sinks.AVAILABLE_NOW
        ).start().awaitTermination()
        assert sinks.run_of(spark, checkpoint) == sinks.run_of(spark, checkpoint)
    assert chart(spark, root) == [("x", 0, 1), ("y", 10, 1), (None, 0, 1), (None, 10, 1)]
    assert sinks.run_of(spark, f"{tmp_path}/checkpoint-one") < sinks.run_of(spark, f"{tmp_path}/checkpoint-two")


def test_compaction_leaves_the_view_as_it_is(spark, sf_dir):
    root, table = session.work_dir(spark, "serving"), "song_chart_minute"
    rows_ = minutes.song_chart_minute(sample.topic(spark, sf_dir, "listen_events"))
    sinks.save_batch(rows_, root, table, 0)
    sinks.save_batch(rows_.withColumn("count", F.col("count") + 1), root, table, 1)
    sinks.save_batch(rows_.where("song is null"), root, table, 0, run=5)
    before = rows(sinks.latest_by_key(spark, root, table))
    days = sinks.compact(spark, root, table, date(2024, 1, 20))
    assert len(days) == 19 and max(days) == date(2024, 1, 19)
    assert rows(sinks.latest_by_key(spark, root, table)) == before
    found = sinks._runs(spark, root, table).where("event_day < '2024-01-20'")
    assert found.selectExpr("count(*) = count(distinct ingest_ts, coalesce(song, ''))").first()[0]
    assert sinks.compact(spark, root, table, date(2024, 1, 20)) == []


def test_readers_outlive_a_compaction_and_levels_merge(spark, sf_dir):
    root, table = session.work_dir(spark, "serving"), "song_chart_minute"
    rows_ = minutes.song_chart_minute(sample.topic(spark, sf_dir, "listen_events"))
    for number in range(3):
        sinks.save_batch(rows_.withColumn("count", F.col("count") + number), root, table, number)
    reader = sinks.latest_by_key(spark, root, table)  # planned on what is published now
    before = rows(reader)
    assert len(sinks.compact(spark, root, table, date(2024, 1, 20), fan_in=3)) == 19
    levels = {about["level"] for about in commits.state(spark, f"{root}/{table}").folders.values()}
    assert levels == {0, 1}
    assert rows(reader) == before == rows(sinks.latest_by_key(spark, root, table))
    assert sinks.vacuum(spark, root, table) == [] and rows(reader) == before
    assert len(sinks.vacuum(spark, root, table, keep_seconds=0)) == 57
    assert rows(sinks.latest_by_key(spark, root, table)) == before


def test_a_read_by_key_reaches_the_files(spark, sf_dir):
    root, table = session.work_dir(spark, "serving"), "artist_chart_minute"
    rows_ = minutes.artist_chart_minute(sample.topic(spark, sf_dir, "listen_events"))
    sinks.save_batch(rows_, root, table, 0)
    artist = rows_.first()["artist"]
    found = sinks.latest_by_key(spark, root, table, where=F.col("artist") == artist)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(artist,{artist})" in plan
    assert rows(found) == rows(sinks.latest_by_key(spark, root, table).where(F.col("artist") == artist))


def test_landing_survives_new_checkpoints_and_batch_landings(spark, tmp_path):
    """Two checkpoints and one batch on one root give all rows; replays and attempts
    that were not published change nothing."""
    root = str(tmp_path / "landed")
    for name in ("one", "two"):
        topic = Topic(tmp_path / name)
        topic.add(play(1, name), play(50_400, name), "{bad")
        events = ingest.events(topic.stream(spark), "listen_events")
        for _ in range(2):
            sinks.land_stream(
                events, root, "listen_events", f"{tmp_path}/c-{name}", sinks.AVAILABLE_NOW
            ).start().awaitTermination()
    batch = landed.landed(spark, root, "listen_events").where("song = 'one'").drop("date")
    batch = spark.createDataFrame(batch.collect(), batch.schema)
    for _ in range(2):
        land(batch.withColumn("song", F.lit("batch")), root, "listen_events", name="late-file")
    commits.write(batch.withColumn("date", F.to_date("ts")), f"{root}/listen_events", "run=died/batch=0", ["date"])
    got = landed.landed(spark, root, "listen_events")
    want = [("batch", 2), ("one", 2), ("two", 2), (None, 2)]
    assert rows(got.groupBy("song").count()) == sorted(want, key=repr)
    reader = landed.landed(spark, root, "listen_events")
    assert landed.merge_days(spark, root, "listen_events", date(2024, 1, 2)) == ["2024-01-01"]
    assert rows(reader) == rows(landed.landed(spark, root, "listen_events")) == rows(got)
    sinks_run = next(r for r in commits.state(spark, f"{root}/listen_events").done if r.startswith("stream-"))
    landed.land_rows(batch, root, "listen_events", sinks_run, 0)
    assert landed.landed(spark, root, "listen_events").count() == 8


def test_commits_of_two_writers_both_count(spark, tmp_path):
    """A writer that finds its number taken commits on top; snapshots keep the state."""
    root = str(tmp_path / "table")
    for i in range(commits.SNAPSHOT + 3):
        seen = []

        def change(now, i=i, seen=seen):
            if not seen and i == 5:  # another writer comes first
                seen.append(1)
                commits.commit(spark, root, lambda _: {"add": {"other": {}}})
            return {"add": {f"f{i}": {}}, "remove": ["f0"] if i == 3 else []}

        commits.commit(spark, root, change, ("w", i))
    now = commits.state(spark, root)
    assert set(now.folders) == {"other", *(f"f{i}" for i in range(1, commits.SNAPSHOT + 3))}
    assert now.done == {"w": commits.SNAPSHOT + 2} and set(now.gone) == {"f0"}
    assert commits.commit(spark, root, lambda _: {"add": {"again": {}}}, ("w", 7)).folders == now.folders


def test_one_query_per_topic_counts_late_rows(spark, sf_dir, tmp_path):
    """Counts of the batches, late rows included, equal a batch job's over everything."""
    root = session.work_dir(spark, "job")
    started = job.start_by_topic(
        lambda t: _messages(spark, sf_dir, t, late=True), f"{root}/s", f"{root}/l", f"{root}/c", sinks.AVAILABLE_NOW
    )
    assert len(started) == 3
    job.drain(started)
    for table in minutes.TABLES:
        events = sample.topic(spark, sf_dir, minutes.INPUT_TOPIC[table])
        read = sinks.latest_by_key if table == "user_login" else sinks.merged_counts
        got = read(spark, f"{root}/s", table)
        want = minutes.TABLES[table](events).select(*got.columns)
        if table == "user_login":
            want = want.withColumn("ts", F.date_trunc("millisecond", "ts")).dropDuplicates(schemas.serving_key(table))
            assert rows(got.select(*schemas.serving_key(table))) == rows(want.select(*schemas.serving_key(table)))
            continue
        assert rows(got) == rows(want), table
        assert sinks.compact(spark, f"{root}/s", table, date(2024, 2, 20), adds=True)
        assert rows(read(spark, f"{root}/s", table)) == rows(want), table
    for topic in schemas.STAR_TOPICS:
        assert landed.landed(spark, f"{root}/l", topic).count() == sample.topic(spark, sf_dir, topic).count()


def test_await_any_raises_what_a_query_failed_of(spark, tmp_path):
    topic = Topic(tmp_path / "in")
    topic.add(play(1, "x"))

    def fail(*_):
        raise RuntimeError("no sink")

    failing = topic.stream(spark).writeStream.foreachBatch(fail).option(
        "checkpointLocation", f"{tmp_path}/c"
    )
    spark.streams.resetTerminated()
    failing.start()
    with pytest.raises(Exception, match="no sink"):
        job.await_any(spark)
    spark.streams.resetTerminated()


def test_serving_table_without_data_is_empty(spark, tmp_path):
    table = sinks.latest_by_key(spark, str(tmp_path), "user_login")
    assert table.count() == 0 and table.columns == schemas.SERVING["user_login"].names


def test_landing_keeps_all_rows_and_counts_those_without_time(spark, tmp_path):
    topic, root = Topic(tmp_path / "in"), str(tmp_path / "landed")
    topic.add(play(1, "a"), "{bad", play(50_400, "b"))
    events = ingest.events(topic.stream(spark), "listen_events")
    query = sinks.land_stream(
        events, root, "listen_events", f"{root}/checkpoint", sinks.AVAILABLE_NOW
    ).start()
    query.awaitTermination()
    got = landed.landed(spark, root, "listen_events").selectExpr("song", "cast(date as string)")
    assert rows(got) == sorted([("a", "2024-01-01"), ("b", "2024-01-02"), (None, None)], key=repr)
    assert observed(query, "landed_listen_events", "no_time") == 1


def test_job_fills_nine_tables_and_rejects(spark, sf_dir):
    root = session.work_dir(spark, "job")
    queries = job.start_all(
        lambda topic: _messages(spark, sf_dir, topic), f"{root}/s", f"{root}/l", f"{root}/c", sinks.AVAILABLE_NOW, with_rejects=True
    )
    assert len(queries) == 12
    job.drain(queries)
    for table in schemas.SERVING:
        assert sinks.latest_by_key(spark, f"{root}/s", table).count() > 0, table
    for topic in schemas.STAR_TOPICS:
        want = sample.topic(spark, sf_dir, topic).count()
        assert landed.landed(spark, f"{root}/l", topic).count() == want


@pytest.mark.parametrize("table", [t for t in minutes.TABLES if t != "user_login"])
def test_stream_equals_batch_up_to_the_watermark(spark, sf_dir, table):
    topic = minutes.INPUT_TOPIC[table]
    stream = _messages(spark, sf_dir, topic)
    name = f"mem_{table}"
    writer = sinks.debug_stream(job.metric(table, stream), sinks.AVAILABLE_NOW, "memory", name)
    writer.start().awaitTermination()
    batch = minutes.TABLES[table](sample.topic(spark, sf_dir, topic))
    events = sample.topic(spark, sf_dir, topic)
    if table == "gender_distribution_minute":
        events = events.dropna(subset=["gender", "level"])
    last = events.agg(F.max("ts").alias("last"))
    closed = batch.crossJoin(F.broadcast(last)).where("ingest_ts + interval 1 minute <= last")
    assert rows(spark.table(name)) == rows(closed.drop("last"))


def test_kafka_reader_options():
    with pytest.raises(ValueError, match="bootstrap"):
        kafka_options("listen_events", {})
    options = kafka_options(
        "listen_events", {"kafka.bootstrap.servers": "b:1", "maxOffsetsPerTrigger": "9"}
    )
    assert options == {
        "kafka.bootstrap.servers": "b:1",
        "maxOffsetsPerTrigger": "9",
        "subscribe": "listen_events",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }


def test_file_topics_need_a_known_format_and_a_path(spark):
    with pytest.raises(ValueError, match="format"):
        topic_stream(spark, "listen_events", fmt="csv", path="/x")
    with pytest.raises(ValueError, match="path"):
        topic_stream(spark, "listen_events", fmt="text")
