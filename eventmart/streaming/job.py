"""The streaming job: three topics into six serving tables and three landed tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from eventmart import schemas
from eventmart.operators import minutes
from eventmart.plans.tables import run_together
from eventmart.sources import commits
from eventmart.sources.landed import land_rows
from eventmart.streaming import ingest, sinks


def metric(table: str, messages: DataFrame, delay: str = minutes.NO_DELAY) -> DataFrame:
    """Rows of one serving table, straight from its topic's messages."""
    topic = minutes.INPUT_TOPIC[table]
    events = ingest.events(messages, topic, minutes.INPUT_COLUMNS[table])
    build = minutes.TABLES[table]
    return build(events) if table == "user_login" else build(events, delay)


def start_all(
    topics: Callable[[str], DataFrame],
    serving_root: str,
    landed_root: str,
    checkpoint_root: str,
    trigger: Mapping[str, object] = sinks.EVERY_MINUTE,
    delay: str = minutes.NO_DELAY,
    with_rejects: bool = False,
) -> list[StreamingQuery]:
    """Start the nine queries, each with its own checkpoint.

    ``topics`` gives the message stream of a topic. ``with_rejects`` starts
    three more that keep the text of unusable messages.
    """
    checkpoint = lambda name: f"{checkpoint_root.rstrip('/')}/{name}"
    messages = {topic: topics(topic) for topic in schemas.STAR_TOPICS}
    writers = [
        sinks.keyed_stream(
            metric(table, messages[minutes.INPUT_TOPIC[table]], delay),
            table,
            serving_root,
            checkpoint(table),
            trigger,
        )
        for table in minutes.TABLES
    ]
    writers += [
        sinks.land_stream(
            ingest.events(messages[topic], topic), landed_root, topic, checkpoint(topic), trigger
        )
        for topic in schemas.STAR_TOPICS
    ]
    if with_rejects:
        writers += [
            sinks.reject_stream(
                ingest.rejected(messages[topic]),
                landed_root,
                topic,
                checkpoint(f"rejects_{topic}"),
                trigger,
            )
            for topic in schemas.STAR_TOPICS
        ]
    return [writer.start() for writer in writers]


def topic_query(
    messages: DataFrame,
    topic: str,
    serving_root: str,
    landed_root: str,
    checkpoint: str,
    trigger: Mapping[str, object] = sinks.EVERY_MINUTE,
) -> DataStreamWriter:
    """One query for all that is made of a topic: each micro-batch is read and decoded
    once, landed, and counted into every table of the topic.

    A batch publishes only its own counts, which the sink adds up by key and minute.
    So there is no state to keep and no watermark to wait for: a row that comes late
    corrects the minute it belongs to, and a replayed batch changes nothing.
    """
    spark = messages.sparkSession
    run = sinks.run_of(spark, checkpoint)
    tables = [t for t in minutes.TABLES if minutes.INPUT_TOPIC[t] == topic]

    def each(batch: DataFrame, number: int) -> None:
        events = ingest.events(batch, topic).persist()
        try:
            step = commits.step_for(events, "ts")  # no table has days the events have not
            writes = [partial(land_rows, events, landed_root, topic, f"stream-{run}", number, step=step)]
            for table in tables:
                save = sinks.save_batch if table == "user_login" else sinks.save_counts
                writes.append(partial(save, minutes.TABLES[table](events), serving_root, table, number, run, step))
            run_together(batch.sparkSession, writes)
        finally:
            events.unpersist()

    return messages.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**trigger)


def start_by_topic(
    topics: Callable[[str], DataFrame],
    serving_root: str,
    landed_root: str,
    checkpoint_root: str,
    trigger: Mapping[str, object] = sinks.EVERY_MINUTE,
) -> list[StreamingQuery]:
    """Start one query per topic; see ``topic_query``. The tables of counts are read with
    ``sinks.merged_counts``, the login feed with ``sinks.latest_by_key``."""
    root = checkpoint_root.rstrip("/")
    return [
        topic_query(topics(t), t, serving_root, landed_root, f"{root}/topic-{t}", trigger).start()
        for t in schemas.STAR_TOPICS
    ]


def await_any(spark: SparkSession) -> None:
    """Block until one query ends; its failure is raised here."""
    spark.streams.awaitAnyTermination()


def drain(queries: list[StreamingQuery]) -> None:
    """Wait for queries that stop by themselves (``availableNow``)."""
    for query in queries:
        query.awaitTermination()
