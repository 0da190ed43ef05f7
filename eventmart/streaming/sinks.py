"""Sinks: landed parquet, keyed serving tables, debug output.

Every function returns a writer that is not started yet. Checkpoints belong on
storage that outlives the driver.
"""

from __future__ import annotations

import time
from collections.abc import Mapping
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from eventmart import schemas
from eventmart.sources import commits
from eventmart.sources.files import number_in
from eventmart.sources.landed import land_rows, topic_path

EVERY_MINUTE = {"processingTime": "1 minute"}
AVAILABLE_NOW = {"availableNow": True}


def land_stream(
    events: DataFrame,
    root: str,
    topic: str,
    checkpoint: str,
    trigger: Mapping[str, object] = EVERY_MINUTE,
) -> DataStreamWriter:
    """Append normalised events to ``root/topic``, partitioned by UTC day.

    Every micro-batch is one commit under the run its checkpoint stands for: a replay
    changes nothing, a new checkpoint is a run of its own beside the others, and batch
    landings may share the root. Events without a time land in the NULL partition,
    which no day filter selects, and are counted as ``no_time`` in the query's
    observed metrics.
    """
    observed = events.observe(
        f"landed_{topic}",
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("ts").isNull()).alias("no_time"),
    )
    run = f"stream-{run_of(events.sparkSession, checkpoint)}"

    def land(batch: DataFrame, number: int) -> None:
        batch.persist()  # its days are counted and its rows written, its metrics are of one pass
        try:
            land_rows(batch, root, topic, run, number)
        finally:
            batch.unpersist()

    return (
        observed.writeStream.foreachBatch(land)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )


def reject_stream(
    rejected: DataFrame,
    root: str,
    topic: str,
    checkpoint: str,
    trigger: Mapping[str, object] = EVERY_MINUTE,
) -> DataStreamWriter:
    """Keep the raw text of unusable messages under ``root/rejects/topic``."""
    return (
        rejected.writeStream.format("parquet")
        .outputMode("append")
        .option("path", topic_path(f"{root.rstrip('/')}/rejects", topic))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )


# What wrote a row of a serving table; the greatest pair stands for its key.
WRITER = T.StructType([T.StructField("run", T.LongType()), T.StructField("batch_id", T.LongType())])


def _store(rows: DataFrame, root: str, table: str, folder: str, step: int) -> dict[str, dict]:
    """Write rows with their ``run`` and ``batch_id`` as a sorted run per event day, or per
    span of ``step`` days.

    Rows are brought together by day and sorted by key, newest first; minima, maxima
    and Bloom filters of the keys in the files let a read by key open few of them. The
    filters are as large as the keys of their file ask for.
    """
    partition, clustering = schemas.SERVING_KEYS[table]
    placed = rows.withColumn("event_day", commits.first_day(clustering, step)).hint("rebalance", "event_day")
    placed = placed.sortWithinPartitions("event_day", *partition, F.desc(clustering))
    texts = [c for c in partition if isinstance(schemas.SERVING[table][c].dataType, T.StringType)]
    blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in texts}
    blooms["parquet.bloom.filter.adaptive.enabled"] = "true"
    return commits.write(placed, topic_path(root, table), folder, ["event_day"], blooms, step)


def save_batch(batch: DataFrame, root: str, table: str, batch_id: int, run: int = 0, step: int | None = None) -> None:
    """Publish one micro-batch as sorted runs of level 0; a replay changes nothing.

    ``step`` is the number of days of a run where it is known; otherwise the days of the
    batch, which is held for it, are counted."""
    spark, path = batch.sparkSession, topic_path(root, table)
    if commits.is_done(spark, path, str(run), batch_id):
        return
    marked = batch.withColumns({"run": F.lit(run).cast("long"), "batch_id": F.lit(batch_id).cast("long")})
    folder = f"depth=0/by={run}/batch={batch_id}"
    if step:
        added = _store(marked, root, table, folder, step)
    else:
        marked.persist()
        try:
            step = commits.step_for(marked, schemas.SERVING_KEYS[table][1])
            added = _store(marked, root, table, folder, step)
        finally:
            marked.unpersist()
    entries = {f: {**about, "level": 0} for f, about in added.items()}
    commits.commit(spark, path, lambda now: {"add": entries}, (str(run), batch_id))


def save_counts(
    counts: DataFrame, root: str, table: str, batch_id: int, run: int = 0, step: int | None = None
) -> None:
    """Publish one micro-batch's own counts; ``merged_counts`` adds those of a run up."""
    save_batch(counts, root, table, batch_id, run, step)


def run_of(spark: SparkSession, checkpoint: str) -> int:
    """The number of the query that owns ``checkpoint``: the microseconds at which it
    was first started, kept beside the checkpoint. A new checkpoint is a later run."""
    return number_in(spark, f"{checkpoint.rstrip('/')}/serving_run", time.time_ns() // 1000)


def keyed_stream(
    rows: DataFrame,
    table: str,
    root: str,
    checkpoint: str,
    trigger: Mapping[str, object] = EVERY_MINUTE,
) -> DataStreamWriter:
    """Upsert rows into the serving table ``table`` by its primary key.

    Micro-batches are commits kept apart by run and ``batch_id``; ``latest_by_key``
    reads the last one per key. NULL is a key like any other.
    """
    run = run_of(rows.sparkSession, checkpoint)
    stored = rows.observe(f"keyed_{table}", F.count(F.lit(1)).alias("rows")).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.SERVING[table].fields]
    )
    return (
        stored.writeStream.foreachBatch(
            lambda batch, batch_id: save_batch(batch, root, table, batch_id, run)
        )
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )


def _runs(
    spark: SparkSession, root: str, table: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Rows of the published runs of the days from ``first`` to ``last``."""
    schema = T.StructType([*schemas.SERVING[table].fields, T.StructField("event_day", T.DateType()), *WRITER.fields])
    found = commits.state(spark, topic_path(root, table)).folders
    wanted = {
        f: about for f, about in found.items()
        if (first is None or (commits.last_day(about, "event_day") or "") >= first)
        and (last is None or (about["event_day"] or "") <= last)
    }
    rows = commits.read(spark, topic_path(root, table), schema, list(wanted))
    return commits.by_day(rows, "event_day", schemas.SERVING_KEYS[table][1], list(wanted.values()))


def _instant(moment: datetime) -> datetime:
    """A time without zone means UTC, whatever the zone of the driver."""
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def latest_by_key(
    spark: SparkSession,
    root: str,
    table: str,
    start: datetime | None = None,
    end: datetime | None = None,
    where: Column | None = None,
    adds: bool = False,
) -> DataFrame:
    """The serving table: for every key the row of the last micro-batch.

    A maximum per key rather than a ranking: it is combined within the scan
    tasks, and two rows of one batch with the same key resolve the same way on
    every read. ``start`` and ``end`` bound the time, [start, end), and leave out
    the folders of other days. ``where`` is a condition on key columns, which reaches
    the files before anything is grouped: their filters leave out what can't match.
    The rows are those of one state of the log, whatever is published meanwhile.
    ``adds``: see ``merged_counts``.
    """
    schema = schemas.SERVING[table]
    key = schemas.serving_key(table)
    values = [c for c in schema.names if c not in key]
    _, clustering = schemas.SERVING_KEYS[table]
    first = _instant(start).astimezone(timezone.utc) if start is not None else None
    last = _instant(end).astimezone(timezone.utc) if end is not None else None
    day = lambda moment: moment.date().isoformat() if moment else None
    stored = _runs(spark, root, table, day(first), day(last))
    if first:
        stored = stored.where((F.col("event_day") >= first.date()) & (F.col(clustering) >= first))
    if last:
        stored = stored.where((F.col("event_day") <= last.date()) & (F.col(clustering) < last))
    if where is not None:
        stored = stored.where(where)
    if adds:
        stored = _added_up(stored, key)
    newest = F.max(F.struct("run", "batch_id", *values)).alias("last")
    return stored.groupBy(*key).agg(newest).select(*key, "last.*").select(*schema.names)


def _added_up(stored: DataFrame, key: list[str]) -> DataFrame:
    """Counts of the batches of one run as one row per key; calendar fields go with the key."""
    others = [c for c in stored.columns if c not in {*key, "run", "batch_id", "count", "event_day"}]
    return stored.groupBy(*key, "run").agg(
        F.sum("count").alias("count"), F.max("batch_id").alias("batch_id"), *[F.first(c).alias(c) for c in others]
    )


def merged_counts(spark: SparkSession, root: str, table: str, **bounds: object) -> DataFrame:
    """A table written by ``save_counts``: per key the sum over the batches of the latest
    run that has it, so a row counts in its minute however late it came. ``bounds`` are
    those of ``latest_by_key``."""
    return latest_by_key(spark, root, table, adds=True, **bounds)


def compact(
    spark: SparkSession, root: str, table: str, before: date, fan_in: int = 2, adds: bool = False
) -> list[date]:
    """Merge the sorted runs of each day before ``before`` into one row per key.

    Runs of one level are merged into one of the next where a day has ``fan_in`` of
    them, so a row is rewritten once per level; with the default a day becomes
    one run. Merged rows keep the run and batch they come from, so days needn't be
    closed. The merged runs and the end of the old ones are one commit; the old
    files stay for readers at work until ``vacuum``. With ``adds`` the table holds counts
    of batches, which are added up per run. Where runs hold spans of days, those that
    overlap are merged into the widest. Returns the (first) days merged.
    """
    path = topic_path(root, table)
    merged_days: set[str] = set()
    while True:
        levels: dict[int, dict[str, dict]] = {}
        found = commits.state(spark, path).folders
        for folder, about in found.items():
            if about["event_day"] is not None and commits.last_day(about, "event_day") < before.isoformat():
                levels.setdefault(0 if fan_in <= 2 else about["level"], {})[folder] = about
        groups = {(d, n): f for n, over in levels.items() for d, f in commits.overlapping(over, "event_day").items()}
        ready = {g: f for g, f in groups.items() if len(f) >= max(fan_in, 2)}
        if not ready:
            return [date.fromisoformat(d) for d in sorted(merged_days)]
        _merge(spark, root, table, ready, adds, max(found[f].get("days", 1) for fs in ready.values() for f in fs))
        merged_days |= {day for day, _ in ready}


def _merge(
    spark: SparkSession, root: str, table: str, ready: dict[tuple[str, int], list[str]], adds: bool, step: int
) -> None:
    """Publish one run of the next level for each group of runs, none of which is wider than ``step``."""
    path, key = topic_path(root, table), schemas.serving_key(table)
    values = [c for c in schemas.SERVING[table].names if c not in key]
    schema = T.StructType([*schemas.SERVING[table].fields, *WRITER.fields])
    for level in sorted({level for _, level in ready}):
        old = [f for (_, of), several in ready.items() if of == level for f in several]
        stored = commits.read(spark, path, schema, old)
        newest = F.max(F.struct("run", "batch_id", *values)).alias("last")
        merged = _added_up(stored, key) if adds else stored.groupBy(*key).agg(newest).select(*key, "last.*")
        name = f"depth={level + 1}/by=merged/batch={commits.new_name()}"
        added = _store(merged.select(*schema.names), root, table, name, step)
        entries = {f: {**about, "level": level + 1} for f, about in added.items()}
        commits.commit(
            spark, path,
            lambda now: {"add": entries, "remove": old} if set(old) <= set(now.folders) else None,  # noqa: B023
        )


def vacuum(spark: SparkSession, root: str, table: str, keep_seconds: float = commits.KEEP_SECONDS) -> list[str]:
    """Delete merged-away runs that no reader can still hold; returns their folders."""
    return commits.vacuum(spark, topic_path(root, table), keep_seconds)


def debug_stream(
    rows: DataFrame,
    trigger: Mapping[str, object] = EVERY_MINUTE,
    fmt: str = "console",
    name: str | None = None,
) -> DataStreamWriter:
    """Untruncated console output, or an in-memory table called ``name``."""
    writer = rows.writeStream.format(fmt).outputMode("append").trigger(**trigger)
    if name is not None:
        writer = writer.queryName(name)
    return writer.option("truncate", False) if fmt == "console" else writer
