"""Landed topics: parquet in folders by run, batch and ``date``, published by commits.

Streams and batch loads land in the same way, under any number of checkpoints; only
published folders are read, so an attempt that failed is never seen.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.sources import commits


def topic_path(root: str, topic: str) -> str:
    return f"{root.rstrip('/')}/{topic}"


def _days(spark: SparkSession, root: str, topic: str, wanted: Callable[[str | None, str | None], bool]) -> DataFrame:
    """Rows of the published folders whose first and last day are wanted, of one state of the log."""
    path = topic_path(root, topic)
    if not commits.exists(spark, path):
        raise FileNotFoundError(f"no landed topic at {path}")
    found = commits.state(spark, path).folders
    found = {f: about for f, about in found.items() if wanted(about["date"], commits.last_day(about, "date"))}
    rows = commits.read(spark, path, schemas.landed(topic), list(found))
    return commits.by_day(rows, "date", "ts", list(found.values()))


def landed(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """All landed rows of ``topic``; a topic that isn't there is an error.

    The schema is declared, so no file is opened to plan the scan.
    """
    return _days(spark, root, topic, lambda first, last: True)


def landed_before(spark: SparkSession, root: str, topic: str, as_of: date) -> DataFrame:
    """Rows of the days before ``as_of``: folders of other days aren't listed."""
    end = as_of.isoformat()
    found = _days(spark, root, topic, lambda first, last: first is not None and first < end)
    return found.where(F.col("date") < F.lit(as_of))


def landed_day(spark: SparkSession, root: str, topic: str, day: date) -> DataFrame:
    """Rows of one day: other folders aren't listed, an absent day has no rows."""
    name = day.isoformat()
    found = _days(spark, root, topic, lambda first, last: first is not None and first <= name <= last)
    return found.where(F.col("date") == F.lit(day))


def _write(rows: DataFrame, path: str, folder: str, step: int) -> dict[str, dict]:
    dated = rows.withColumn("date", commits.first_day("ts", step)).hint("rebalance", "date")
    if step > 1:  # the days of a folder follow each other, for filters on time
        dated = dated.sortWithinPartitions("date", "ts")
    return commits.write(dated, path, folder, ["date"], step=step)


def land_rows(
    rows: DataFrame, root: str, topic: str, run: str, number: int = 0, replace: bool = False, step: int | None = None
) -> None:
    """Publish events as the landing ``number`` of ``run``, by UTC day of ``ts``.

    The same landing again changes nothing. ``replace`` takes out what was there. ``step``
    is the number of days of a folder where it is known; otherwise the days are counted.
    """
    spark, path = rows.sparkSession, topic_path(root, topic)
    if commits.is_done(spark, path, run, number):
        return
    added = _write(rows, path, f"run={run}/batch={number}", step or commits.step_for(rows, "ts"))
    commits.commit(
        spark, path, lambda now: {"add": added, "remove": list(now.folders) if replace else []}, (run, number)
    )


def merge_days(spark: SparkSession, root: str, topic: str, before: date) -> list[str]:
    """Bring what was landed of each day before ``before`` together in one folder, of that
    day or of the span of days it was landed with.

    Readers at work keep the old folders until ``commits.vacuum``; rows landed late
    for a merged day are a folder of their own. Returns the (first) days merged.
    """
    path, end = topic_path(root, topic), before.isoformat()
    over = {
        f: about for f, about in commits.state(spark, path).folders.items()
        if about["date"] is not None and commits.last_day(about, "date") < end
    }
    folders = commits.overlapping(over, "date")
    old = [f for several in folders.values() if len(several) > 1 for f in several]
    if not old:
        return []
    rows = commits.read(spark, path, schemas.landed(topic), old)
    step = max(over[f].get("days", 1) for f in old)
    added = _write(rows, path, f"run=merged-{commits.new_name()}/batch=0", step)
    commits.commit(spark, path, lambda now: {"add": added, "remove": old} if set(old) <= set(now.folders) else None)
    return sorted(d for d, several in folders.items() if len(several) > 1)


def extract(
    spark: SparkSession, root: str, topic: str, mode: str, day: date | None = None
) -> DataFrame:
    """``full`` for everything, ``incremental`` for one day."""
    if mode == "full":
        return landed(spark, root, topic)
    if mode == "incremental":
        if day is None:
            raise ValueError("mode 'incremental' needs a day")
        return landed_day(spark, root, topic, day)
    raise ValueError(f"unknown mode {mode!r}")
