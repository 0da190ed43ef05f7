"""Writing warehouse and landed tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.operators.membership import FILTER
from eventmart.operators.rollups import ROLLUPS, USER_NUMBERS
from eventmart.sources import commits
from eventmart.sources.landed import land_rows
from eventmart.sources.warehouse import folders_of, is_span, read_folders

MODES = ("overwrite", "append")
T = TypeVar("T")


def load_folder(name: str, load: str) -> str:
    """Where a load's part of a table lies. Facts have the load as a column of the path, as
    their day is one; a dimension's folder has no columns, so SQL tables of it have none more."""
    return f"{name}/load={load}" if name in schemas.FACTS else f"{name}/load-{load}"


def stage_table(
    rows: DataFrame,
    root: str,
    name: str,
    load: str,
    partition_by: Sequence[str] = (),
    rebalance: Sequence[str] | None = None,
    step: int = 1,
) -> dict[str, dict]:
    """Write parquet to a folder of ``load`` under ``root/name`` without publishing it;
    returns the entries a commit is to add.

    ``rebalance`` redistributes the rows for writing: by the given columns, so
    a day is a few files rather than one per task, or evenly for no columns.
    AQE sizes the write tasks and cuts a day far larger than the others into
    several. ``None`` writes rows where they are, which is right while they
    still are in the order of an input partitioned the same way. With a ``step``
    above one a fact's folders hold so many days, sorted by ``date_id``.
    """
    if step > 1:
        day = lambda at, n: F.substring("date_id", at, n).cast("int")
        rows = rows.withColumn("first_day", commits.first_day(F.make_date(day(1, 4), day(5, 2), day(7, 2)), step))
        if rebalance:
            rows = rows.hint("rebalance", "first_day")
        rows = rows.sortWithinPartitions("first_day", "date_id")
        added = commits.write(rows, root, load_folder(name, load), ["first_day"], step=step)
        return {folder: {**about, "table": name} for folder, about in added.items()}
    if rebalance is not None:
        rows = rows.hint("rebalance", *rebalance)
    added = commits.write(rows, root, load_folder(name, load), list(partition_by))
    return {folder: {**about, "table": name} for folder, about in added.items()}


def write_table(
    rows: DataFrame,
    root: str,
    name: str,
    mode: str,
    partition_by: Sequence[str] = (),
    rebalance: Sequence[str] | None = None,
) -> None:
    """Write one table and publish it by itself; see ``stage_table``."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    added = stage_table(rows, root, name, commits.new_name(), partition_by, rebalance)
    old = lambda now: folders_of(now, name) if mode == "overwrite" else []
    commits.commit(rows.sparkSession, root, lambda now: {"add": added, "remove": old(now)})


def _overlapping(seen: commits.State, name: str) -> dict[str | None, list[str]]:
    """Folders of a table that are to be one: all of a dimension, those of a day of a fact,
    or of the widest span of days they lie in."""
    found = {f: seen.folders[f] for f in folders_of(seen, name)}
    if not any(is_span(about) for about in found.values()):
        groups: dict[str | None, list[str]] = {}
        for folder, about in found.items():
            groups.setdefault(about.get("date_id"), []).append(folder)
        return groups
    iso = lambda day: f"{day[:4]}-{day[4:6]}-{day[6:]}"
    placed = {f: about if is_span(about) else {"first_day": iso(about["date_id"])} for f, about in found.items()}
    return commits.overlapping(placed, "first_day")


def merge_folders(spark: SparkSession, root: str, by_day: bool = False) -> None:
    """Bring each dimension, and each day (or span of days) of a fact, that several loads
    added to together in one folder: one commit, after which old folders wait for
    ``vacuum``. ``by_day`` gives facts that have spans of days a folder per day."""
    seen = commits.state(spark, root)
    old, steps = {}, {}
    for name in {about["table"]: None for about in seen.folders.values()}:
        groups = _overlapping(seen, name)
        steps[name] = 1 if by_day else max(seen.folders[f].get("days", 1) for fs in groups.values() for f in fs)
        apart = {f for f in folders_of(seen, name) if by_day and is_span(seen.folders[f])}
        found = [f for fs in groups.values() if len(fs) > 1 or apart & set(fs) for f in fs]
        if found:
            old[name] = found
    if not old:
        return
    load, added = commits.new_name(), {}
    for name, folders in old.items():
        known = {**schemas.DIMENSIONS, **schemas.FACTS, **ROLLUPS, "user_numbers": USER_NUMBERS}
        schema = FILTER if name.startswith("filter_") else known[name]
        if name in schemas.FACTS:
            rows = read_folders(spark, root, name, folders, seen)
            added |= stage_table(rows, root, name, load, ["date_id"], ["date_id"], steps[name])
        else:
            added |= stage_table(commits.read(spark, root, schema, folders), root, name, load, [], [])
    gone = [f for folders in old.values() for f in folders]
    commits.commit(
        spark, root, lambda now: {"add": added, "remove": gone} if set(gone) <= set(now.folders) else None
    )


def land(rows: DataFrame, root: str, topic: str, mode: str = "append", name: str | None = None) -> None:
    """Land a batch of events the way the stream does: by UTC day of ``ts``.

    A batch with a ``name`` is landed once, however often it is repeated.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    land_rows(rows, root, topic, f"batch-{name or commits.new_name()}", replace=mode == "overwrite")


def run_together(spark: SparkSession, writes: Sequence[Callable[[], T]]) -> list[T]:
    """Submit independent writes at once, so one fills the tail of another.

    They keep the caller's job group and tags. The first failure is raised after
    all have ended. Returns what the writes return.
    """
    as_caller = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        started = [pool.submit(as_caller(write)) for write in writes]
    return [write.result() for write in started]
