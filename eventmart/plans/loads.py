"""The two load jobs of the star schema.

Both take the dates they work on as arguments, write dimensions before facts, publish
all tables by one commit, and can be run again after a failure: keys do not change
between runs, the full load replaces, and the incremental load adds only what is not
stored.

Nothing is cached: every dimension and fact reads just its own columns, so the
scans together read little more than each column once, while holding the
enriched events of all topics would cost more than the scans.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date
from functools import partial

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.functions.nulls import GUEST_IDS
from eventmart.operators import dims, facts, membership, rollups
from eventmart.operators.conform import Activity, conform
from eventmart.operators.lookup import measure
from eventmart.plans.tables import load_folder, run_together, stage_table
from eventmart.sources import commits
from eventmart.sources.files import delete
from eventmart.sources.landed import landed_before, landed_day
from eventmart.sources.warehouse import (
    folders_of,
    read_dim,
    read_fact,
    read_filter,
    read_rollup,
    read_star,
    snapshot,
)

_DIMENSIONS = {
    "dim_date": dims.dim_date,
    "dim_song": dims.dim_song,
    "dim_user": dims.dim_user,
    "dim_location": dims.dim_location,
}


def _activity(extract, guest_ids: tuple[str, str]) -> Activity:
    return conform(*[extract(topic) for topic in schemas.STAR_TOPICS], guest_ids)


def full_load(
    spark: SparkSession,
    landed_root: str,
    warehouse_root: str,
    as_of: date,
    user_match: str = "version",
    guest_ids: tuple[str, str] = GUEST_IDS,
    with_rollups: bool = False,
    with_filters: bool = False,
) -> None:
    """Rebuild all dimensions and facts from the days before ``as_of``.

    ``with_rollups`` keeps the roll-ups of ``operators.rollups`` as well, ``with_filters``
    the filters of ``operators.membership``; loads of one warehouse should agree on
    both. All eight tables are written to folders of their own and published by one commit
    that takes out the old ones; whatever fails before leaves the old tables, and a
    reader sees all tables of one load or all of the other.
    One fact per event (``version``) is a scan and a write, as landed rows already
    are grouped by day; matching on the id brings them together by day again. Beyond
    ``commits.SPANS`` days a fact's folders hold spans of days, as landed ones do.
    """
    activity = _activity(
        lambda topic: landed_before(spark, landed_root, topic, as_of), guest_ids
    )
    root, load = warehouse_root.rstrip("/"), commits.new_name()
    with _staged(spark, root, load):
        added = _stage_all(spark, activity, root, load, user_match)
        if with_rollups:
            added |= _stage_rollups(spark, root, load, commits.State(), added)
        if with_filters:
            added |= _stage_filters(spark, root, load, commits.State(), added)
    commits.commit(spark, root, lambda now: {"add": added, "remove": list(now.folders)})
    commits.vacuum(spark, root)


@contextmanager
def _staged(spark: SparkSession, root: str, load: str) -> Iterator[None]:
    """Take away what a load has written if it fails before it is published."""
    try:
        yield
    except BaseException:
        for name in (*schemas.DIMENSIONS, *schemas.FACTS, *rollups.ROLLUPS, "user_numbers", *(f"filter_{d}" for d in _DIMENSIONS)):
            delete(spark, f"{root}/{load_folder(name, load)}")
        raise


def _together(spark: SparkSession, stages: list[partial]) -> dict[str, dict]:
    """Staged tables written at once, as entries to add."""
    return {folder: about for entries in run_together(spark, stages) for folder, about in entries.items()}


def _stage_all(spark: SparkSession, activity: Activity, root: str, load: str, user_match: str) -> dict[str, dict]:
    built = {"dim_time": dims.dim_time(spark)}
    built |= {name: build(activity) for name, build in _DIMENSIONS.items()}
    added = _together(
        spark, [partial(stage_table, rows, root, name, load, rebalance=[]) for name, rows in built.items()]
    )
    dates = read_dim(spark, root, "dim_date", commits.State(folders=added))
    step = commits.step_for(dates.select(F.make_date("year", "month", "day").alias("day")), "day")
    star, by_day, users = None, None, None
    if user_match == "id":
        star, by_day = read_star(spark, root, commits.State(folders=added)), ["date_id"]
        users = measure(star.user)
    built = {
        name: facts.fact(name, events, star, user_match=user_match, user_bytes=users)
        for name, events in zip(schemas.FACTS, activity, strict=True)
    }
    return added | _together(
        spark,
        [partial(stage_table, rows, root, name, load, ["date_id"], by_day, step) for name, rows in built.items()],
    )


def _stage_filters(
    spark: SparkSession, root: str, load: str, before: commits.State, added: dict[str, dict]
) -> dict[str, dict]:
    """The parts of the membership filters that this load's own members make. A filter
    keeps its number of blocks until a full load makes it anew."""
    new, built = commits.State(folders=added), {}
    for name in _DIMENSIONS:
        members = read_dim(spark, root, name, new)
        blocks = None
        if folders_of(before, f"filter_{name}"):
            blocks = read_filter(spark, root, name, before).agg(F.max("blocks")).first()[0]
        built[f"filter_{name}"] = membership.build(
            members, dims.natural_key(name), blocks or membership.blocks_for(members.count())
        )
    return _together(
        spark, [partial(stage_table, rows, root, name, load, rebalance=[]) for name, rows in built.items()]
    )


def _stage_rollups(
    spark: SparkSession, root: str, load: str, before: commits.State, added: dict[str, dict]
) -> dict[str, dict]:
    """What this load's facts add to the roll-ups, from its staged facts."""
    new = commits.State(folders=added)
    listens, auth = (read_fact(spark, root, name, None, new) for name in ("fact_listen", "fact_auth"))
    known = read_rollup(spark, root, "user_numbers", before)
    first = known.agg(F.max("number")).first()[0]
    numbers = rollups.number_users(
        auth.where("success"), None if first is None else known, 0 if first is None else first + 1
    )
    staged = stage_table(numbers, root, "user_numbers", load, rebalance=[])
    everyone = read_rollup(spark, root, "user_numbers", commits.State(folders=before.folders | staged))
    built = {
        "rollup_songs": rollups.plays(listens, "song_id"),
        "rollup_places": rollups.plays(listens, "location_id"),
        "rollup_logins": rollups.logins(auth, everyone),
    }
    by = {name: None if name == "rollup_logins" else [] for name in built}  # logins are brought together as they are made
    return staged | _together(
        spark, [partial(stage_table, rows, root, name, load, rebalance=by[name]) for name, rows in built.items()]
    )


def incremental_load(
    spark: SparkSession,
    landed_root: str,
    warehouse_root: str,
    process_date: date,
    as_of: date,
    user_match: str = "version",
    guest_ids: tuple[str, str] = GUEST_IDS,
    with_rollups: bool = False,
    with_filters: bool = False,
) -> None:
    """Add one landed day, its new dimension members and its new facts, by one commit.

    ``process_date`` must be over at ``as_of``. Landed days are UTC days of the
    event time, so the stored facts to compare with are one partition.
    """
    if process_date >= as_of:
        raise ValueError(f"{process_date} is not complete at {as_of}")
    activity = _activity(
        lambda topic: landed_day(spark, landed_root, topic, process_date), guest_ids
    )
    root, load = warehouse_root.rstrip("/"), commits.new_name()
    seen = snapshot(spark, root)
    with _staged(spark, root, load):
        known = {name: read_dim(spark, root, name, seen) for name in _DIMENSIONS}
        filters = {name: read_filter(spark, root, name, seen) if with_filters else None for name in _DIMENSIONS}
        found = run_together(
            spark, [partial(dims.new_members, n, activity, stored, filters[n]) for n, stored in known.items()]
        )
        members = dict(zip(known, found, strict=True))
        added = _together(
            spark, [partial(stage_table, rows, root, name, load, rebalance=[]) for name, rows in members.items()]
        )
        star, users = None, None
        if user_match == "id":
            star = read_star(spark, root, commits.State(folders=seen.folders | added))
            users = measure(star.user)
        date_ids = [process_date.strftime("%Y%m%d")]
        built = {}
        for name, events in zip(schemas.FACTS, activity, strict=True):
            rows = facts.fact(name, events, star, user_match=user_match, user_bytes=users, copies=False)
            stored = read_fact(spark, root, name, date_ids, seen)
            built[name] = facts.new_facts(rows, stored, user_match)
        added |= _together(
            spark, [partial(stage_table, rows, root, name, load, ["date_id"], []) for name, rows in built.items()]
        )

        if with_rollups:
            added |= _stage_rollups(spark, root, load, seen, added)
        if with_filters:
            added |= _stage_filters(spark, root, load, seen, added)

        def change(now: commits.State) -> dict:
            if now.folders != seen.folders:
                raise RuntimeError("another load was published meanwhile; nothing was added, run again")
            return {"add": added}

        commits.commit(spark, root, change)
