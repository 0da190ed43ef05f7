"""Stored dimensions and facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.operators.dims import Star
from eventmart.operators.membership import FILTER
from eventmart.operators.rollups import ROLLUPS, USER_NUMBERS
from eventmart.operators.sets import union_all
from eventmart.sources import commits


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def snapshot(spark: SparkSession, root: str) -> commits.State:
    """The warehouse as it is published now; reads that are given it agree with one
    another, whatever loads are published meanwhile."""
    return commits.state(spark, root)


def folders_of(state: commits.State, name: str, date_ids: Sequence[str] | None = None) -> list[str]:
    """Published folders of a table, of some days only if asked."""
    asked = None if date_ids is None else sorted(set(date_ids))
    return [
        f for f, about in state.folders.items() if about["table"] == name and (asked is None or _has_day(about, asked))
    ]


def is_span(about: dict) -> bool:
    """Whether a fact's folder holds the days from its ``first_day`` on, by its entry."""
    return "first_day" in about


def _has_day(about: dict, date_ids: Sequence[str]) -> bool:
    if not is_span(about):
        return about.get("date_id") in date_ids
    first, last = (day.replace("-", "") for day in (about["first_day"], commits.last_day(about, "first_day")))
    return any(first <= day <= last for day in date_ids)


def read_folders(spark: SparkSession, root: str, name: str, found: list[str], state: commits.State) -> DataFrame:
    """Rows of some folders of a fact. The day is a part of the path of a day's folder and
    a column of the files of a span, so the two are read side by side."""
    spans = [f for f in found if is_span(state.folders[f])]
    days = [f for f in found if not is_span(state.folders[f])]
    parts = [commits.read(spark, root, schemas.FACTS[name], some) for some in (days, spans) if some]
    return union_all(parts) if parts else commits.read(spark, root, schemas.FACTS[name], [])


def read_dim(spark: SparkSession, root: str, name: str, state: commits.State | None = None) -> DataFrame:
    """A stored dimension; one that isn't there is an error."""
    found = folders_of(state or snapshot(spark, root), name)
    if not found:
        raise FileNotFoundError(f"no dimension at {table_path(root, name)}")
    return commits.read(spark, root, schemas.DIMENSIONS[name], found)


def read_star(spark: SparkSession, root: str, state: commits.State | None = None) -> Star:
    """All five stored dimensions, of one state."""
    state = state or snapshot(spark, root)
    return Star(*[read_dim(spark, root, f"dim_{part}", state) for part in Star._fields])


def read_fact(
    spark: SparkSession,
    root: str,
    name: str,
    date_ids: Sequence[str] | None = None,
    state: commits.State | None = None,
) -> DataFrame:
    """A stored fact table, whole or only the partitions in ``date_ids``; no rows
    if none were stored yet."""
    state = state or snapshot(spark, root)
    fact = read_folders(spark, root, name, folders_of(state, name, date_ids), state)
    return fact if date_ids is None else fact.where(F.col("date_id").isin(list(date_ids)))


def read_rollup(spark: SparkSession, root: str, name: str, state: commits.State | None = None) -> DataFrame:
    """The parts of a roll-up (or of ``user_numbers``) that loads have published."""
    state = state or snapshot(spark, root)
    schema = USER_NUMBERS if name == "user_numbers" else ROLLUPS[name]
    return commits.read(spark, root, schema, folders_of(state, name))


def read_filter(spark: SparkSession, root: str, name: str, state: commits.State | None = None) -> DataFrame:
    """The parts of the membership filter of the dimension ``name``."""
    return commits.read(spark, root, FILTER, folders_of(state or snapshot(spark, root), f"filter_{name}"))
