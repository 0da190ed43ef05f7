"""Validity intervals and as-of matches against brute force; roll-ups against facts."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventmart import schemas, session
from eventmart.operators import analytics, dims, membership, rollups, validity
from eventmart.operators.conform import Activity, conform
from eventmart.plans import loads
from eventmart.plans.tables import land, merge_folders
from eventmart.sources import commits, sample, warehouse

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def seen(spark):
    """Events of few users, one of them with most rows, some without user or time."""
    rng = random.Random(4)
    made = []
    for i in range(300):
        user = None if i % 40 == 0 else "hot" if i % 3 else f"u{rng.randrange(4)}"
        ts = None if i % 55 == 0 else START + timedelta(minutes=rng.randrange(4000))
        made.append((user, "L", "F", rng.choice(["M", None]), rng.choice(["free", "paid"]), "r", ts))
    ddl = "userId string, lastName string, firstName string, gender string, level string, registration string, ts timestamp"
    parts = [spark.createDataFrame(made[k::3], ddl) for k in range(3)]
    return made, Activity(*parts)


def brute_validity(made):
    least = lambda v: tuple((x is not None, x or "") for x in v)
    at = {}
    for user, *values, ts in made:
        if user is not None and ts is not None:
            at[user, ts] = max(at.get((user, ts), tuple(values)), tuple(values), key=least)
    out = []
    for user in {u for u, _ in at}:
        stays = []
        for ts in sorted(t for u, t in at if u == user):
            if not stays or stays[-1][0] != at[user, ts]:
                stays.append((at[user, ts], ts))
        for (version, ts), after in zip(stays, [*stays[1:], (None, None)], strict=True):
            out.append((user, *version, ts, after[1]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("stretch", [600, validity.STRETCH])
def test_validity_equals_brute_force(seen, stretch):
    made, activity = seen
    assert rows(validity.user_validity(activity, stretch)) == brute_validity(made)


@pytest.mark.parametrize("stretch", [600, validity.STRETCH])
def test_as_of_equals_brute_force(spark, seen, stretch):
    made, activity = seen
    versions = validity.user_validity(activity, stretch)
    stays = brute_validity(made[:150])
    versions = spark.createDataFrame(stays, versions.schema)
    events = activity.listen.select("userId", "ts")
    want = []
    for user, *_, ts in made[0::3]:
        met = [s for s in stays if user is not None and ts is not None and s[0] == user and s[6] <= ts]
        best = max(met, key=lambda s: s[6], default=None)
        want.append((user, ts, best and best[4], best and best[6]))
    assert rows(validity.as_of(events, versions, ["level", "valid_from"], stretch)) == sorted(want, key=repr)


def test_rollups_follow_loads(spark, sf_dir):
    session.prepare(spark)
    landed_root, root = session.work_dir(spark, "landed"), session.work_dir(spark, "warehouse")
    for topic in schemas.STAR_TOPICS:
        land(sample.topic(spark, sf_dir, topic), landed_root, topic)
    loads.full_load(spark, landed_root, root, date(2024, 1, 28), with_rollups=True)
    for day in (28, 28, 29, 30):  # one day twice adds nothing
        loads.incremental_load(spark, landed_root, root, date(2024, 1, day), date(2024, 1, 31), with_rollups=True)

    def check():
        star = warehouse.read_star(spark, root)
        facts = {n: warehouse.read_fact(spark, root, n) for n in schemas.FACTS}
        stored = {n: warehouse.read_rollup(spark, root, n) for n in rollups.ROLLUPS}
        for grain in ("month", "hour"):
            assert rows(rollups.logged_in_users(stored["rollup_logins"], star, grain)) == rows(
                analytics.logged_in_users(facts["fact_auth"], star, grain)
            )
            assert rows(rollups.songs_played(stored["rollup_songs"], star, grain)) == rows(
                analytics.songs_played(facts["fact_listen"], star, grain)
            )
        assert rows(rollups.top_songs(stored["rollup_songs"], star, "week", 5)) == rows(
            analytics.top_songs(facts["fact_listen"], star, "week", 5)
        )

    check()
    merge_folders(spark, root)
    commits.vacuum(spark, root, 0)
    check()
    numbers = warehouse.read_rollup(spark, root, "user_numbers")
    assert numbers.selectExpr("count(*) = count(distinct userId) and max(number) = count(*) - 1").first()[0]
    with pytest.raises(ValueError, match="grain"):
        rollups.songs_played(warehouse.read_rollup(spark, root, "rollup_songs"), warehouse.read_star(spark, root), "minute")


def test_rollup_questions_read_no_facts(spark, sf_dir):
    from eventmart.registry.queries import all_queries

    files = all_queries()["rollup_logged_in_users_month"](spark, sf_dir).inputFiles()
    assert any("/rollup_logins/" in f for f in files) and not any("/fact_" in f for f in files)


def test_membership_filters_lose_no_member(spark):
    keys = ["a", "b"]
    members = spark.range(3000).selectExpr("cast(id as string) as a", "id * 2 as b")
    others = spark.range(3000, 6000).selectExpr("cast(id as string) as a", "id * 2 as b")
    blocks = membership.blocks_for(1)
    parts = membership.build(members.where("b < 2000"), keys, blocks).union(membership.build(members.where("b >= 2000"), keys, blocks))
    found = membership.possible(members.union(others), keys, parts, blocks)
    assert found.join(members, keys, "left_semi").count() == 3000
    assert found.count() - 3000 < 60
    assert membership.possible(others, keys, parts.limit(0), blocks).count() == 0


def test_filtered_members_equal_plain_ones_and_may_skip_the_dimension(spark, sf_dir):
    activity = conform(*[sample.topic(spark, sf_dir, t) for t in schemas.STAR_TOPICS])
    early = Activity(*[t.where("ts < '2024-01-10'") for t in activity])
    late = Activity(*[t.where("ts >= '2024-01-20'") for t in activity])
    for name in ("dim_song", "dim_user", "dim_location", "dim_date"):
        stored = getattr(dims, name)(early)
        keys = dims.natural_key(name)
        parts = membership.build(stored, keys, membership.blocks_for(stored.count()))
        want = rows(dims.new_members(name, late, stored))
        assert rows(dims.new_members(name, late, stored, parts)) == want
    days = dims.dim_date(early)  # no late day is stored, so the stored days aren't looked at
    parts = membership.build(days, schemas.DATE_KEY, membership.blocks_for(10))
    marked = days.withColumn("day", F.raise_error(F.lit("read")).cast("int"))
    assert dims.new_members("dim_date", late, marked, parts).count() == 11
