from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventmart import schemas
from eventmart.operators import analytics, dims, facts
from eventmart.operators.conform import conform
from eventmart.sources import sample

NAN = float("nan")


@pytest.fixture(scope="module")
def activity(spark, sf_dir):
    base = sample.base(spark, sf_dir)
    return conform(*[sample.as_topic(base, t) for t in schemas.STAR_TOPICS])


@pytest.fixture(scope="module")
def small(make_topic):
    """A user with two versions, one incomplete version, one guest."""
    listen = make_topic(
        "listen_events",
        [
            dict(),
            dict(level="paid"),
            dict(userId=8, gender=None),
            dict(userId=9, lon=None),
            dict(userId=9, duration=NAN),
            dict(userId=9, song=None),
            dict(userId=9, ts=None),
        ],
    )
    auth = make_topic("auth_events", [dict(success=False), dict(success=None)])
    page = make_topic(
        "page_view_events", [dict(userId=None, song=None, artist=None, duration=None)]
    )
    return conform(listen, auth, page)


def test_dim_time_is_every_second_once(spark):
    clock = dims.dim_time(spark)
    assert clock.schema == schemas.DIMENSIONS["dim_time"] or [
        (f.name, f.dataType) for f in clock.schema
    ] == [(f.name, f.dataType) for f in schemas.DIMENSIONS["dim_time"]]
    stats = clock.agg(
        F.count("*"), F.countDistinct("time_id"), F.max("hour"), F.max("minute"), F.max("second")
    ).first()
    assert tuple(stats) == (86400, 86400, 23, 59, 59)
    assert clock.where("time_id = '010203'").first()[1:] == (1, 2, 3)


def test_dimensions_drop_incomplete_members(small):
    assert rows(dims.dim_song(small).select("title", "artist", "duration")) == [
        ("S", "A", 1.5),
        ("empty", "empty", 0.0),
    ]
    assert rows(dims.dim_user(small).select("userId", "level", "gender")) == [
        ("0", "free", "M"),
        ("7", "free", "M"),
        ("7", "paid", "M"),
        ("9", "free", "M"),
    ]
    assert dims.dim_location(small).count() == 1
    assert rows(dims.dim_date(small)) == [("20240102", 2, 3, 1, 1, 2024, 1)]


def test_facts_fan_out_per_user_version(spark, small):
    star = dims.star(spark, small)
    by_id = facts.fact_listen(small.listen, star, user_match="id")
    by_version = facts.fact_listen(small.listen, star, user_match="version")
    assert rows(by_id.groupBy("userId").count()) == [("7", 4)]
    assert rows(by_version.groupBy("userId").count()) == [("7", 2)]


def test_fact_drops_events_with_missing_dimension_parts(spark, small):
    star = dims.star(spark, small)
    fact = facts.fact_listen(small.listen, star, user_match="id")
    assert fact.where("userId = '9'").count() == 0


@pytest.mark.parametrize("name", list(schemas.FACTS))
@pytest.mark.parametrize("user_match", ["id", "version"])
def test_keyed_facts_equal_joined_facts(spark, activity, name, user_match):
    events = activity[list(schemas.FACTS).index(name)]
    star = dims.star(spark, activity)
    keyed = facts.fact(name, events, star, user_match=user_match, method="key")
    joined = facts.fact(name, events, star, user_match=user_match, method="join")
    assert rows(keyed) == rows(joined)
    assert [(f.name, f.dataType) for f in keyed.schema] == [
        (f.name, f.dataType) for f in schemas.FACTS[name]
    ]


@pytest.mark.parametrize("user_match", ["id", "version"])
def test_keyed_facts_equal_joined_facts_with_gaps(spark, small, user_match):
    star = dims.star(spark, small)
    for name, events in zip(schemas.FACTS, small, strict=True):
        keyed = facts.fact(name, events, star, user_match=user_match, method="key")
        joined = facts.fact(name, events, star, user_match=user_match, method="join")
        assert rows(keyed) == rows(joined), name


def test_shuffled_user_lookup_gives_the_same_copies(spark, activity, monkeypatch):
    star = dims.star(spark, activity)
    keyed = facts.fact_page_view(activity.page_view, user_match="version")
    broadcast = rows(facts.lookup_user(keyed, star.user))
    monkeypatch.setitem(facts.lookup.__kwdefaults__, "broadcast_bytes", 0)
    assert rows(facts.lookup_user(keyed, star.user)) == broadcast


def test_new_members_and_new_facts(spark, small, make_topic):
    more = conform(
        make_topic("listen_events", [dict(song="T"), dict(), dict(userId=70, city="D")]),
        make_topic("auth_events", []),
        make_topic("page_view_events", []),
    )
    stored = {n: getattr(dims, n)(small) for n in ("dim_song", "dim_user", "dim_location", "dim_date")}
    new = {n: dims.new_members(n, more, d) for n, d in stored.items()}
    assert rows(new["dim_song"].select("title")) == [("T",)]
    assert rows(new["dim_user"].select("userId")) == [("70",)]
    assert rows(new["dim_location"].select("city")) == [("D",)]
    assert new["dim_date"].count() == 0
    before = facts.fact_listen(small.listen)
    added = facts.new_facts(facts.fact_listen(more.listen), before)
    assert rows(added.select("userId")) == [("7",), ("70",)]


def test_options_are_checked(small):
    with pytest.raises(ValueError, match="user_match"):
        facts.fact_listen(small.listen, user_match="name")
    with pytest.raises(ValueError, match="method"):
        facts.fact_listen(small.listen, method="guess")
    with pytest.raises(ValueError, match="user dimension"):
        facts.fact_listen(small.listen, user_match="id")
    with pytest.raises(ValueError, match="dimensions"):
        facts.fact_listen(small.listen, method="join")
    with pytest.raises(ValueError, match="grain"):
        analytics.songs_played(facts.fact_listen(small.listen), dims.Star(), "decade")


def test_weeks_split_at_new_year(spark, make_topic):
    activity = conform(
        make_topic(
            "listen_events", [dict(ts="2022-12-31 12:00:00"), dict(ts="2023-01-01 12:00:00")]
        ),
        make_topic("auth_events", []),
        make_topic("page_view_events", []),
    )
    star = dims.star(spark, activity)
    weeks = analytics.songs_played(facts.fact_listen(activity.listen), star, "week")
    assert rows(weeks) == [(2022, 52, 1), (2023, 52, 1)]


def test_logins_count_users_once_and_failures_on_request(spark, make_topic):
    auth = [dict(), dict(), dict(userId=8, success=False), dict(userId=9, success=None)]
    activity = conform(
        make_topic("listen_events", []), make_topic("auth_events", auth), make_topic("page_view_events", [])
    )
    fact, star = facts.fact_auth(activity.auth), dims.star(spark, activity)
    assert rows(analytics.logged_in_users(fact, star, "year")) == [(2024, 1)]
    everyone = analytics.logged_in_users(fact, star, "year", only_success=False)
    assert rows(everyone) == [(2024, 3)]


def test_base_merges_customers_and_parts_that_are_not_small(spark, tmp_path):
    """By their files Spark would take both for small and broadcast them."""
    tables = {
        "events": [(0, 1, "view"), (1, 1, "click"), (2, 2, "view"), (3, None, "view"), (None, 2, "error"), (4, 9, "view")],
        "customer": [(1, "one", 0), (1, "uno", 0), (2, "two", 0), (None, "none", 0), (3, "three", None)],
        "nation": [(0, "N", 0)],
        "region": [(0, "R")],
        "part": [(0, "p", "b", 1), (1, "q", "b", 2), (2, "r", "b", 3), (None, "s", "b", 4)],
    }
    kinds = {**sample.TABLES, "events": "event_id BIGINT, user_id BIGINT, event_type STRING"}
    for name, values in tables.items():
        found = spark.createDataFrame(values, kinds[name])
        if name == "events":
            found = found.withColumn("ts", F.lit("2024-01-02 03:04:05").cast("timestamp_ntz"))
        found.write.parquet(f"{tmp_path}/{name}.parquet")
    small, large = sample.base(spark, str(tmp_path)), sample.base(spark, str(tmp_path), broadcast_bytes=0)
    assert rows(small) == rows(large)
    assert rows(large.select("event_id", "lastName", "song")) == [
        (0, "one", None), (0, "uno", None), (1, "one", "q"), (1, "uno", "q"), (2, "two", "r")
    ]
    joins = [df._jdf.queryExecution().optimizedPlan().toString().count("strategy=merge") for df in (small, large)]
    assert joins == [0, 2]
