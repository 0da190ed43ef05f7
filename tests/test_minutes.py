from __future__ import annotations

from datetime import datetime, timezone

from conftest import rows
from eventmart import schemas
from eventmart.operators import analytics, minutes


def _shape(df):
    return [(f.name, f.dataType) for f in df.schema]


def test_every_minute_table_has_its_stored_shape(make_topic):
    for table, build in minutes.TABLES.items():
        events = make_topic(minutes.INPUT_TOPIC[table], [dict()])
        assert _shape(build(events)) == _shape_of(schemas.SERVING[table]), table
        assert build(events).count() == 1, table


def _shape_of(schema):
    return [(f.name, f.dataType) for f in schema]


def test_counts_per_minute_and_calendar(make_topic):
    times = ["2023-01-01 00:00:00", "2023-01-01 00:00:59.999", "2023-01-01 00:01:00", None]
    events = make_topic("listen_events", [dict(ts=t) for t in times])
    assert rows(minutes.listen_count_minute(events).drop("ingest_ts")) == [
        (2023, 52, 1, 1, 0, 0, 2),
        (2023, 52, 1, 1, 0, 1, 1),
    ]


def test_missing_song_is_a_group(make_topic):
    events = make_topic("listen_events", [dict(song=None), dict(song=None), dict(song="x")])
    got = rows(minutes.song_chart_minute(events).select("song", "count"))
    assert got == [("x", 1), (None, 2)]


def test_state_is_prefixed_unless_missing(make_topic):
    events = make_topic("page_view_events", [dict(state="NY"), dict(state=None)])
    got = rows(minutes.user_activity_minute(events).select("state", "count"))
    assert got == [("US-NY", 1), (None, 1)]


def test_gender_counts_known_people_only(make_topic):
    people = [dict(), dict(gender=None), dict(level=None), dict(gender="F")]
    events = make_topic("auth_events", people)
    got = rows(minutes.gender_distribution_minute(events).drop("ingest_ts"))
    assert got == [("F", "free", 1), ("M", "free", 1)]


def test_login_feed_keeps_failures_and_drops_strangers(make_topic):
    events = make_topic("auth_events", [dict(), dict(success=False), dict(userId=None)])
    assert rows(minutes.user_login(events).select("userId")) == [("7",), ("7",)]
    assert minutes.user_login(events, only_success=True).count() == 1


def test_latest_minutes_is_newest_first_within_a_range(make_topic):
    events = make_topic(
        "listen_events", [dict(ts=f"2024-01-01 00:{m:02d}:30") for m in range(10)]
    )
    table = minutes.listen_count_minute(events)
    assert [r.minute for r in analytics.latest_minutes(table, 3).collect()] == [9, 8, 7]
    low, high = datetime(2024, 1, 1, 0, 2), datetime(2024, 1, 1, 0, 4, tzinfo=timezone.utc)
    ranged = analytics.latest_minutes(table, 9, low, high)
    assert [r.minute for r in ranged.collect()] == [3, 2]
