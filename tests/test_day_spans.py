"""Tables whose rows lie on far more days than a write makes folders."""

from __future__ import annotations

import os
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from eventmart import schemas, session
from eventmart.operators import analytics, minutes, rollups
from eventmart.plans import catalog, loads
from eventmart.plans.tables import merge_folders
from eventmart.sources import commits, landed, warehouse
from eventmart.streaming import sinks
from tests.conftest import rows

DAYS = 200
FIRST = date(2023, 12, 1)


def _folders(spark, path):
    return commits.state(spark, path).folders


def _listens(make_topic, count=DAYS, step=1):
    times = [f"{FIRST + timedelta(days=n * step)} 10:{n % 60:02d}:00" for n in range(count)]
    return make_topic("listen_events", [*({"ts": t, "song": f"S{i}"} for i, t in enumerate(times)), {"ts": None}])


def test_landed_days_share_folders_and_read_as_before(spark, make_topic):
    root, topic = session.work_dir(spark, "spans"), "listen_events"
    events = _listens(make_topic)
    landed.land_rows(events, root, topic, "one")
    found = _folders(spark, f"{root}/{topic}")
    assert len(found) <= commits.SPANS + 2
    assert {about.get("days", 1) for about in found.values()} == {4}
    expected = events.withColumn("date", F.to_date("ts")).select(*schemas.landed(topic).names)
    assert rows(landed.landed(spark, root, topic)) == rows(expected)
    for number in (0, 1, 2, 3, 57, DAYS - 1):
        day = FIRST + timedelta(days=number)
        assert rows(landed.landed_day(spark, root, topic, day)) == rows(expected.where(F.col("date") == F.lit(day)))
        assert rows(landed.landed_before(spark, root, topic, day)) == rows(expected.where(F.col("date") < F.lit(day)))


def test_landed_spans_and_days_merge(spark, make_topic):
    root, topic = session.work_dir(spark, "spans"), "listen_events"
    events = _listens(make_topic)
    one = events.where(F.to_date("ts") == F.lit(FIRST + timedelta(days=9)))
    landed.land_rows(events, root, topic, "one")
    landed.land_rows(one, root, topic, "two")
    expected = rows(landed.landed(spark, root, topic))
    before = len(_folders(spark, f"{root}/{topic}"))
    assert len(landed.merge_days(spark, root, topic, FIRST + timedelta(days=400))) == 1
    assert len(_folders(spark, f"{root}/{topic}")) == before - 1
    assert rows(landed.landed(spark, root, topic)) == expected
    assert landed.merge_days(spark, root, topic, FIRST + timedelta(days=400)) == []


def test_serving_runs_span_days(spark, make_topic):
    root, table = session.work_dir(spark, "spans"), "song_chart_minute"
    counts = minutes.song_chart_minute(_listens(make_topic).where("ts is not null"))
    late = counts.where(F.to_date("ingest_ts") == F.lit(FIRST + timedelta(days=77)))
    sinks.save_batch(counts, root, table, 0)
    sinks.save_batch(late.withColumn("count", F.col("count") + 5), root, table, 1)
    found = _folders(spark, f"{root}/{table}")
    assert len(found) <= commits.SPANS + 3
    expected = rows(sinks.latest_by_key(spark, root, table))
    assert len(expected) == DAYS and sum(r[schemas.SERVING[table].names.index("count")] == 6 for r in expected) == 1
    for number in (0, 76, 77, 130):
        start = datetime.combine(FIRST + timedelta(days=number), datetime.min.time())
        got = sinks.latest_by_key(spark, root, table, start, start + timedelta(days=1))
        assert rows(got) == rows(sinks.latest_by_key(spark, root, table).where(F.to_date("ingest_ts") == F.lit(start.date())))
        assert got.count() == 1
    assert len(sinks.compact(spark, root, table, FIRST + timedelta(days=400))) == 1
    assert len(_folders(spark, f"{root}/{table}")) == len(found) - 1
    assert rows(sinks.latest_by_key(spark, root, table)) == expected


def test_an_outlier_day_does_not_widen_folders(spark, make_topic):
    root, topic = session.work_dir(spark, "spans"), "listen_events"
    events = make_topic("listen_events", [{"ts": "1970-01-01 00:00:00"}, *({"ts": f"2024-01-{d:02d} 01:00:00"} for d in range(1, 31))])
    landed.land_rows(events, root, topic, "one")
    assert all("days" not in about for about in _folders(spark, f"{root}/{topic}").values())


def test_widest_span_takes_what_lies_in_it():
    day = lambda d, n=1: {"date": d, **({"days": n} if n > 1 else {})}
    groups = commits.overlapping(
        {"a": day("1970-01-05", 4), "b": day("1970-01-06"), "c": day("1970-01-09"), "d": day("1970-01-07", 2), "e": day("1970-01-09")}, "date"
    )
    assert groups == {"1970-01-05": ["a", "b", "d"], "1970-01-09": ["c", "e"]}


def test_filters_of_keys_are_as_large_as_the_keys(spark):
    root, table = session.work_dir(spark, "spans"), "song_chart_minute"
    counts = spark.range(3000).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60 % 86400).alias("ts"), F.md5(F.col("id").cast("string")).alias("song")
    )
    sinks.save_batch(minutes.song_chart_minute(counts), root, table, 0)
    size = sum(os.path.getsize(f"{at}/{f}") for at, _, names in os.walk(f"{root}/{table}") for f in names if f.endswith(".parquet"))
    assert size < 700_000  # a filter of the largest size takes 1 MB by itself


def test_facts_of_many_days_share_folders(spark, make_topic):
    landed_root, root = session.work_dir(spark, "spans"), session.work_dir(spark, "spans")
    session.prepare(spark)
    times = [f"{FIRST + timedelta(days=n)} 10:{n % 60:02d}:00" for n in range(DAYS)]
    for topic in schemas.STAR_TOPICS:
        landed.land_rows(make_topic(topic, [{"ts": t, "userId": i % 7} for i, t in enumerate(times)]), landed_root, topic, "one")
    end = FIRST + timedelta(days=DAYS)
    loads.full_load(spark, landed_root, root, end - timedelta(days=2), with_rollups=True)
    for day in (end - timedelta(days=2), end - timedelta(days=1), end - timedelta(days=1), end - timedelta(days=20)):
        loads.incremental_load(spark, landed_root, root, day, end, with_rollups=True)
    expected = {}
    for name in schemas.FACTS:
        assert len(warehouse.folders_of(warehouse.snapshot(spark, root), name)) <= commits.SPANS + 4
        fact = warehouse.read_fact(spark, root, name)
        assert fact.columns == schemas.FACTS[name].names
        expected[name] = rows(fact)
        assert sorted(r.date_id for r in fact.select("date_id").collect()) == [t[:10].replace("-", "") for t in times]
        for number in (0, 3, 57, DAYS - 2, DAYS - 1):
            date_id = times[number][:10].replace("-", "")
            found = warehouse.folders_of(warehouse.snapshot(spark, root), name, [date_id])
            assert 1 <= len(found) <= 2  # other spans aren't read
            assert rows(warehouse.read_fact(spark, root, name, [date_id])) == rows(fact.where(F.col("date_id") == date_id))
    star, logins = warehouse.read_star(spark, root), warehouse.read_rollup(spark, root, "rollup_logins")
    assert rows(rollups.logged_in_users(logins, star, "month")) == rows(
        analytics.logged_in_users(warehouse.read_fact(spark, root, "fact_auth"), star, "month")
    )
    merge_folders(spark, root)
    assert {n: rows(warehouse.read_fact(spark, root, n)) for n in schemas.FACTS} == expected
    catalog.register(spark, root, "mart_spans")
    for name in schemas.FACTS:
        assert rows(spark.table(f"mart_spans.{name}").select(*schemas.FACTS[name].names)) == expected[name]
        assert rows(warehouse.read_fact(spark, root, name)) == expected[name]
    spark.sql("DROP DATABASE mart_spans CASCADE")


def test_users_of_one_month_have_numbers_beside_each_other(spark):
    seen = spark.range(900).selectExpr("concat('u', id % 300) as userId", "concat('2024', lpad(1 + id % 300 div 100 + id div 300, 2, '0'), '05') as date_id")
    numbers = rollups.number_users(seen.unionByName(seen.limit(1).selectExpr("cast(null as string) as userId", "date_id")), None, 10)
    first = seen.groupBy("userId").agg(F.min(F.substring("date_id", 1, 6)).alias("month"))
    spread = numbers.join(first, "userId").groupBy("month").agg(F.min("number"), F.max("number"), F.count("*"))
    assert rows(spread) == [(f"20240{m}", 10 + 100 * (m - 1), 9 + 100 * m, 100) for m in (1, 2, 3)]
