from __future__ import annotations

import os
from datetime import date, timedelta

import pytest

from conftest import rows
from eventmart import schemas, session
from eventmart.plans import catalog, loads
from eventmart.plans.tables import land, merge_folders, write_table
from eventmart.sources import commits, landed, sample, warehouse

LAST = date(2024, 1, 30)
AFTER = LAST + timedelta(days=1)


@pytest.fixture(scope="module")
def landed_root(spark, sf_dir):
    session.prepare(spark)
    root = session.work_dir(spark, "landed")
    for topic in schemas.STAR_TOPICS:
        land(sample.topic(spark, sf_dir, topic), root, topic)
    return root


def full(spark, landed_root, as_of, user_match):
    root = session.work_dir(spark, "warehouse")
    loads.full_load(spark, landed_root, root, as_of, user_match)
    return root


def contents(spark, root):
    tables = {n: warehouse.read_dim(spark, root, n) for n in schemas.DIMENSIONS if n != "dim_time"}
    tables |= {n: warehouse.read_fact(spark, root, n) for n in schemas.FACTS}
    return {name: rows(df) for name, df in tables.items()}


@pytest.fixture(scope="module")
def grown(spark, landed_root):
    """Loaded up to the day before last, then the last day added."""
    root = full(spark, landed_root, LAST, "version")
    loads.incremental_load(spark, landed_root, root, LAST, AFTER, "version")
    return root


def test_incremental_after_full_equals_full(spark, landed_root, grown):
    want = contents(spark, full(spark, landed_root, AFTER, "version"))
    got = contents(spark, grown)
    assert {n: set(r) for n, r in got.items()} == {n: set(r) for n, r in want.items()}
    for name in ("dim_date", "dim_song", "dim_user", "dim_location"):
        assert len(got[name]) == len(set(got[name])), name


def test_second_incremental_run_changes_nothing(spark, landed_root, grown):
    before = contents(spark, grown)
    loads.incremental_load(spark, landed_root, grown, LAST, AFTER, "version")
    assert contents(spark, grown) == before


def test_failed_load_can_be_repeated(spark, landed_root):
    """A run that died between dimensions and facts is completed by the next."""
    root = full(spark, landed_root, LAST, "version")
    activity = loads._activity(
        lambda t: landed.landed_day(spark, landed_root, t, LAST), ("0", "1")
    )
    for name in loads._DIMENSIONS:
        stored = warehouse.read_dim(spark, root, name)
        write_table(loads.dims.new_members(name, activity, stored), root, name, "append")
    loads.incremental_load(spark, landed_root, root, LAST, AFTER, "version")
    want = contents(spark, full(spark, landed_root, AFTER, "version"))
    got = contents(spark, root)
    assert {n: set(r) for n, r in got.items()} == {n: set(r) for n, r in want.items()}


def test_id_match_keeps_copies_in_full_and_collapses_them_in_incremental(spark, landed_root):
    root = full(spark, landed_root, LAST, "id")
    loads.incremental_load(spark, landed_root, root, LAST, AFTER, "id")
    fact = warehouse.read_fact(spark, root, "fact_listen")
    last_day = fact.where("date_id = '20240130'")
    earlier = fact.where("date_id < '20240130'")
    assert last_day.count() == last_day.distinct().count()
    assert earlier.count() > earlier.distinct().count()


def test_incremental_day_must_be_over(spark, landed_root, grown):
    with pytest.raises(ValueError, match="not complete"):
        loads.incremental_load(spark, landed_root, grown, LAST, LAST)


def test_absent_day_adds_nothing(spark, landed_root, grown):
    before = contents(spark, grown)
    day = AFTER + timedelta(days=5)
    loads.incremental_load(spark, landed_root, grown, day, day + timedelta(days=1), "version")
    assert contents(spark, grown) == before


def test_rows_without_time_are_not_loaded(spark, make_topic):
    root = session.work_dir(spark, "landed")
    for topic in schemas.STAR_TOPICS:
        land(make_topic(topic, [dict(), dict(ts=None)]), root, topic)
    assert landed.landed(spark, root, "listen_events").count() == 2
    out = full(spark, root, date(2025, 1, 1), "version")
    assert warehouse.read_fact(spark, out, "fact_listen").count() == 1


def test_a_wrong_root_leaves_the_warehouse_whole(spark, landed_root, tmp_path):
    root = full(spark, landed_root, LAST, "version")
    before = contents(spark, root)
    with pytest.raises(FileNotFoundError):
        loads.full_load(spark, str(tmp_path / "nowhere"), root, LAST)
    assert contents(spark, root) == before
    with pytest.raises(FileNotFoundError):
        loads.incremental_load(spark, landed_root, str(tmp_path / "no_dims"), LAST, AFTER)


def test_a_load_that_fails_half_way_leaves_the_warehouse_whole(spark, landed_root, monkeypatch):
    root = full(spark, landed_root, LAST, "version")
    before = contents(spark, root)

    def fail(*_, **__):
        raise RuntimeError("half way")

    monkeypatch.setattr(loads.facts, "fact", fail)
    with pytest.raises(RuntimeError, match="half way"):
        loads.full_load(spark, landed_root, root, AFTER)
    assert contents(spark, root) == before
    parent, name = root.rsplit("/", 1)
    assert [f for f in os.listdir(parent) if f.startswith(name)] == [name]


def test_readers_keep_to_one_load(spark, landed_root, monkeypatch):
    """What was read before a load stays readable, and no reader sees half of one."""
    root = full(spark, landed_root, LAST, "version")
    seen = warehouse.snapshot(spark, root)
    old = {n: warehouse.read_dim(spark, root, n, seen) for n in schemas.DIMENSIONS}
    old |= {n: warehouse.read_fact(spark, root, n, None, seen) for n in schemas.FACTS}
    before = {n: rows(df) for n, df in old.items()}
    stage = loads.stage_table

    def look(*args, **options):
        found = stage(*args, **options)
        assert warehouse.snapshot(spark, root) == seen  # nothing shows while it is written
        return found

    monkeypatch.setattr(loads, "stage_table", look)
    loads.incremental_load(spark, landed_root, root, LAST, AFTER)
    monkeypatch.undo()
    loads.full_load(spark, landed_root, root, AFTER)
    merge_folders(spark, root)
    assert {n: rows(df) for n, df in old.items()} == before
    assert commits.vacuum(spark, root, 0) and contents(spark, root) == contents(spark, full(spark, landed_root, AFTER, "version"))


def test_two_loads_at_once_publish_one(spark, landed_root, monkeypatch):
    root = full(spark, landed_root, LAST, "version")
    fact = loads.facts.fact

    def meanwhile(name, *args, **options):
        if name == "fact_listen":
            commits.commit(spark, root, lambda now: {"remove": [next(iter(now.folders))]})
        return fact(name, *args, **options)

    monkeypatch.setattr(loads.facts, "fact", meanwhile)
    with pytest.raises(RuntimeError, match="meanwhile"):
        loads.incremental_load(spark, landed_root, root, LAST, AFTER)


def test_equal_events_are_loaded_alike_by_both_loads(spark, make_topic):
    root = session.work_dir(spark, "landed")
    for topic in schemas.STAR_TOPICS:
        days = [dict(ts=f"2024-01-0{d} 10:00:00") for d in (1, 2, 2)]
        land(make_topic(topic, days), root, topic)
    grown = session.work_dir(spark, "warehouse")
    loads.full_load(spark, root, grown, date(2024, 1, 2))
    for _ in range(2):
        loads.incremental_load(spark, root, grown, date(2024, 1, 2), date(2024, 1, 3))
    whole = session.work_dir(spark, "warehouse")
    loads.full_load(spark, root, whole, date(2024, 1, 3))
    assert contents(spark, grown) == contents(spark, whole)
    assert warehouse.read_fact(spark, grown, "fact_listen").count() == 3


def test_landed_scan_modes(spark, landed_root):
    whole = landed.extract(spark, landed_root, "auth_events", "full")
    assert whole.columns[-1] == "date"
    day = landed.extract(spark, landed_root, "auth_events", "incremental", LAST)
    assert 0 < day.count() < whole.count()
    assert rows(day.select("date").distinct()) == [(LAST,)]
    with pytest.raises(ValueError, match="mode"):
        landed.extract(spark, landed_root, "auth_events", "sometimes")
    with pytest.raises(ValueError, match="day"):
        landed.extract(spark, landed_root, "auth_events", "incremental")
    with pytest.raises(FileNotFoundError):
        landed.extract(spark, landed_root + "/none", "auth_events", "full")
    absent = landed.extract(spark, landed_root, "auth_events", "incremental", AFTER)
    assert absent.count() == 0 and absent.schema == whole.schema


def test_stored_facts_keep_text_keys(spark, grown):
    fact = warehouse.read_fact(spark, grown, "fact_page_view", ["20240101", "20240130"])
    assert dict(fact.dtypes)["date_id"] == "string" and dict(fact.dtypes)["status"] == "string"
    assert rows(fact.select("date_id").distinct()) == [("20240101",), ("20240130",)]
    assert warehouse.read_fact(spark, grown, "fact_page_view", []).count() == 0


def test_write_mode_is_checked(spark, tmp_path):
    with pytest.raises(ValueError, match="mode"):
        write_table(spark.range(1), str(tmp_path), "t", "ignore")


def test_catalog_tables_answer_sql_and_follow_loads(spark, landed_root):
    root = full(spark, landed_root, LAST, "version")
    names = catalog.register(spark, root, "mart_test")
    assert len(names) == 8
    count = "SELECT count(*) FROM mart_test.fact_listen f JOIN mart_test.dim_date d USING (date_id)"
    before = spark.sql(count).first()[0]
    assert before == warehouse.read_fact(spark, root, "fact_listen").count()
    loads.incremental_load(spark, landed_root, root, LAST, AFTER, "version")
    catalog.refresh(spark, "mart_test")
    assert spark.sql(count).first()[0] == warehouse.read_fact(spark, root, "fact_listen").count()
    assert spark.sql(count).first()[0] > before
    for name in [*schemas.DIMENSIONS, *schemas.FACTS]:
        declared = dict(spark.table(f"mart_test.{name}").dtypes)
        schema = schemas.DIMENSIONS.get(name) or schemas.FACTS[name]
        assert declared == {f.name: f.dataType.simpleString() for f in schema.fields}, name


def test_catalog_follows_another_root_and_shorter_loads(spark, landed_root):
    first, count = full(spark, landed_root, AFTER, "version"), "SELECT count(*) FROM mart_two.fact_auth"
    catalog.register(spark, first, "mart_two")
    days = spark.sql("SHOW PARTITIONS mart_two.fact_auth").count()
    loads.full_load(spark, landed_root, first, date(2024, 1, 10))
    catalog.refresh(spark, "mart_two")
    assert spark.sql("SHOW PARTITIONS mart_two.fact_auth").count() == 9 < days
    assert spark.sql(count).first()[0] == warehouse.read_fact(spark, first, "fact_auth").count()
    second = full(spark, landed_root, date(2024, 1, 20), "version") + "/it's"
    loads.full_load(spark, landed_root, second, date(2024, 1, 20))
    catalog.register(spark, second, "mart_two")
    assert spark.sql(count).first()[0] == warehouse.read_fact(spark, second, "fact_auth").count()


def test_serving_views(spark, tmp_path):
    assert catalog.register_serving(spark, str(tmp_path)) == list(schemas.SERVING)
    assert spark.sql("SELECT * FROM song_chart_minute").count() == 0


class _Session:
    """Just the parts of a session the choice of folder looks at."""

    def __init__(self, master, base=None):
        self.conf = {} if base is None else {"spark.checkpoint.dir": base}
        self.sparkContext = self
        self.master, self.applicationId = master, f"app-{master}"


def test_work_dir_follows_the_session_setting():
    cluster = _Session("yarn", "hdfs://shared/folder/")
    first, second = session.work_dir(cluster, "x"), session.work_dir(cluster, "x")
    assert first.startswith("hdfs://shared/folder/x-") and first != second


def test_work_dir_is_local_only_on_a_local_master():
    local = _Session("local[2]")
    assert session.work_dir(local, "a").rsplit("/", 1)[0] == session.work_dir(local, "b").rsplit("/", 1)[0]
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_dir(_Session("spark://host:7077"), "a")
