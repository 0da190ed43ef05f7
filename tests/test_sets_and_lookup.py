from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventmart.operators.lookup import lookup, measure
from eventmart.operators.sets import except_distinct, union_all
from eventmart.operators.topk import top_k


def test_union_all_takes_columns_of_the_first_by_name(spark):
    first = spark.createDataFrame([(1, "a")], "id int, v string")
    second = spark.createDataFrame([("x", "b", 2)], "extra string, v string, id int")
    assert rows(union_all([first, second, first])) == [(1, "a"), (1, "a"), (2, "b")]


def test_union_all_needs_every_column(spark):
    first = spark.createDataFrame([(1, "a")], "id int, v string")
    with pytest.raises(Exception, match="v"):
        union_all([first, first.select("id")]).collect()


def test_except_distinct_is_null_safe_and_distinct(spark):
    left = spark.createDataFrame(
        [(1, None), (1, None), (2, "a"), (2, "a")], "id int, v string"
    )
    right = spark.createDataFrame([(1, None)], "id int, v string")
    assert rows(except_distinct(left, right)) == [(2, "a")]
    assert rows(except_distinct(left, right)) == rows(left.subtract(right))


def test_except_distinct_of_generated_rows(spark):
    left = spark.range(5000).selectExpr("id % 97 as a", "if(id % 5 = 0, null, id % 13) as b")
    right = spark.range(900).selectExpr("id % 50 as a", "if(id % 7 = 0, null, id % 13) as b")
    assert rows(except_distinct(left, right)) == rows(left.subtract(right))


def _hot_events(spark):
    """A third of all rows on one key, some of them equal."""
    return spark.range(3000).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id % 40 as string)) as k", "id % 900 as v"
    )


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "salts": 1}])
def test_lookup_keeps_every_match_however_it_is_joined(spark, options):
    events = _hot_events(spark)
    members = spark.createDataFrame(
        [("hot", "H"), ("1", "one"), ("1", "uno"), (None, "null"), ("none", "N")],
        "name string, label string",
    )
    got = Counter(rows(lookup(events, members, {"k": "name"}, ["label"], **options)))
    labels = {"hot": ["H"], "1": ["one", "uno"]}
    want = Counter(
        (r.k, r.v, label) for r in events.collect() for label in labels.get(r.k, [])
    )
    assert got == want


def test_lookup_drops_missing_keys_and_matches_signed_zero(spark):
    events = spark.createDataFrame([(0.0,), (-0.0,), (None,), (1.0,)], "x double")
    members = spark.createDataFrame([(0.0, "zero")], "x double, label string")
    for bound in (0, 1000):
        got = lookup(events, members, {"x": "x"}, ["label"], broadcast_bytes=bound)
        assert [r.label for r in got.collect()] == ["zero", "zero"]


def test_lookup_salts_must_be_a_power_of_two(spark):
    with pytest.raises(ValueError, match="power of two"):
        lookup(spark.range(1), spark.range(1), {"id": "id"}, [], salts=6)


def test_lookup_measures_before_it_broadcasts(spark):
    events, members = _hot_events(spark), spark.range(100).selectExpr("cast(id as string) as k")
    small = lookup(events, members, {"k": "k"}, [])
    large = lookup(events, members, {"k": "k"}, [], broadcast_bytes=measure(members) - 1)
    assert "ResolvedHint (strategy=broadcast)" in _logical(small)
    assert "strategy=broadcast" not in _logical(large)
    long = members.withColumn("text", F.repeat(F.lit("x"), 1000))
    assert measure(long) >= 100 * 1000


@pytest.mark.parametrize("salts", [1, 16])
def test_lookup_beyond_the_limit_is_never_broadcast(spark, tmp_path, salts):
    """Stored members have small files, by which Spark would take them for small."""
    spark.range(5000).selectExpr("cast(id as string) as k", "id % 7 as label").write.parquet(f"{tmp_path}/members")
    members = spark.read.parquet(f"{tmp_path}/members")
    got = lookup(_hot_events(spark), members, {"k": "k"}, ["label"], broadcast_bytes=0, salts=salts)
    assert len(got.collect()) == 2000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def _logical(df):
    return df._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("k", [1, 7, 1500])
@pytest.mark.parametrize("by", [["g"], []])
def test_top_k_equals_brute_force(spark, k, by):
    df = spark.range(4000).selectExpr("if(id % 3 = 0, 0, id % 5) as g", "id * 7919 % 301 as n", "id")
    order = [F.desc("n"), F.asc("id")]
    want = []
    groups = {}
    for r in sorted(df.collect(), key=lambda r: (-r.n, r.id)):
        group = groups.setdefault(r.g if by else None, [])
        if len(group) < k:
            group.append(r)
            want.append((r.g, r.n, r.id, len(group)))
    assert rows(top_k(df, by, order, k)) == sorted(want, key=repr)


def test_top_k_limits_groups_before_the_shuffle(spark):
    df = spark.range(4000).selectExpr("id % 5 as g", "id * 7919 % 301 as n", "id")
    plan = top_k(df, ["g"], [F.desc("n"), F.asc("id")], 3)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("WindowGroupLimit") == 4 and "Partial" in text
