"""Every registered query against its SQL twin, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import compare, connect
from eventmart.registry.oracles import all_oracles
from eventmart.registry.queries import all_queries

QUERIES = all_queries()
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    problems, count = compare(spark, con, name, sf_dir)
    assert problems == []
    assert count > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["year", "month", "day", "song_id", "plays", "title", "artist", "rank"]
    assert df.count() > 0
