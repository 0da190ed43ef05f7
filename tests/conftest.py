from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventmart import schemas, session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    spark = session.build(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def full_row(topic: str, **values):
    """An event of ``topic`` with every attribute set; ``values`` override."""
    defaults = {
        "artist": "A",
        "song": "S",
        "duration": 1.5,
        "ts": "2024-01-02 03:04:05",
        "sessionId": 1,
        "page": "Home",
        "auth": "Logged In",
        "method": "GET",
        "status": 200,
        "level": "free",
        "itemInSession": 1,
        "city": "C",
        "zip": "1",
        "state": "ST",
        "userAgent": "ua",
        "lon": 1.0,
        "lat": 2.0,
        "userId": 7,
        "lastName": "L",
        "firstName": "F",
        "gender": "M",
        "registration": "2023-01-01 00:00:00",
        "success": True,
    }
    row = {**defaults, **values}
    return [row[c] for c in schemas.TOPIC_COLUMNS[topic]]


@pytest.fixture(scope="session")
def make_topic(spark):
    """Build a landed topic from a list of overrides, times as text."""

    def build(topic, overrides):
        columns = schemas.TOPIC_COLUMNS[topic]
        kinds = {c: schemas.EVENT_TYPES[c].simpleString() for c in columns}
        ddl = ", ".join(
            f"{c} {'string' if k == 'timestamp' else k}" for c, k in kinds.items()
        )
        rows = [full_row(topic, **values) for values in overrides]
        df = spark.createDataFrame(rows, ddl)
        return df.selectExpr(*[f"cast({c} as {k}) as {c}" for c, k in kinds.items()])

    return build


def rows(df):
    """All rows in a canonical order, duplicates kept."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
