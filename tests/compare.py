"""Run a registered query and its SQL twin and compare whole results.

Also a script: ``python tests/compare.py SF_DIR [name ...]``.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, sf_dir: str) -> tuple[list[str], int]:
    """Problems found (none if equal) and the number of rows."""
    df = contract.queries()[name](spark, sf_dir)
    mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    relation = con.sql(contract.oracle_sql()[name])
    theirs = _rows(relation.columns, relation.fetchall())
    problems = []
    if sorted(df.columns) != sorted(relation.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(relation.columns)}")
    spark_types = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                   "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
    types = {c: spark_types.get(t, t) for c, t in df.dtypes}
    duck = {c: str(t) for c, t in zip(relation.columns, relation.types, strict=True)}
    for column in types.keys() & duck.keys():
        if types[column] != duck[column]:
            problems.append(f"type of {column}: {types[column]} != {duck[column]}")
    if mine != theirs:
        problems.append(
            f"rows: {mine.total()} != {theirs.total()}; only spark {list((mine - theirs).items())[:2]}"
            f" only sql {list((theirs - mine).items())[:2]}"
        )
    return problems, mine.total()


def main() -> None:
    from eventmart import session

    spark = session.build(
        "compare",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, *names = sys.argv[1:]
    con = connect(sf_dir)
    failed = 0
    for name in names or contract.queries():
        if name not in contract.oracle_sql():
            print(f"NOSQL {name}", flush=True)
            continue
        start = time.time()
        try:
            problems, n = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            problems, n = [f"{type(error).__name__}: {str(error)[:1500]}"], -1
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok'} {name} rows={n} {time.time() - start:.2f}s", *problems, sep="\n   " if problems else " ", flush=True)
    print("failed", failed)


if __name__ == "__main__":
    main()
