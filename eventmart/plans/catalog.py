"""SQL tables over the warehouse and the serving folders."""

from __future__ import annotations

from pyspark.sql import SparkSession

from eventmart import schemas
from eventmart.plans.tables import merge_folders
from eventmart.sources.warehouse import folders_of, snapshot, table_path
from eventmart.streaming.sinks import latest_by_key

DATABASE = "eventmart"
ROOT = "warehouse_root"


def _quoted(path: str) -> str:
    """A path as a SQL text literal."""
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_ddl(database: str, root: str, name: str, location: str | None = None) -> str:
    """CREATE TABLE for a dimension or a fact, from the schema it is written with."""
    schema = schemas.DIMENSIONS.get(name) or schemas.FACTS[name]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitioned = "PARTITIONED BY (date_id)" if name in schemas.FACTS else ""
    return (
        f"CREATE TABLE {database}.{name} ({columns}) USING parquet {partitioned} "
        f"LOCATION {_quoted(location or table_path(root, name))} TBLPROPERTIES ('{ROOT}' = {_quoted(root)})"
    )


def register(spark: SparkSession, root: str, database: str = DATABASE) -> list[str]:
    """Create the database and its eight external tables; returns their names.

    Tables registered before, perhaps of another folder, are made anew: they are
    external, so only their entries go. The tables show what was published when they
    were registered, so run ``refresh`` after a load.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION {_quoted(root)}")
    for name in (*schemas.DIMENSIONS, *schemas.FACTS):
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(table_ddl(database, root, name))
    refresh(spark, database)
    return [f"{database}.{name}" for name in (*schemas.DIMENSIONS, *schemas.FACTS)]


def refresh(spark: SparkSession, database: str = DATABASE) -> None:
    """Follow the published loads: dimensions to their folder, facts to theirs by day.

    What several loads added to is merged first, as a table or a partition has one place,
    and facts kept by spans of days get a folder per day, which is a partition.
    """
    (name, *_) = schemas.DIMENSIONS
    root = spark.sql(f"SHOW TBLPROPERTIES {database}.{name} ('{ROOT}')").first()["value"].rstrip("/")
    merge_folders(spark, root, by_day=True)
    found = snapshot(spark, root)
    for name in schemas.DIMENSIONS:
        for folder in folders_of(found, name):
            spark.sql(f"ALTER TABLE {database}.{name} SET LOCATION {_quoted(f'{root}/{folder}')}")
        spark.sql(f"REFRESH TABLE {database}.{name}")
    for name in schemas.FACTS:
        table, places = f"{database}.{name}", {found.folders[f]["date_id"]: f for f in folders_of(found, name)}
        known = {row[0].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        part = lambda day: f"PARTITION (date_id = {_quoted(day)})"
        if gone := sorted(known - set(places)):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(map(part, gone)))
        if new := sorted(set(places) - known):
            each = " ".join(f"{part(d)} LOCATION {_quoted(f'{root}/{places[d]}')}" for d in new)
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {each}")
        for day in sorted(known & set(places)):
            spark.sql(f"ALTER TABLE {table} {part(day)} SET LOCATION {_quoted(f'{root}/{places[day]}')}")
        spark.sql(f"REFRESH TABLE {table}")


def register_serving(spark: SparkSession, serving_root: str) -> list[str]:
    """A temporary view per serving table with the last row of every key."""
    for table in schemas.SERVING:
        latest_by_key(spark, serving_root, table).createOrReplaceTempView(table)
    return list(schemas.SERVING)
