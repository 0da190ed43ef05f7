"""Small helpers the operators share: columns, words, shared tables, workers."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.session import work_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as make it new to ``df``."""
    while name in df.columns:
        name = f"_{name}"
    return name


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else.

    ``lower`` on text of ASCII only is that already and much faster than
    ``translate``, which looks at one character at a time.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


MARK_ROWS, MARK_BITS = 1 << 20, 64


def _marked_at(hashed: Column) -> tuple[Column, Column]:
    """Row and bit that stand for a hash."""
    bit = F.pmod(F.shiftright(hashed, 32), F.lit(MARK_BITS)).cast("int")
    row = F.pmod(hashed, F.lit(MARK_ROWS)).cast("int")
    return row, F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)


def maybe_among(df: DataFrame, hashed: Column, others: DataFrame, other_column: str, result: str) -> DataFrame:
    """``df`` with ``result``: false for rows whose hash (BIGINT) ``others`` surely hasn't.
    The hashes are bits of at most ``MARK_ROWS`` rows, broadcast whatever the tables'
    size, so that rows that a join would find nothing for needn't be moved."""
    row, bit = _marked_at(F.col(other_column))
    marks = others.groupBy(row.alias("_mark_row")).agg(F.bit_or(bit).alias("_mark_bits"))
    row, bit = _marked_at(hashed)
    near = df.join(F.broadcast(marks), row == marks["_mark_row"], "left")
    found = F.coalesce(marks["_mark_bits"].bitwiseAND(bit) != 0, F.lit(False))
    return near.select(*[df[c] for c in df.columns], found.alias(result))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, so
    that lost executors cost no more than the reading of a file."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
