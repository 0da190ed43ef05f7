"""Union and difference of frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL with the first frame's columns, matched by name.

    Columns only later frames have are dropped; a column one of them lacks is an
    error.
    """
    columns = frames[0].columns
    return reduce(
        lambda left, right: left.unionByName(right.select(*columns)), frames
    )


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """EXCEPT DISTINCT: the distinct rows of ``left`` that ``right`` does not hold.

    One grouping over both sides instead of a distinct above a null-safe anti
    join: a single shuffle, NULLs equal NULLs, and equal rows collapse before
    the shuffle, so a row with very many copies never meets in one task.
    """
    columns = left.columns
    marked = left.withColumn("_stored", F.lit(False)).unionByName(
        right.select(*columns).withColumn("_stored", F.lit(True))
    )
    return (
        marked.groupBy(*columns)
        .agg(F.max("_stored").alias("_stored"))
        .where(~F.col("_stored"))
        .drop("_stored")
    )
