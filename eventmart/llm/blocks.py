"""Work on all pairs of a group without ever holding or emitting the group.

A group's members are dealt to blocks of about ``size`` by a hash; each pair of
blocks is a unit of its own that a task compares in memory. A group that holds a
third of all rows becomes many units on many tasks, each bounded by two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def block_units(members: DataFrame, group: str, member: str, size: int, weight: str = "1") -> DataFrame:
    """One row per member and unit: the members' columns with ``unit`` (long) and
    ``side`` (0: first block, 1: second, 2: a unit of one block against itself).
    ``size`` bounds a block's expected sum of ``weight`` (members by default)."""
    counts = members.groupBy(group).agg(F.sum(F.expr(weight)).alias("_n"), F.count(F.lit(1)).alias("_many"))
    counts = counts.where("_many > 1").drop("_many")
    blocks = F.ceil(F.col("_n") / F.lit(size)).cast("int")
    dealt = members.join(counts, group).withColumn("_blocks", blocks)
    own = F.pmod(F.xxhash64(F.lit("block"), member), F.col("_blocks")).cast("int")
    dealt = dealt.withColumn("_own", own).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    )
    first, second = F.least("_own", "_other"), F.greatest("_own", "_other")
    side = F.when(F.col("_own") == F.col("_other"), 2).when(F.col("_own") < F.col("_other"), 0).otherwise(1)
    # A unit of one block appears once per member; units of two blocks get both.
    return dealt.select(
        *[c for c in members.columns],
        F.xxhash64(F.col(group), first, second).alias("unit"),
        side.cast("int").alias("side"),
    )


def units_together(units: DataFrame) -> DataFrame:
    """Rows of one unit next to each other in one partition."""
    n = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return units.repartition(n, "unit").sortWithinPartitions("unit")


def each_unit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The frames of single units out of sorted batches."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        unit = batch["unit"].to_numpy()
        cuts = np.flatnonzero(unit[1:] != unit[:-1]) + 1
        edges = [0, *cuts.tolist(), len(batch)]
        for start, end in zip(edges, edges[1:], strict=False):
            part = batch.iloc[start:end]
            if held and held[0]["unit"].iloc[0] != part["unit"].iloc[0]:
                yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
                held = []
            held.append(part)
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
