"""The first k rows of every group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_PIECES = 64


def _first(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    window = W.partitionBy(*by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """Add ``rank`` (1 is first in ``order``) and keep ranks up to ``k`` per group.

    Two ranked passes, the first over hashed pieces of each group, so a group with
    a third of all rows is ranked by many tasks and arrives at the second pass as
    k rows per piece, for any k. Without groups it is a sort with a limit, which
    keeps k rows per task as well.
    """
    if not by:
        return _first(df.orderBy(*order).limit(k), [], order, k)
    piece = F.pmod(F.xxhash64(*df.columns), F.lit(_PIECES))
    firsts = _first(df.withColumn("_piece", piece), [*by, "_piece"], order, k)
    return _first(firsts.drop("rank", "_piece"), by, order, k)
