"""Connected components of a graph given as pairs, by repeated contraction.

In a round every node takes the label of the node with the least hash among
itself and its neighbours; the graph of the labels, with far fewer nodes, is the
next round's. The hash changes with the round, so long chains shrink by a share
each time too. When no edge is left, the labels of the rounds are put together.
A hub is one row per task in the minimum, and a partition Spark may split in the
joins. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import stored


def _simple(a: Column, b: Column, pairs: DataFrame) -> DataFrame:
    """Edges without loops, directions and repeats."""
    return (
        pairs.where(a != b)
        .select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .distinct()
    )


def components(pairs: DataFrame) -> DataFrame:
    """(node, component) for every node of ``pairs`` (columns a, b of one type).

    ``component`` is some node of the component, the same for all its nodes.
    Repeated pairs and pairs of a node with itself do no harm; an empty table
    gives no rows.
    """
    edges = stored(_simple(F.col("a"), F.col("b"), pairs), "edges")
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    turn = 0
    while not edges.isEmpty():
        ranked = lambda node: F.struct(F.xxhash64(F.lit(turn), node).alias("rank"), node.alias("node"))  # noqa: B023, E731
        near = edges.select("a", "b").union(edges.select("b", "a"))
        least = near.groupBy("a").agg(F.min(ranked(F.col("b"))).alias("near"))
        label = stored(
            least.select(
                F.col("a").alias("node"), F.least("near", ranked(F.col("a")))["node"].alias("label")
            ),
            "labels",
        )
        of_a = label.select(F.col("node").alias("a"), F.col("label").alias("la"))
        of_b = label.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        if turn == 0:
            labels = label.select("node", F.col("label").alias("component"))
        else:
            later = label.select(F.col("node").alias("component"), "label")
            labels = stored(
                labels.join(later, "component", "left").select(
                    "node", F.coalesce("label", "component").alias("component")
                ),
                "labels",
            )
        edges = stored(_simple(F.col("la"), F.col("lb"), edges.join(of_a, "a").join(of_b, "b")), "edges")
        turn += 1
    return labels
