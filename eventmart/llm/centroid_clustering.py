"""K-means in whole numbers with an equal-average equal-variance nearest search.

Components are scaled and floored to integers, so that sums, centroids and distances
are exact. Centroids lie sorted by their component mean. A vector scans outward from
its own mean, always to the nearer side; with ``n`` components a centroid is left out
where

* ``n * (difference of means)**2`` exceeds the best squared distance so far: all
  centroids beyond it are left out as well;
* that plus ``(difference of deviations)**2`` exceeds it, where a deviation is the
  norm of a vector less its mean.

Both are lower bounds of the squared distance. They are taken in floating point with
a margin, so that rounding never leaves out a nearest centroid; what is left is
finished by the exact integer distance, ties going to the smaller number.

A round is one scan: tasks add up the vectors of each cluster and send one row per
cluster, Spark sums those, and the driver holds ``k`` centroids only. A cluster with
a third of all rows is one row per task as well.

Defined results: vectors that are null, of another length or hold null or non-finite
components are left out. A component whose integer exceeds the largest that keeps
squared distances within a long counts as that largest. Fewer vectors than ``k`` give
fewer centroids; ties of the seeds' hashes (repeated ids) go to the componentwise
smaller vector; a null id is hashed as an empty text. An empty table gives no rows.
The input's columns come back with two new ones under free names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import free_name, workers_import

MARGIN = 1e-9


def largest_component(n: int) -> int:
    """The largest integer whose squared distances over ``n`` components fit a long."""
    return isqrt((2**63 - 1) // max(n, 1)) // 2


def whole_vectors(vectors: DataFrame, vec_col: str, n: int, scale: int) -> tuple[DataFrame, str]:
    """The rows with ``n`` finite components and the name of their integer column."""
    vec = F.col(vec_col)
    finite = F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    most = float(largest_component(n))
    number = lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-most)), F.lit(most)))
    name = free_name(vectors, "whole")
    kept = vectors.where(vec.isNotNull() & (F.size(vec) == n) & finite)
    return kept.withColumn(name, F.transform(vec, number)), name


@dataclass
class Centroids:
    """Centroids in order of their mean, with what the two inequalities need."""

    rows: np.ndarray

    def __post_init__(self):
        self.n = self.rows.shape[1]
        mean = self.rows.mean(axis=1)
        self.number = np.lexsort((np.arange(len(mean)), mean))
        self.sorted = self.rows[self.number]
        self.mean = mean[self.number]
        self.deviation = np.sqrt(((self.sorted - self.mean[:, None]) ** 2).sum(axis=1))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of and squared distance to the nearest centroid of each row."""
        k, many = len(self.mean), len(x)
        mean = x.mean(axis=1)
        deviation = np.sqrt(((x - mean[:, None]) ** 2).sum(axis=1))
        right = np.searchsorted(self.mean, mean)
        left = right - 1
        best = np.full(many, np.iinfo(np.int64).max)
        number = np.full(many, k)
        rows = np.arange(many)
        for _ in range(k):
            gap_left = np.where(left[rows] >= 0, mean[rows] - self.mean[np.maximum(left[rows], 0)], np.inf)
            gap_right = np.where(right[rows] < k, self.mean[np.minimum(right[rows], k - 1)] - mean[rows], np.inf)
            to_left = gap_left <= gap_right
            at = np.where(to_left, left[rows], right[rows])
            left[rows[to_left]] -= 1
            right[rows[~to_left]] += 1
            by_mean = self.n * np.where(to_left, gap_left, gap_right) ** 2
            limit = best[rows].astype(float)
            size = deviation[rows] ** 2 + self.deviation[at] ** 2 + self.n * (mean[rows] ** 2 + self.mean[at] ** 2)
            limit += MARGIN * (limit + size) + 1
            open_ = by_mean <= limit
            rows, at, by_mean, limit = rows[open_], at[open_], by_mean[open_], limit[open_]
            if not len(rows):
                break
            near = by_mean + (deviation[rows] - self.deviation[at]) ** 2 <= limit
            few, at = rows[near], at[near]
            exact = ((x[few] - self.sorted[at]) ** 2).sum(axis=1)
            own = self.number[at]
            better = (exact < best[few]) | ((exact == best[few]) & (own < number[few]))
            best[few[better]] = exact[better]
            number[few[better]] = own[better]
        return number, best


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, n)


def _sums(centroids: Centroids):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, n = centroids.rows.shape
        count, total = np.zeros(k, np.int64), np.zeros((k, n), object)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0), n)
            number, _ = centroids.nearest(x)
            order = np.argsort(number, kind="stable")
            have, first = np.unique(number[order], return_index=True)
            # A batch's sums fit: components stay below 2**31, rows of a batch too.
            total[have] += np.add.reduceat(x[order], first, axis=0).astype(object)
            count[have] += np.diff(np.append(first, len(order)))
        have = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict(
            {
                "cluster": np.repeat(have, n).astype(np.int32),
                "place": np.tile(np.arange(n, dtype=np.int32), len(have)),
                "count": np.repeat(count[have], n),
                "total": pa.array([str(v) for v in total[have].ravel()], pa.string()),
            },
            schema=pa.schema([("cluster", pa.int32()), ("place", pa.int32()), ("count", pa.int64()), ("total", pa.string())]),
        )

    return sums


def _with_nearest(centroids: Centroids, whole: str):
    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(whole)
            x = _matrix(batch.column(at), centroids.rows.shape[1])
            number, best = centroids.nearest(x) if len(x) else (np.zeros(0, int), np.zeros(0, int))
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [c for i, c in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(number, pa.int32()), pa.array(best, pa.int64())], [*names, "_c", "_d"]
            )

    return nearest


def _seeds(whole: DataFrame, name: str, id_col: str, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the least SHA-256 of ``seed:id``; only they reach the driver."""
    ident = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = whole.select(F.sha2(ident, 256).alias("h"), F.col(name).alias("v")).orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64).reshape(len(rows), len(rows[0].v) if rows else 0)


def _moved(whole: DataFrame, name: str, rows: np.ndarray) -> np.ndarray:
    """Centroids after one round: exact floored means; empty ones stay."""
    parts = whole.select(name).mapInArrow(_sums(Centroids(rows)), "cluster int, place int, count long, total string")
    exact = "decimal(38,0)"
    found = parts.groupBy("cluster", "place").agg(
        F.sum(F.col("count").cast(exact)).alias("n"), F.sum(F.col("total").cast(exact)).alias("s")
    )
    rows = rows.copy()
    for r in found.collect():  # k centroids times their components
        rows[r.cluster, r.place] = int(r.s) // int(r.n)
    return rows


def cluster_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    components: int = 64,
    scale: int = 64,
    k: int = 16,
    rounds: int = 3,
    seed: int = 1,
    cluster: str = "cluster",
    distance: str = "distance",
) -> tuple[DataFrame, np.ndarray]:
    """The kept rows with their cluster and squared distance, and the centroids."""
    workers_import(vectors.sparkSession)
    whole, name = whole_vectors(vectors, vec_col, components, scale)
    rows = _seeds(whole, name, id_col, k, seed)
    cluster, distance = free_name(vectors, cluster), free_name(vectors, distance)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema.fields)
    schema = f"{fields}, `{cluster}` int, `{distance}` long"
    if not len(rows):
        return vectors.limit(0).select("*", F.lit(0).alias(cluster), F.lit(0).cast("long").alias(distance)), rows
    for _ in range(rounds):
        rows = _moved(whole, name, rows)
    return whole.mapInArrow(_with_nearest(Centroids(rows), name), schema), rows


def centroid_digests(rows: np.ndarray) -> list[str]:
    return [hashlib.sha256(",".join(map(str, r)).encode()).hexdigest() for r in rows.tolist()]


def by_cluster(values: list, kind: str, cluster: str | Column = "cluster") -> Column:
    """The cluster's entry of a list with one value per centroid."""
    return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), cluster)
