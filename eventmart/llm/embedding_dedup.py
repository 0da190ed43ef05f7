"""Embedding near-dedup by lattice hashing.

Vectors of one label are compared. A vector's unit direction is projected to
eight dimensions by a random matrix, once per table, and decoded to the nearest
point of the E8 lattice, its cell. Besides its own cell a vector also goes to
its ``probes`` nearest neighbouring cells of every table: the lattice has 240
shortest steps, and those that lead towards the vector are taken. Vectors that
share a cell are compared block by block on 8-bit copies, whose error is bounded,
so no pair above the threshold is lost there; what passes is confirmed by the
cosine of the vectors in double precision.

Equal vectors of one label are one class from the start, so copies cost nothing;
a full cell is compared in units of two bounded blocks, on many tasks. Links
between different vectors come out once each.

Recall depends on ``tables``, ``probes`` and ``cell``: tests measure it against
brute force.

Defined results: a vector links with nothing if its label is null or the vector
is null, empty, zero or has a null, NaN or infinite component; vectors of
different lengths are not compared. Repeated rows are vectors of their own.
``kept`` is ``vec_id = component_id``; null ids rank last. An empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.blocks import block_units, each_unit, units_together
from eventmart.llm.common import stored, workers_import
from eventmart.llm.components import components

THRESHOLD = 0.93
TABLES, PROBES, CELL = 8, 2, 0.8
BLOCK = 512
SEED = 20_240


def shortest_steps() -> np.ndarray:
    """The 240 shortest vectors of E8: two units, or eight halves of even sign."""
    steps = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            steps.append(v)
    for signs in product((0.5, -0.5), repeat=8):
        if sum(s < 0 for s in signs) % 2 == 0:
            steps.append(np.array(signs))
    return np.array(steps)


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest whole points with an even sum."""
    r = np.rint(x)
    odd = np.flatnonzero(r.sum(axis=1) % 2 != 0)
    error = x[odd] - r[odd]
    worst = np.abs(error).argmax(axis=1)
    at = np.arange(len(odd))
    r[odd, worst] += np.where(error[at, worst] >= 0, 1.0, -1.0)
    return r


def nearest_point(x: np.ndarray) -> np.ndarray:
    """The nearest E8 points of rows of eight numbers."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    nearer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.where(nearer[:, None], half, whole)


def projections(size: int, tables: int) -> np.ndarray:
    rng = np.random.default_rng([SEED, size])
    return rng.standard_normal((tables, size, 8)) / np.sqrt(8)


def cells(unit: np.ndarray, tables: int = TABLES, probes: int = PROBES, cell: float = CELL) -> np.ndarray:
    """(rows, tables, 1 + probes, 8): doubled coordinates of the cells, own first."""
    steps = shortest_steps()
    out = np.empty((len(unit), tables, 1 + probes, 8), dtype=np.int32)
    for t, matrix in enumerate(projections(unit.shape[1], tables)):
        x = unit @ matrix / cell
        point = nearest_point(x)
        out[:, t, 0] = np.rint(2 * point)
        if probes:
            towards = (x - point) @ steps.T
            best = np.argpartition(-towards, probes - 1, axis=1)[:, :probes]
            for p in range(probes):
                out[:, t, 1 + p] = np.rint(2 * (point + steps[best[:, p]]))
    return out


def _usable(vector) -> np.ndarray | None:
    if vector is None or not len(vector):
        return None
    x = np.array([np.nan if v is None else v for v in vector], dtype=np.float64)
    return x if np.isfinite(x).all() and x.any() else None


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes = []
        for label, vector in zip(batch.column("label").to_pylist(), batch.column("vector").to_pylist(), strict=True):
            x = None if label is None else _usable(vector)
            if x is None:
                nodes.append(None)
                continue
            x = x + 0.0  # one zero
            nodes.append(hashlib.blake2b(f"{label}:".encode() + x.tobytes(), digest_size=16).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), batch.column("vector"), pa.array(nodes, pa.binary())],
            names=["vec_id", "label", "vector", "node"],
        )


def _unit_rows(vectors: list) -> np.ndarray:
    x = np.array(vectors, dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _in_cells(tables: int, probes: int, cell: float):
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                vectors = batch.column("vector").to_pylist()
                labels = batch.column("label").to_pylist()
                nodes = batch.column("node").to_pylist()
                sizes = np.array([len(v) for v in vectors])
                for size in np.unique(sizes):
                    rows = np.flatnonzero(sizes == size)
                    unit = _unit_rows([vectors[i] for i in rows])
                    points = cells(unit, tables, probes, cell)
                    scale = np.abs(unit).max(axis=1) / 127
                    small = np.rint(unit / scale[:, None]).astype(np.int8)
                    node, key, copy, step = [], [], [], []
                    for k, i in enumerate(rows):
                        seen = set()
                        for t in range(tables):
                            head = f"{labels[i]}:{size}:{t}:".encode()
                            for p in range(1 + probes):
                                seen.add(xxhash.xxh3_64_intdigest(head + points[k, t, p].tobytes()))
                        key += seen
                        node += [nodes[i]] * len(seen)
                        copy += [small[k].tobytes()] * len(seen)
                        step += [float(scale[k])] * len(seen)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.array(key, dtype=np.uint64).view(np.int64), pa.int64()),
                            pa.array(node, pa.binary()),
                            pa.array(copy, pa.binary()),
                            pa.array(step, pa.float64()),
                        ],
                        names=["cell", "node", "copy", "step"],
                    )

    return placed


def _near(threshold: float):
    """Pairs of a unit whose 8-bit copies allow a cosine of ``threshold``."""

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, count = [], 0
        for unit in each_unit(batches):
            side, node = unit["side"].to_numpy(), unit["node"].to_numpy()
            first, second = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
            if not len(first) or not len(second):
                continue
            step = unit["step"].to_numpy()
            x = np.frombuffer(b"".join(unit["copy"]), dtype=np.int8).reshape(len(unit), -1) * step[:, None]
            # Each component is off by half a step at most.
            off = step * (0.5 * np.sqrt(x.shape[1]))
            dots = x[first] @ x[second].T
            least = threshold - (off[first][:, None] + off[second][None, :]) * 1.02 - 1e-6
            i, j = np.nonzero(dots >= least)
            a, b = node[first[i]], node[second[j]]
            keep = a < b if (side == 2).all() else np.ones(len(a), dtype=bool)
            if keep.any():
                a, b = a[keep], b[keep]
                swap = a > b
                held.append(pd.DataFrame({"a": np.where(swap, b, a), "b": np.where(swap, a, b)}))
                count += len(a)
                if count > 20_000:
                    yield pd.concat(held).drop_duplicates()
                    held, count = [], 0
        if held:
            yield pd.concat(held).drop_duplicates()

    return pairs


def _confirm(threshold: float):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for va, vb in zip(batch.column("va").to_pylist(), batch.column("vb").to_pylist(), strict=True):
                x, y = np.array(va, dtype=np.float64), np.array(vb, dtype=np.float64)
                keep.append(float(x @ y) >= threshold * float(np.sqrt(x @ x) * np.sqrt(y @ y)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], names=["a", "b"]
            ).filter(pa.array(keep, pa.bool_()))

    return links


def link_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    tables: int = TABLES,
    probes: int = PROBES,
    cell: float = CELL,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept; see the module."""
    workers_import(vectors.sparkSession)
    source = vectors.select(
        F.col(id_column).alias("vec_id"), F.col(label_column).alias("label"), F.col(vector_column).alias("vector")
    )
    kinds = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    marked = stored(
        source.mapInArrow(
            _digests,
            f"vec_id {kinds['vec_id']}, label {kinds['label']}, vector {kinds['vector']}, node binary",
        ),
        "vectors",
    )
    classes = stored(
        marked.where("node is not null")
        .groupBy("node")
        .agg(
            F.first("label").alias("label"),
            F.first("vector").alias("vector"),
            F.min("vec_id").alias("least_id"),
            F.count(F.lit(1)).alias("size"),
        ),
        "classes",
    )
    placed = stored(
        classes.select("node", "label", "vector").mapInArrow(
            _in_cells(tables, probes, cell), "cell bigint, node binary, copy binary, step double"
        ),
        "cells",
    )
    units = units_together(block_units(placed, "cell", "node", BLOCK))
    near = (
        units.select("unit", "side", "node", "copy", "step")
        .mapInPandas(_near(threshold), "a binary, b binary")
        .distinct()
    )
    va = classes.select(F.col("node").alias("a"), F.col("vector").alias("va"))
    vb = classes.select(F.col("node").alias("b"), F.col("vector").alias("vb"))
    links = stored(
        near.join(va, "a").join(vb, "b").mapInArrow(_confirm(threshold), "a binary, b binary"), "links"
    )
    sizes = classes.select("node", "size")
    ends = links.union(links.select(F.col("b"), F.col("a")))
    degree = (
        ends.join(sizes.withColumnRenamed("node", "b"), "b")
        .groupBy(F.col("a").alias("node"))
        .agg(F.sum("size").alias("others"))
    )
    grouped = classes.select("node", "least_id", "size").join(components(links), "node", "left").select(
        "node", "least_id", "size", F.coalesce("component", "node").alias("component")
    )
    least = grouped.groupBy("component").agg(F.min("least_id").alias("component_id"))
    looked_up = (
        grouped.join(least, "component")
        .join(degree, "node", "left")
        .select("node", "component_id", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
        .where("n_links > 0")
    )
    out = marked.select("vec_id", "node").join(looked_up, "node", "left")
    linked = F.col("n_links").isNotNull()
    component = F.when(linked, F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
