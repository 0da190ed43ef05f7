"""MinHash near-dedup with circulant signatures, banding and exact verification.

*Signatures.* A document's set is its distinct word shingles, as 64-bit hashes.
Two permutations of the 32-bit universe make all coordinates (C-MinHash): the
first scatters the shingles, the second, circularly shifted by ``i`` steps, is
minimised for coordinate ``i``. ``bands`` bands of ``rows`` coordinates each
give the bucket keys; with 20 bands of 4, a pair at a similarity of 0.85 shares no
bucket with a probability below 1e-6, at 0.8 below 3e-5.

*Classes.* Documents with one set are one class (a 128-bit digest of the set);
everything after works on classes, so copies cost nothing.

*Links.* What counts is which classes are connected, so a bucket is first compared
in two star rounds, every member with one leader, which makes no more pairs than
members. Buckets whose members are still apart are compared in full inside tasks,
from the full sets and block by block, whatever their size: a block holds about
``BLOCK`` shingles, so a bucket of small sets is one unit. Out come spanning forests of
the components a unit links, fewer rows than it has members. Every link is confirmed
on the full sets by whole numbers: ``100 * both >= percent * either``.

Defined results: words are runs of bytes other than space and 0x09-0x0D, A-Z
lower-cased. With fewer words than a shingle has, the whole sequence is the one
shingle. Null and blank texts have an empty set, link with nothing and stay.
Rows that share an id are documents of their own. ``kept`` is ``doc_id =
component_id``; null ids rank last, and a component of null ids only keeps all.
An empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.blocks import block_units, each_unit, units_together
from eventmart.llm.common import stored, text_or_empty, workers_import
from eventmart.llm.components import components

BANDS, ROWS = 20, 4
# Shingles and members of a block, as expected.
BLOCK, MOST = 1 << 19, 1024
CHUNK = 1 << 15

# Odd multipliers of the mixing steps and the shift between coordinates.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
SIGMA, PI_A, PI_B, STEP = (np.uint32(x) for x in (0x85EBCA6B, 0x7FEB352D, 0x846CA68B, 0x9E3779B1))


def shingle_hashes(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a UTF-8 text."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    if n < k:
        whole = xxhash.xxh3_64_intdigest(b" ".join(words), seed=n)
        return np.array([whole], dtype=np.uint64)
    word = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
    m = n - k + 1
    h = word[:m] * MIX[0]
    for i in range(1, k):
        h ^= h >> np.uint64(32)
        h += word[i : i + m]
        h *= MIX[i % 3]
    h ^= h >> np.uint64(29)
    return np.unique(h)


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """(len(sets), coordinates) of uint32; the sets hold at least one hash each."""
    out = np.empty((len(sets), coordinates), dtype=np.uint32)
    start = 0
    while start < len(sets):
        end, total = start, 0
        while end < len(sets) and (end == start or total + len(sets[end]) <= CHUNK):
            total += len(sets[end])
            end += 1
        x = np.concatenate(sets[start:end])
        at = (x ^ (x >> np.uint64(32))).astype(np.uint32)
        at *= SIGMA
        at ^= at >> np.uint32(15)
        sizes = [len(s) for s in sets[start:end]]
        edges = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        v, w = np.empty_like(at), np.empty_like(at)
        for i in range(coordinates):
            np.subtract(at, np.uint32((i * int(STEP)) & 0xFFFFFFFF), out=v)
            np.multiply(v, PI_A, out=v)
            np.right_shift(v, np.uint32(15), out=w)
            np.bitwise_xor(v, w, out=v)
            np.multiply(v, PI_B, out=v)
            np.right_shift(v, np.uint32(16), out=w)
            np.bitwise_xor(v, w, out=v)
            out[start:end, i] = np.minimum.reduceat(v, edges)
        start = end
    return out


def _sketcher(k: int, bands: int, rows: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            sets = [shingle_hashes(t, k) for t in texts]
            full = [i for i, s in enumerate(sets) if len(s)]
            node: list[bytes | None] = [None] * len(sets)
            keys: list = [None] * len(sets)
            if full:
                sig = signatures([sets[i] for i in full], bands * rows)
                key = np.zeros((len(full), bands), dtype=np.uint64)
                for r in range(rows):
                    key += sig[:, r::rows]
                    key *= MIX[r % 3]
                    key ^= key >> np.uint64(31)
                key = key.view(np.int64)
                for j, i in enumerate(full):
                    node[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                    keys[i] = key[j]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(node, pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_hash", "node", "n_shingles", "bands"],
            )

    return sketch


def _as_sets(k: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                shingle_hashes(t, k).view(np.int64)
                for t in batch.column("text").cast(pa.binary()).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(found, pa.list_(pa.int64()))],
                names=["node", "shingles"],
            )

    return sets


def _similar(percent: int, rows_both: str = "both") -> F.Column:
    return F.expr(f"100 * {rows_both} >= {percent} * (na + nb - {rows_both})")


def _size_fits(percent: int) -> F.Column:
    return F.expr(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, na, nb) that are similar on their full sets."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b").withColumn(
        "both", F.size(F.array_intersect("sa", "sb"))
    )
    return both.where(_similar(percent)).select("a", "b")


def _forest(pairs: np.ndarray) -> list[tuple[int, int]]:
    """Of (n, 2) pairs of small integers those that join what was apart: a spanning forest."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    kept = []
    for x, y in pairs.tolist():
        a, b = find(x), find(y)
        if a != b:
            root[b] = a
            kept.append((x, y))
    return kept


def _intersections(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets ``first`` with the sets ``second``."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    start = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
    times = np.diff(np.append(start, len(flat)))
    index = np.repeat(np.cumsum(times > 1) - 1, times)
    shared = np.repeat(times > 1, times)  # values of one set only count for nothing
    owner, index = owner[shared], index[shared]
    both = np.zeros((len(first), len(second)), dtype=np.float32)
    row, column = np.full(len(sets), -1), np.full(len(sets), -1)
    row[first], column[second] = np.arange(len(first)), np.arange(len(second))
    wide = 4096
    n = int(index[-1]) + 1 if len(index) else 0
    edges = np.searchsorted(index, np.arange(0, n + wide, wide))
    for i in range(len(edges) - 1):
        o, c = owner[edges[i] : edges[i + 1]], index[edges[i] : edges[i + 1]] - i * wide
        a = np.zeros((len(first), wide), dtype=np.float32)
        b = np.zeros((len(second), wide), dtype=np.float32)
        m = row[o] >= 0
        a[row[o[m]], c[m]] = 1
        m = column[o] >= 0
        b[column[o[m]], c[m]] = 1
        both += a @ b.T
    return np.rint(both).astype(np.int64)


def _linked_in_blocks(percent: int):
    """Links between the members of two blocks that are apart so far, as pairs of their
    components: a spanning forest, so at most one row less than a unit has components."""

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for unit in each_unit(batches):
            comp, index = np.unique(unit["comp"].to_numpy(), return_inverse=True)
            side = unit["side"].to_numpy()
            first, second = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
            if len(comp) < 2 or not len(first) or not len(second):
                continue
            n = unit["n"].to_numpy()
            inter = _intersections(list(unit["shingles"]), first, second)
            either = n[first][:, None] + n[second][None, :] - inter
            linked = (100 * inter >= percent * either) & (index[first][:, None] != index[second][None, :])
            x, y = np.nonzero(linked)
            kept = _forest(np.unique(np.stack([index[first[x]], index[second[y]]], 1), axis=0))
            if kept:
                yield pd.DataFrame({"a": [comp[i] for i, _ in kept], "b": [comp[j] for _, j in kept]})

    return links


def minhash_classes(
    docs: DataFrame,
    percent: int = 80,
    shingle: int = 5,
    id_column: str = "doc_id",
    text_column: str = "text",
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per document: doc_id, text_hash, node (its class), n_shingles,
    component_id, kept; see the module."""
    workers_import(docs.sparkSession)
    source = docs.select(
        F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    sketched = stored(
        source.mapInArrow(
            _sketcher(shingle, bands, rows),
            f"doc_id {id_type}, text_hash bigint, node binary, n_shingles bigint, bands array<bigint>",
        ),
        "sketches",
    )
    classes = stored(
        sketched.where("node is not null")
        .groupBy("node")
        .agg(
            F.min(F.struct("doc_id", "text_hash")).alias("rep"),
            F.min("doc_id").alias("least_id"),
            F.max("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
            F.count(F.lit(1)).alias("size"),
        ),
        "classes",
    )
    in_bucket = classes.select("node", "n", F.posexplode("bands").alias("band", "key")).select(
        "node", "n", F.xxhash64("band", "key").alias("bucket")
    )
    buckets = stored(
        in_bucket.groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.min(F.struct("node", "n")).alias("least"),
            F.max(F.struct("node", "n")).alias("most"),
        )
        .where("members > 1"),
        "buckets",
    )  # stored, so that the join is of two plain shuffles, which Spark may split
    members = stored(in_bucket.join(buckets, "bucket"), "members")

    # The full sets of the classes that share a bucket with another one.
    wanted = (
        members.select("node").distinct().join(classes.select("node", "rep"), "node")
        .select("node", F.col("rep.doc_id").alias("_id"), F.col("rep.text_hash").alias("text_hash"))
    )
    texts = source.withColumnRenamed("doc_id", "_row").join(
        wanted.withColumnRenamed("text_hash", "_hash"),
        F.col("_id").eqNullSafe(F.col("_row")) & (F.col("_hash") == F.col("text_hash")),
    )
    sets = stored(
        texts.select("node", "text").mapInArrow(_as_sets(shingle), "node binary, shingles array<bigint>"),
        "sets",
    )

    leaders = F.explode(F.array("least", "most")).alias("leader")
    pairs = members.select("node", "n", leaders).where("leader.node != node").select(
        F.col("leader.node").alias("a"), F.col("node").alias("b"), F.col("leader.n").alias("na"), F.col("n").alias("nb")
    )
    links = stored(confirmed(pairs.where(_size_fits(percent)).distinct(), sets, percent), "links")
    labels = stored(components(links), "components")

    # What is still apart inside a bucket.
    placed = members.select("bucket", "node", "n").join(labels, "node", "left").select(
        "bucket", "node", "n", F.coalesce("component", "node").alias("comp")
    )
    still_open = (
        placed.groupBy("bucket")
        .agg(
            F.min("comp").alias("c0"),
            F.max("comp").alias("c1"),
            F.count(F.lit(1)).alias("members"),
            F.min("node").alias("n0"),
            F.max("node").alias("n1"),
            F.sum(F.xxhash64("node") % 2**40).alias("mark"),
        )
        .where("c0 != c1")
        # Buckets of the same members once.
        .groupBy("members", "n0", "n1", "mark")
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket")
    )
    rest = stored(placed.join(still_open, "bucket").select("bucket", "node", "n", "comp"), "rest")
    if not rest.isEmpty():
        full = rest.join(sets.dropDuplicates(["node"]), "node")
        units = units_together(block_units(full, "bucket", "node", BLOCK, f"greatest(n, {BLOCK // MOST})"))
        between = stored(
            units.select("unit", "side", "node", "n", "comp", "shingles").mapInPandas(
                _linked_in_blocks(percent), "a binary, b binary"
            ),
            "links",
        )
        # The components linked now are few: their graph is the one to join up.
        joined = components(between).select(F.col("node").alias("component"), F.col("component").alias("joined"))
        known = labels.union(between.select(F.col("a"), F.col("a"))).union(between.select(F.col("b"), F.col("b")))
        known = known.groupBy("node").agg(F.min("component").alias("component")).join(joined, "component", "left")
        labels = stored(known.select("node", F.coalesce("joined", "component").alias("component")), "components")

    # Only classes of several documents or with links need a lookup.
    # Both are stored, so that the join is of two plain shuffles, which Spark may split.
    grouped = stored(
        classes.select("node", "least_id", "size").join(labels, "node", "left").select(
            "node", "least_id", "size", F.coalesce("component", "node").alias("component")
        ),
        "grouped",
    )
    least = stored(
        grouped.groupBy("component")
        .agg(F.min("least_id").alias("component_id"), F.sum("size").alias("group_size"))
        .where("group_size > 1"),
        "least",
    )
    looked_up = grouped.join(least, "component").select(
        "node", "component_id", F.lit(True).alias("_grouped")
    )
    out = sketched.select("doc_id", "text_hash", "node", "n_shingles").join(looked_up, "node", "left")
    component = F.when(F.col("_grouped"), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", "text_hash", "node", "n_shingles", component.alias("component_id")
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one_each(docs: DataFrame, percent: int = 80, shingle: int = 5) -> DataFrame:
    """The documents that stay, with all their columns (id in doc_id)."""
    stays = minhash_classes(docs, percent, shingle).where("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")
    )
    same = stays["_id"].eqNullSafe(docs["doc_id"]) & (
        stays["_hash"] == F.xxhash64(text_or_empty(docs["text"]))
    )
    return docs.join(stays, same, "left_semi")
