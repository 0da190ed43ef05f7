"""Windows of words that a corpus has more than once, wherever they lie in lines.

A window is ``n`` consecutive words of a document (A-Z lower-cased, any ASCII
white space between words, so line breaks don't matter). A window is a repeat
where an equal one has a lesser (id, place). What is found equals a grouping of
all windows, with far fewer rows: each window is stood for by its least run of
``n // 4`` words, by hash (its anchor), which equal windows have in common.
Neighbouring windows with one anchor are a unit, one row in about twenty words.

Equal units (anchor and all words) are one class and compared as a whole; where a
class has several members, all but the first are repeats. Where one anchor has unequal units, as at the
ends of a copied passage, the first of each is taken apart into its windows.
Hashes are of 64 bits for the anchor and 64 others for the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import maybe_among, stored

SLICE_BYTES = 1 << 18  # text a worker looks at at a time, one document at least
WHITE = np.isin(np.arange(256), list(b" \t\n\r\v\f"))
BYTES = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Rolling:
    """Hashes of any stretch [start, end) of ``values``."""

    def __init__(self, values: np.ndarray, odd: int):
        size = len(values) + 1
        power = np.full(size, odd, np.uint64)
        power[0] = 1
        power = np.cumprod(power)
        self.back = np.full(size, pow(odd, -1, 1 << 64), np.uint64)
        self.back[0] = 1
        self.back = np.cumprod(self.back)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * power[:-1])))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.back[start])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the least value, the first of equal ones, of each ``width``."""
    at, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        a, b = at[:-step], at[step:]
        at = np.where(values[b] < values[a], b, a)
        have += step
    return at


class Words:
    """The words of a few texts: places in characters, hashes, windows."""

    def __init__(self, texts: list[str], n: int):
        raws = [t.encode() for t in texts]
        data = np.frombuffer(b" ".join([*raws, b""]).lower(), np.uint8)
        white = np.concatenate(([True], WHITE[data], [True]))
        starts = np.flatnonzero(white[:-1] & ~white[1:])
        ends = np.flatnonzero(~white[:-1] & white[1:])
        bounds = np.cumsum([0, *[len(r) + 1 for r in raws]])
        self.text = np.searchsorted(bounds, starts, side="right") - 1
        chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        before = chars[bounds[self.text]]
        self.start, self.end = chars[starts] - before, chars[ends] - before
        word = _Rolling(BYTES[data], ODD[0]).of(starts, ends)
        self.n, self.m = n, len(word)
        self.rolling = _Rolling(_mix(word ^ np.uint64(ODD[2])), ODD[2])
        run = max(1, n // 4)
        if self.m < n:
            self.windows = self.anchor = np.empty(0, np.int64)
            self.value = np.empty(0, np.int64)
            return
        p = np.arange(self.m - run + 1)
        value = _Rolling(word, ODD[1]).of(p, p + run)
        anchor = _least(value, n - run + 1)
        self.windows = np.flatnonzero(self.text[: self.m - n + 1] == self.text[n - 1 :])
        self.anchor = anchor[self.windows]
        self.value = value[self.anchor].view(np.int64)

    def stretches(self, first: np.ndarray, last: np.ndarray) -> dict[str, np.ndarray]:
        """Of the windows ``first`` to ``last``: hash of all words, places."""
        end = last + self.n
        return {
            "words": self.rolling.of(first, end).view(np.int64),
            "start": self.start[first],
            "end": self.end[end - 1],
            "first_end": self.end[first + self.n - 1],
        }

    def units(self) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
        """Text, anchor's hash and stretch of the units."""
        w, a = self.windows, self.anchor
        new = np.ones(len(w), bool)
        new[1:] = (a[1:] != a[:-1]) | (w[1:] != w[:-1] + 1)
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(w))[: len(at)] - 1
        return self.text[w[at]], self.value[at], self.stretches(w[at], w[last])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = np.cumsum(np.array(batch.column("size").to_pylist(), np.int64))
        first = 0
        while first < batch.num_rows:
            done = sizes[first - 1] if first else 0
            past = max(first + 1, int(np.searchsorted(sizes, done + SLICE_BYTES, side="right")))
            yield batch.slice(first, past - first)
            first = past


KINDS = {"words": pa.int64(), "start": pa.int32(), "end": pa.int32(), "first_end": pa.int32()}


def _rows(batch: pa.RecordBatch, row: np.ndarray, value: np.ndarray, found: dict) -> pa.RecordBatch:
    take = pa.array(row.astype(np.int64))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id").take(take),
            batch.column("text_hash").take(take),
            pa.array(value, pa.int64()),
            *[pa.array(found[k].astype(np.int64), pa.int64()).cast(kind) for k, kind in KINDS.items()],
        ],
        names=["doc_id", "text_hash", "value", *KINDS],
    )


def _units(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            yield _rows(batch, *Words(batch.column("text").to_pylist(), n).units())

    return run


def _windows(n: int):
    """Windows that begin in the document's stretches ``parts``, by character."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            words = Words(batch.column("text").to_pylist(), n)
            wanted = np.zeros(len(words.windows), bool)
            text, start = words.text[words.windows], words.start[words.windows]
            end = words.end[words.windows + n - 1] if len(wanted) else start
            bounds = np.searchsorted(text, np.arange(batch.num_rows + 1))
            for i, parts in enumerate(batch.column("parts").to_pylist()):
                a, b = bounds[i], bounds[i + 1]
                for part in parts:
                    first = a + np.searchsorted(start[a:b], part["start"])
                    wanted[first : a + np.searchsorted(end[a:b], part["end"], side="right")] = True
            w = words.windows[wanted]
            yield _rows(batch, words.text[w], words.value[wanted], words.stretches(w, w))

    return run


PLACE = ("doc_id", "text_hash", "start", "first_end", "end")


def _classes(found: DataFrame) -> DataFrame:
    """Equal units as one row: the first place and how many there are."""
    return found.groupBy("value", "words").agg(F.min(F.struct(*PLACE)).alias("first"), F.count(F.lit(1)).alias("n"))


def _repeats(found: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of ``found`` that have an equal one before them, as stretches to cut.
    What an equal window in the same document overlaps with stays with that one.
    ``classes`` is a stored table, so that the join is of two plain shuffles, which
    Spark may split."""
    firsts = classes.where("n > 1").select("value", "words", "first")
    repeats = found.join(firsts, ["value", "words"]).where(~F.struct(*PLACE).eqNullSafe(F.col("first")))
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    start = F.when(own, F.greatest("start", F.col("first.first_end") + 1)).otherwise(F.col("start"))
    return repeats.select("doc_id", "text_hash", start.alias("start"), "end").distinct()


def repeated_stretches(source: DataFrame, n: int) -> DataFrame:
    """(doc_id, text_hash, start, end): stretches of repeated windows of ``n``
    words, in characters; they overlap. ``source``: doc_id, text, text_hash."""
    sized = source.withColumn("size", F.octet_length("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {id_type}, text_hash bigint, value bigint, words bigint, start int, end int, first_end int"
    units = sized.mapInArrow(_units(n), shape)
    # Equal units are one row before anything is joined: a passage that a third of
    # all documents share is as many rows as it has units.
    classes = stored(_classes(units), "unit-classes")
    mixed = classes.groupBy("value").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("value")
    parts = stored(
        classes.join(mixed, "value")
        .groupBy(F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash"))
        .agg(F.collect_list(F.struct("first.start", "first.end")).alias("parts")),
        "unit-parts",
    )
    same = parts["_id"].eqNullSafe(sized["doc_id"]) & (parts["_hash"] == sized["text_hash"])
    # Texts are moved only where they may have such parts.
    near = maybe_among(sized, sized["text_hash"], parts, "_hash", "near").where("near")
    windows = stored(
        near.join(parts.hint("shuffle_hash"), same)
        .select(*sized.columns, "parts")
        .mapInArrow(_windows(n), shape),
        "windows",
    )
    return _repeats(units, classes).unionByName(_repeats(windows, stored(_classes(windows), "window-classes")))
