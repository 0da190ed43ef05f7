"""Quality classifier: a generalised additive model with pairwise interactions.

Each text is described by a few numbers (shares of kinds of characters, lengths,
repetition). Every number is cut into bins at its quantiles. Training is cyclic
boosting: round after round each feature in turn gets one shallow tree on the
current residuals, a tree over its bins only, whose leaf values are added with a
small rate to the feature's lookup table. The best pairs are then picked by the
residual they explain on a coarse grid, and boosted the same way by trees over
two features, into two-way tables. A score is the sigmoid of the intercept and
one table entry per feature and pair, which is added up for a batch at a time.

Training takes at most about ``sample_rows`` labelled rows: a hash of the id
against a rate, so the same rows each time, and nothing but their numbers reaches
the driver. Scoring covers every row and its whole text, without a shuffle.

Defined results: null texts count as empty and get the score of an empty text.
Labels other than 0 and 1 and null ids teach nothing; an id with several labels
counts by the least, one with several rows by the least of their numbers. Without labelled rows, or with one class only, the score is
the smoothed share of label 1 (0.5 without any). Repeated rows get one score
each. Inputs are the text alone.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import text_or_empty, workers_import

SAMPLE_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.1
ACCEPT = 0.7

UPPERS = bytes(range(65, 91))
LOWERS = bytes(range(97, 123))
DIGITS = b"0123456789"
SPACES = b" \t\r\n\v\f"
STOPS = b".,;:!?"
SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:!?'\"-()")
FEATURES = (
    "log_chars", "log_words", "word_length", "upper", "digit", "stop", "sign", "bang", "bar",
    "beyond_ascii", "line_words", "lines_new", "words_new", "words_again", "top_word", "halves_same",
    "short_words", "capital_words", "sign_words", "stop_words",
)


def text_numbers(text: str) -> list[float]:
    """The features of one text, in the order of ``FEATURES``."""
    raw = text.encode()
    n = len(raw)
    if not n:
        return [0.0] * len(FEATURES)

    def share(kinds: bytes) -> float:
        return (n - len(raw.translate(None, kinds))) / n

    words = raw.split()
    m = len(words)
    lines = [line for line in raw.split(b"\n") if line]
    counts = Counter(words)
    different = len(counts)
    again = sum(map(bytes.__eq__, words, words[1:])) if m > 1 else 0
    half = m // 2
    halves = sum(map(bytes.__eq__, words[:half], words[m - half :])) / half if half else 0.0
    sizes = list(map(len, words))
    signs = raw.translate(None, UPPERS + LOWERS + DIGITS + STOPS + b"'\"-()").split()
    stops = sum(1 for w in words if w[-1] in STOPS)
    capitals = sum(map(bytes.isupper, words))
    short = sum(1 for s in sizes if s <= 2)
    common = max(counts.values(), default=0)
    w = max(m, 1)
    return [
        math.log1p(n), math.log1p(m), sum(sizes) / w, share(UPPERS), share(DIGITS), share(STOPS), share(SIGNS),
        raw.count(b"!") / n, raw.count(b"|") / n, share(bytes(range(128, 256))),
        m / max(len(lines), 1), len(set(lines)) / max(len(lines), 1), different / w, again / w, common / w, halves,
        short / w, capitals / w, sum(1 for s in signs if s.isascii()) / w, stops / w,
    ]


@dataclass
class Gam:
    """Lookup tables over bins; plain numbers, so that it travels to the tasks."""

    edges: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.intercept)
        for j, (edge, values) in enumerate(zip(self.edges, self.tables, strict=True)):
            score += values[np.searchsorted(edge, x[:, j], side="right")]
        for (i, j), values in zip(self.pairs, self.pair_tables, strict=True):
            a = np.searchsorted(self.pair_edges[i], x[:, i], side="right")
            b = np.searchsorted(self.pair_edges[j], x[:, j], side="right")
            score += values[a, b]
        return score

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _quantile_edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _line_tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Values per bin of a tree that cuts the bins into ``leaves`` ranges."""
    cg, ch = np.concatenate(([0], np.cumsum(g))), np.concatenate(([0], np.cumsum(h)))
    ranges = [(0, len(g))]

    def best(start: int, end: int) -> tuple[float, int]:
        if end - start < 2:
            return 0.0, start
        at = np.arange(start + 1, end)
        left = _gain(cg[at] - cg[start], ch[at] - ch[start])
        right = _gain(cg[end] - cg[at], ch[end] - ch[at])
        gain = left + right - _gain(cg[end] - cg[start], ch[end] - ch[start])
        i = int(np.argmax(gain))
        return float(gain[i]), int(at[i])

    for _ in range(leaves - 1):
        gain, at, chosen = max(((*best(*r), r) for r in ranges), key=lambda c: c[0])
        if gain <= 1e-9:
            break
        ranges.remove(chosen)
        ranges += [(chosen[0], at), (at, chosen[1])]
    values = np.zeros(len(g))
    for start, end in ranges:
        values[start:end] = (cg[end] - cg[start]) / (ch[end] - ch[start] + 1.0)
    return values


def _grid_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A tree over two features: one cut of the first, then one of the second on
    each side (or the other way round), whichever explains more."""
    best_gain, best_values = -1.0, np.zeros_like(g)
    for turned in (False, True):
        gg, hh = (g.T, h.T) if turned else (g, h)
        for at in range(1, gg.shape[0]):
            total, values = 0.0, np.zeros_like(gg)
            for part in (slice(0, at), slice(at, None)):
                pg, ph = gg[part].sum(axis=0), hh[part].sum(axis=0)
                leaf = _line_tree(pg, ph, 2)
                total += float((leaf * pg).sum())
                values[part] = leaf
            if total > best_gain:
                best_gain, best_values = total, values.T if turned else values
    return best_values


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Fit the model on rows of numbers and labels 0 or 1."""
    n = len(y)
    share = (y.sum() + 0.5) / (n + 1)
    model = Gam(
        [_quantile_edges(c, BINS) if n else np.empty(0) for c in x.T],
        float(np.log(share / (1 - share))),
        [],
    )
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    model.pair_edges = [_quantile_edges(c, PAIR_BINS) if n else np.empty(0) for c in x.T]
    if n < 2 or y.min() == y.max():
        return model
    bins = [np.searchsorted(e, c, side="right") for e, c in zip(model.edges, x.T, strict=True)]
    raw = np.full(n, model.intercept)
    for _ in range(ROUNDS):
        for j, at in enumerate(bins):
            size = len(model.tables[j])
            if size < 2:
                continue
            p = 1 / (1 + np.exp(-raw))
            g = np.bincount(at, y - p, size)
            h = np.bincount(at, p * (1 - p), size)
            step = RATE * _line_tree(g, h, 3)
            model.tables[j] += step
            raw += step[at]
    coarse = [np.searchsorted(e, c, side="right") for e, c in zip(model.pair_edges, x.T, strict=True)]
    sizes = [len(e) + 1 for e in model.pair_edges]
    p = 1 / (1 + np.exp(-raw))

    def grids(i: int, j: int, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = coarse[i] * sizes[j] + coarse[j]
        g = np.bincount(at, y - p, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j])
        h = np.bincount(at, p * (1 - p), sizes[i] * sizes[j]).reshape(sizes[i], sizes[j])
        return at, g, h

    gains = []
    for i in range(len(sizes)):
        for j in range(i + 1, len(sizes)):
            _, g, h = grids(i, j, p)
            gains.append((float(_gain(g, h).sum()), i, j))
    model.pairs = [(i, j) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
    model.pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (i, j) in enumerate(model.pairs):
            p = 1 / (1 + np.exp(-raw))
            at, g, h = grids(i, j, p)
            step = RATE * _grid_tree(g, h)
            model.pair_tables[k] += step
            raw += step.ravel()[at]
    return model


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        numbers = [text_numbers(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(numbers, pa.list_(pa.float64()))],
            names=["doc_id", "label", "numbers"],
        )


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Gam:
    """Fit on about ``sample_rows`` of the labelled documents at most.

    ``labels`` has id and label; which rows may teach is the caller's choice.
    """
    workers_import(docs.sparkSession)
    label = F.col(label_column).cast("int")
    known = (
        labels.select(F.col(id_column).alias("doc_id"), label.alias("label"))
        .where("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )
    rate = min(1.0, sample_rows / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(rate * (1 << 30))))
    texts = docs.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    # The chosen labels are bounded by ``sample_rows``.
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text").mapInArrow(
        _measured, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, label int, numbers array<double>"
    )
    # One row per id leaves the tasks, however often it is repeated.
    rows = rows.groupBy("doc_id", "label").agg(F.min("numbers").alias("numbers"))
    found = sorted(rows.collect(), key=lambda r: r["doc_id"])
    x = np.array([r["numbers"] for r in found]).reshape(len(found), len(FEATURES))
    return fit(x, np.array([r["label"] for r in found], dtype=float))


def scorer(model: Gam):
    """A column function: text to score."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = np.array([text_numbers(t or "") for t in texts]).reshape(len(texts), len(FEATURES))
        return pd.Series(model.score(x))

    return score


def teaching_labels(labels: DataFrame) -> DataFrame:
    """Labels outside the held-out quarter: crc32 of the id as text, mod 4, not 2."""
    return labels.where(~held_out("doc_id"))


def held_out(id_column: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))
