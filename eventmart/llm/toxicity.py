"""Toxicity by a classifier chain.

Categories are predicted in a fixed order. The model of a category is linear
(logistic) in two kinds of inputs: which of the chosen terms a text has, and the
probabilities of all categories before it. In training those probabilities are
out of fold: rows are dealt to folds by a hash of the id, and a row's probability
comes from a model that was fitted without its fold. In scoring they come from
the models fitted on all rows.

Terms are whole words and beginnings of four to six letters, of runs of letters in
lower case. The terms kept are those that tell rows of any category from the rest
best: by log odds, weighted by how sure they are.

Training takes at most about ``sample_rows`` labelled rows, chosen by a hash of
the id; only their terms, as numbers, reach the driver. Scoring covers every row
and its whole text, without a shuffle.

Defined results: null and empty texts have no terms and get the scores of the
intercepts. Labels that are null and ids without a document teach nothing; an id
with several labels counts as the greatest of each category, one with several
rows by the row of the least text hash. Without labelled rows every score is
0.01. Repeated rows get one score each; an empty table gives no rows; other columns
are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import stored, text_or_empty, workers_import

SAMPLE_ROWS = 20_000
MOST_TERMS = 2_000
LEAST_ROWS = 4  # rows a term must be in
LEAST_WORTH = 3.0  # standard deviations of its log odds from none
FOLDS = 3
STEPS, PENALTY = 400, 1e-5
FLAGGED = 0.5
MOST_WORDS = 300_000

WORD = re.compile(r"[^\W\d_]+")
STARTS = (4, 5, 6)


def terms_of_word(word: str) -> list[str]:
    return ["=" + word, *("^" + word[:n] for n in STARTS if len(word) > n)]


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def _number(term: str) -> int:
    return zlib.crc32(term.encode()) >> 1  # fits 32 bits with a sign


@dataclass
class Chain:
    """Terms by number, and per category: intercept, weights, weights of earlier
    categories' probabilities."""

    categories: list[str]
    terms: dict[int, int]
    intercepts: list[float]
    weights: list[np.ndarray]
    chained: list[np.ndarray]

    def probabilities(self, rows: list[np.ndarray]) -> np.ndarray:
        """(rows, categories) for lists of term places."""
        found = np.zeros((len(rows), len(self.categories)))
        sizes = np.array([len(r) for r in rows])
        at = np.repeat(np.arange(len(rows)), sizes)
        flat = np.concatenate(rows).astype(np.int64) if len(at) else np.empty(0, dtype=np.int64)
        for k in range(len(self.categories)):
            raw = self.intercepts[k] + np.bincount(at, self.weights[k][flat], len(rows))
            raw += found[:, :k] @ self.chained[k]
            found[:, k] = 1 / (1 + np.exp(-raw.clip(-30, 30)))
        return found


def _fit_linear(rows: list[np.ndarray], more: np.ndarray, y: np.ndarray, terms: int):
    """Logistic regression by accelerated gradient steps with a small penalty."""
    n = len(y)
    if not n or y.min() == y.max():
        share = (y.sum() + 0.01) / (n + 1)
        return float(np.log(share / (1 - share))), np.zeros(terms), np.zeros(more.shape[1])
    at = np.repeat(np.arange(n), [len(r) for r in rows])
    flat = np.concatenate(rows).astype(np.int64) if len(at) else np.empty(0, dtype=np.int64)
    size = 1.0 + max((len(r) for r in rows), default=0) + more.shape[1]
    step = 4.0 / min(size, 60.0)
    x = np.zeros(1 + terms + more.shape[1])
    ahead, last = x.copy(), x.copy()
    for turn in range(STEPS):
        raw = ahead[0] + np.bincount(at, ahead[1 : 1 + terms][flat], n) + more @ ahead[1 + terms :]
        gap = (1 / (1 + np.exp(-raw.clip(-30, 30))) - y) / n
        slope = np.concatenate(([gap.sum()], np.bincount(flat, gap[at], terms), more.T @ gap))
        slope[1:] += PENALTY * ahead[1:]
        x = ahead - step * slope
        ahead = x + turn / (turn + 3) * (x - last)
        last = x
    return float(x[0]), x[1 : 1 + terms], x[1 + terms :]


def choose_terms(rows: list[np.ndarray], labels: np.ndarray, most: int = MOST_TERMS) -> dict[int, int]:
    """The terms (numbers) that tell best whether a row has any category, and their places."""
    at = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    names, place, seen = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    kept = seen >= LEAST_ROWS
    if not kept.any():
        return {}
    in_some = kept[place]
    place, at = (np.cumsum(kept) - 1)[place[in_some]], at[in_some]
    names, total = names[kept], seen[kept]
    # Rows of any category against the others: what tells categories apart only
    # (a language, say) would crowd out what they have in common.
    y = labels.max(axis=1)
    inside = np.bincount(place, y[at], len(names))
    a, b, c, d = inside, total - inside, y.sum() - inside, len(y) - y.sum() - (total - inside)
    odds = np.log((a + 0.5) * (d + 0.5) / ((b + 0.5) * (c + 0.5)))
    worth = np.abs(odds) / np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5) + 1 / (c + 0.5) + 1 / (d + 0.5))
    best = np.argsort(-worth, kind="stable")[:most]
    best = best[worth[best] >= LEAST_WORTH]
    return {int(t): i for i, t in enumerate(sorted(names[best].tolist()))}


def fit(rows: list[np.ndarray], labels: np.ndarray, folds: np.ndarray, categories: Sequence[str]) -> Chain:
    """Fit a chain on rows of term numbers; ``labels`` is (rows, categories)."""
    terms = choose_terms(rows, labels) if len(rows) else {}
    placed = [np.array([terms[t] for t in r.tolist() if t in terms], dtype=np.int64) for r in rows]
    chain = Chain(list(categories), terms, [], [], [])
    earlier = np.zeros((len(rows), 0))
    for k in range(len(categories)):
        y = labels[:, k] if len(rows) else np.zeros(0)
        out_of_fold = np.zeros(len(rows))
        for fold in range(FOLDS):
            inside, outside = np.flatnonzero(folds == fold), np.flatnonzero(folds != fold)
            bias, weights, chained = _fit_linear([placed[i] for i in outside], earlier[outside], y[outside], len(terms))
            raw = [bias + weights[placed[i]].sum() for i in inside] + earlier[inside] @ chained
            out_of_fold[inside] = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
        bias, weights, chained = _fit_linear(placed, earlier, y, len(terms))
        chain.intercepts.append(bias)
        chain.weights.append(weights)
        chain.chained.append(chained)
        earlier = np.column_stack((earlier, out_of_fold))
    return chain


def _termed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for text in batch.column("text").to_pylist():
            terms = {_number(t) for w in words_of(text) for t in terms_of_word(w)}
            found.append(np.array(sorted(terms), dtype=np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("labels"), pa.array(found, pa.list_(pa.int32()))],
            names=["doc_id", "labels", "terms"],
        )


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, F.Column],
    id_column: str = "doc_id",
    text_column: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> Chain:
    """Fit on about ``sample_rows`` labelled documents at most.

    ``categories``: name to condition, over the columns of ``labels`` and ``docs``
    joined by id, in the order of the chain. Rows where one is null are left out.
    """
    workers_import(docs.sparkSession)
    known = labels.where(F.col(id_column).isNotNull())
    ids = known.select(id_column).distinct()
    rate = min(1.0, sample_rows / max(1, ids.count()))
    in_sample = F.pmod(F.xxhash64(id_column), F.lit(1 << 30)) < F.lit(int(rate * (1 << 30)))
    names = [c for c in docs.columns if c not in labels.columns or c in (id_column, text_column)]
    # The chosen ids are bounded by ``sample_rows``, and so is all that follows:
    # documents and flags are one per id before they meet.
    taught = docs.select(*names).join(F.broadcast(ids.where(in_sample)), id_column, "left_semi")
    order = F.struct(F.xxhash64(text_or_empty(text_column)), F.to_json(F.struct(*names)))
    one_each = taught.groupBy(F.col(id_column).alias("doc_id")).agg(F.min_by(F.struct(*names), order).alias("doc"))
    one_each = stored(one_each, "taught")
    beside = [c for c in names if c != text_column or text_column not in labels.columns]
    flags = [c.cast("int") for c in categories.values()]
    judged = one_each.select(*[F.col("doc")[c].alias(c) for c in beside]).join(known.where(in_sample), id_column)
    judged = judged.select(F.col(id_column).alias("doc_id"), *[f.alias(f"flag{k}") for k, f in enumerate(flags)])
    judged = judged.dropna().groupBy("doc_id").agg(
        F.array(*[F.max(f"flag{k}") for k in range(len(flags))]).alias("labels")
    )
    rows = one_each.select("doc_id", text_or_empty(F.col("doc")[text_column]).alias("text")).join(judged, "doc_id")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(_termed, f"doc_id {id_type}, labels array<int>, terms array<int>").toArrow()
    places = sorted(range(found.num_rows), key=lambda i: str(found["doc_id"][i]))
    one = {
        found["doc_id"][i].as_py(): (found["terms"][i].values.to_numpy(), np.array(found["labels"][i].as_py(), dtype=float))
        for i in places
    }
    y = np.array([v[1] for v in one.values()]).reshape(len(one), len(categories))
    folds = np.array([zlib.crc32(str(k).encode()) % FOLDS for k in one], dtype=np.int64)
    return fit([v[0] for v in one.values()], y, folds, list(categories))


def scorer(chain: Chain):
    """A column function: text to the probabilities of all categories."""
    @F.pandas_udf("array<double>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, tuple[int, ...]] = {}
        for texts in batches:
            rows = []
            for text in texts:
                places: set[int] = set()
                for word in words_of(text or ""):
                    own = known.get(word)
                    if own is None:
                        numbers = map(_number, terms_of_word(word))
                        own = tuple(chain.terms[n] for n in numbers if n in chain.terms)
                        if len(known) >= MOST_WORDS:
                            known.clear()
                        known[word] = own
                    places.update(own)
                rows.append(np.array(sorted(places), dtype=np.int64))
            yield pd.Series(list(chain.probabilities(rows)))

    return score
