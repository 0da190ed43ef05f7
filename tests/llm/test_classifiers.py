"""What the classifiers look at."""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right

import numpy as np
from pyspark.sql import functions as F

from eventmart.llm import quality, toxicity
from eventmart.llm.registry import LANGUAGES, op2_quality_classifier, op7_toxicity


def test_top_word_is_counted_over_the_whole_text():
    def top(text):
        return quality.text_numbers(text)[quality.FEATURES.index("top_word")]

    opening = "an ordinary opening of eight quite different words"
    assert top(opening + " spam" * 32) == 32 / 40
    assert top("a b\na a\na c") == 4 / 6
    assert top("") == top(" \n ") == 0


def test_one_row_per_id_reaches_the_driver(spark, monkeypatch):
    gathered = []
    kind = type(spark.range(0))
    collect, to_arrow = kind.collect, kind.toArrow
    monkeypatch.setattr(kind, "collect", lambda df: gathered.append(found := collect(df)) or found)
    monkeypatch.setattr(kind, "toArrow", lambda df: gathered.append(found := to_arrow(df)) or found)
    rows = [(i, f"word{i % 2} and {j} more", "en") for i in range(20) for j in range(1 if i else 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = [(i, i % 2, (i + j) % 2) for i in range(20) for j in range(1 if i else 30)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    quality.train(docs, labels)
    assert len(gathered.pop()) == 20
    toxicity.train(docs, labels, {"toxic": (F.col("toxic") == 1) & (F.col("lang") == "en")})
    found = gathered.pop()
    assert found.num_rows == 20
    flags = dict(zip(found["doc_id"].to_pylist(), found["labels"].to_pylist(), strict=True))
    assert flags == {i: [1 if i == 0 else i % 2] for i in range(20)}


def taught(spark, sf_dir, column):
    """Texts and labels that may teach, by id, gathered without the operators."""
    texts = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    labels = {r.doc_id: r[column] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    teach = sorted(i for i in labels if zlib.crc32(str(i).encode()) % 4 != 2 and i in texts)
    return texts, labels, teach


def squash(x):
    return 1 / (1 + math.exp(-x))


def test_quality_query_equals_a_plain_scorer(spark, sf_dir):
    texts, labels, teach = taught(spark, sf_dir, "quality")
    numbers = {i: quality.text_numbers(r.text or "") for i, r in texts.items()}
    model = quality.fit(np.array([numbers[i] for i in teach]), np.array([labels[i] for i in teach], dtype=float))

    def plain(x):
        raw = model.intercept
        for edges, table, v in zip(model.edges, model.tables, x, strict=True):
            raw += table[bisect_right(list(edges), v)]
        for (i, j), grid in zip(model.pairs, model.pair_tables, strict=True):
            raw += grid[bisect_right(list(model.pair_edges[i]), x[i])][bisect_right(list(model.pair_edges[j]), x[j])]
        return squash(min(max(raw, -30), 30))

    got = op2_quality_classifier(spark, sf_dir).collect()
    assert {r.doc_id for r in got} == set(texts)
    for r in got:
        assert abs(r.score - plain(numbers[r.doc_id])) < 1e-9
        assert r.predicted == int(r.score >= 0.7) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    known = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in known) / len(known) > 0.9


def test_training_takes_any_id_type(spark):
    rows = [(i, f"word {i} text.", i % 2) for i in range(30)]
    scores = set()
    for kind in ("int", "long", "string"):
        df = spark.createDataFrame(rows, "doc_id long, text string, quality int").withColumn("doc_id", F.col("doc_id").cast(kind))
        scores.add(quality.train(df.select("doc_id", "text"), df.select("doc_id", "quality")).intercept)
    assert len(scores) == 1


def test_toxicity_query_equals_a_plain_chain(spark, sf_dir):
    texts, labels, teach = taught(spark, sf_dir, "toxic")
    of_text = {}
    for i, r in texts.items():
        of_text[i] = {toxicity._number(t) for w in toxicity.words_of(r.text or "") for t in toxicity.terms_of_word(w)}
    flags = {i: [int(labels[i] == 1 and (texts[i].lang or "") == c) for c in LANGUAGES] + [int(labels[i] == 1)] for i in teach}
    order = sorted(teach, key=str)
    chain = toxicity.fit(
        [np.array(sorted(of_text[i]), dtype=np.int32) for i in order],
        np.array([flags[i] for i in order], dtype=float),
        np.array([zlib.crc32(str(i).encode()) % toxicity.FOLDS for i in order]),
        [*LANGUAGES, "toxic"],
    )

    def plain(terms):
        earlier = []
        for bias, weights, chained in zip(chain.intercepts, chain.weights, chain.chained, strict=True):
            raw = bias + sum(weights[chain.terms[t]] for t in terms if t in chain.terms)
            raw += sum(w * p for w, p in zip(chained, earlier, strict=True))
            earlier.append(squash(min(max(raw, -30), 30)))
        return earlier

    for r in op7_toxicity(spark, sf_dir).collect():
        want = plain(of_text[r.doc_id])
        assert max(abs(a - b) for a, b in zip(tuple(r)[2:-1], want, strict=True)) < 1e-6
        assert r.flagged == (r.toxic_score >= toxicity.FLAGGED)
