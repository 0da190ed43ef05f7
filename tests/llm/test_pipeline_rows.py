"""Rows that stay in the pipeline's stages, against brute force on each stage's own input."""

from __future__ import annotations

import json
import random
from collections import defaultdict

import numpy as np

import corpus_pipeline
from eventmart.llm import exact_dedup, quality
from eventmart.llm.tokens import ChunkIds, vocabulary
from test_documents import EDGES, brute_components, brute_cuts, lower


def test_tied_rows_need_no_window(spark):
    rows = [(i, t, "en", "s", n) for i, t in EDGES for n in (2, 1)]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _tie_id long")
    kept = exact_dedup.keep_one(docs)
    assert "Window" not in kept._jdf.queryExecution().executedPlan().toString()
    assert kept.columns == docs.columns
    got = {lower(r.text): tuple(r) for r in kept.collect()}
    assert len(got) == kept.count() == len({lower(t) for _, t in EDGES})
    assert all(row in rows for row in got.values())
    assert all(row[4] == 1 for row in got.values() if row[0] in (7, 8))


def test_stages_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    have = {name: None for name, _ in corpus_pipeline.STAGES}
    before, inputs = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = [r.asDict() for r in before.collect()]
        path = corpus_pipeline.session.work_dir(spark, name)
        stage(spark, before, sf_dir).write.parquet(path)
        before = spark.read.parquet(path)
        have[name] = [r.asDict() for r in before.collect()]

    def same(name, want):
        key = lambda r: json.dumps(r, sort_keys=True, default=str)
        assert sorted(have[name], key=key) == sorted(want, key=key), name

    rows = inputs["quality_classifier"]
    model = quality.train(docs, quality.teaching_labels(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    scores = [float(model.score(np.array([quality.text_numbers(r["text"] or "")]))[0]) for r in rows]
    same("quality_classifier", [r for r, s in zip(rows, scores, strict=True) if s >= quality.ACCEPT])

    rows = inputs["exact_dedup"]
    best = {}
    for r in rows:
        key = lower(r["text"])
        best[key] = max(best.get(key, r), r, key=lambda x: x["doc_id"])
    same("exact_dedup", list(best.values()))

    rows = sorted(inputs["minhash_near_dedup"], key=lambda r: r["doc_id"])
    _, roots = brute_components([(r["doc_id"], r["text"]) for r in rows], 5, 80)
    same("minhash_near_dedup", [r for i, r in enumerate(rows) if roots[i] == i])

    rows = sorted(inputs["substring_dedup"], key=lambda r: r["doc_id"])
    cut = brute_cuts([(r["doc_id"], r["text"]) for r in rows])
    assert any(cut[r["doc_id"]] != r["text"] for r in rows)
    same("substring_dedup", [
        r | {"text": cut[r["doc_id"]], "n_chars": len(cut[r["doc_id"]])} if cut[r["doc_id"]] != r["text"] else r
        for r in rows
    ])

    library = ChunkIds(vocabulary(None)).library
    pieces = defaultdict(list)
    for r in sorted(have["packing"], key=lambda r: r["start"]):
        pieces[r["doc_id"]].append(bytes(r["ids"]))
    want = {r["doc_id"]: [*library.encode(r["text"] or "", add_special_tokens=False).ids, 2] for r in inputs["packing"]}
    assert {i: np.frombuffer(b"".join(p), "<u4").tolist() for i, p in pieces.items()} == want
