"""Vectors, URLs, the id coder, components and the pipeline."""

from __future__ import annotations

import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline
from eventmart.llm import embedding_dedup, url_filter
from eventmart.llm.components import components
from eventmart.llm.id_coder import DamagedBlock, _by_lane, _by_step, decode_block, encode_block
from eventmart.llm.registry import URL_RULES


# --- embeddings -------------------------------------------------------------------


def near_vectors(seed=3, size=64):
    """Clusters at many cosines about the threshold, copies and odd rows."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(60):
        centre = rng.standard_normal(size)
        for spread in (0.0, 0.0, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35):
            v = centre / np.linalg.norm(centre) + spread * rng.standard_normal(size) / np.sqrt(size)
            rows.append((len(rows), (v * rng.uniform(0.5, 2)).astype(np.float32).tolist(), c % 4))
    hot = rng.standard_normal(size).astype(np.float32).tolist()
    rows += [(len(rows) + i, hot, 1) for i in range(120)]
    odd = [None, [], [0.0] * size, [float("nan")] * size, [float("inf")] + [1.0] * (size - 1), [None] + [1.0] * (size - 1)]
    rows += [(1000 + i, v, 1) for i, v in enumerate(odd)]
    rows += [(1100, hot, None), (1101, hot[:32], 1)]
    return rows


def brute_links(rows, threshold):
    links = {i: set() for i, _, _ in rows}
    ok = [
        (i, np.array(v, dtype=float), label)
        for i, v, label in rows
        if label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)
    ]
    for a, (i, x, lx) in enumerate(ok):
        for j, y, ly in ok[:a]:
            if lx == ly and len(x) == len(y) and x @ y >= threshold * np.sqrt(x @ x) * np.sqrt(y @ y):
                links[i].add(j)
                links[j].add(i)
    return links


def test_vectors_against_brute_force(spark):
    rows = near_vectors()
    want = brute_links(rows, 0.93)
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, n_links int")
    got = {r.vec_id: r for r in embedding_dedup.link_vectors(df).collect()}
    assert set(got) == set(want)
    found, all_ = sum(r.n_links for r in got.values()), sum(map(len, want.values()))
    assert 0.97 * all_ <= found <= all_
    assert all(r.n_links <= len(want[i]) for i, r in got.items())
    assert got[len(rows) - 9].n_links == 119
    assert all(got[i].n_links == 0 and got[i].kept for i in (1000, 1001, 1002, 1003, 1004, 1005, 1100, 1101))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert embedding_dedup.link_vectors(df.limit(0)).count() == 0


def test_vectors_in_blocks(spark, monkeypatch):
    """Full cells in many units give the same links."""
    rows = near_vectors(seed=8)[:400]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    once = sorted(map(tuple, embedding_dedup.link_vectors(df).collect()))
    monkeypatch.setattr(embedding_dedup, "BLOCK", 3)
    assert sorted(map(tuple, embedding_dedup.link_vectors(df).collect())) == once


def test_lattice_points_are_the_nearest():
    steps = embedding_dedup.shortest_steps()
    assert steps.shape == (240, 8) and np.allclose((steps**2).sum(axis=1), 2)
    x = np.random.default_rng(1).uniform(-3, 3, (500, 8))
    point = embedding_dedup.nearest_point(x)
    distance = ((x - point) ** 2).sum(axis=1)
    assert (distance <= 1 + 1e-9).all()  # the covering radius
    assert all(((x - point - s) ** 2).sum(axis=1).min() >= 0 and (((x - point - s) ** 2).sum(axis=1) >= distance - 1e-9).all() for s in steps)


# --- components -----------------------------------------------------------------------


def test_components_of_chains_hubs_and_loops(spark):
    pairs = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(200)] + [(5000, 5000), (7, 6)]
    found = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert len({found[i] for i in range(301)}) == 1 and len({found[1000 + i] for i in range(1, 200)}) == 1
    assert found[0] != found[1000] and 5000 not in found
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- URLs -------------------------------------------------------------------------------


def test_url_rules_and_list(spark):
    urls = {
        1: ("https://www.A.Example.NET/en/x?q#f", "www.a.example.net", "/en/x", "example.net/en/", "allow"),
        2: ("http://b.net/x", "b.net", "/x", "net/", "block"),
        3: ("http://b.net", "b.net", "", None, "allow"),
        4: ("x", "", "", None, "allow"),
        5: (None, "", "", None, "allow"),
        6: ("http://internet/", "internet", "/", None, "allow"),
        7: ("ftp://example.com/de/1", "example.com", "/de/1", "example.com/de/", "block"),
        8: ("http://m.listed.org/page.html?x=1", "m.listed.org", "/page.html", None, "block"),
        9: ("http://listed.org/page/", "listed.org", "/page/", None, "block"),
        10: ("http://q.org/fr/://z", "q.org", "/fr/://z", "org/fr/", "allow"),
        11: ("http://ÄB.org?x://y/", "Äb.org", "", None, "allow"),
        12: ("http://example.net/en", "example.net", "/en", "net/", "block"),
    }
    pages = spark.createDataFrame([(i, u[0], "v") for i, u in urls.items()] * 2, "page_id long, url string, verdict string")
    listed = spark.createDataFrame([("listed.org/page",), ("listed.org/page",), (None,)], "url string")
    got = url_filter.filter_urls(pages, URL_RULES, listed).collect()
    assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got if r.page_id) == sorted(
        [(i, *u[1:]) for i, u in urls.items()] * 2, key=lambda r: (r[0], r[1])
    )
    assert url_filter.filter_urls(pages.limit(0), URL_RULES, listed).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(pages, [], listed.limit(0)).collect()} == {"allow"}


def test_full_filter_is_still_exact(spark):
    """With one block nearly every URL may be listed; the join has the last word."""
    pages = spark.range(2000).selectExpr("id as page_id", "concat('http://h.org/', id) as url")
    listed = spark.range(0, 2000, 7).selectExpr("concat('h.org/', id)")
    got = url_filter.filter_urls(pages, [], listed, blocks=1).collect()
    assert sum(r.possible for r in got) > 1500
    assert {r.page_id for r in got if r.verdict == "block"} == set(range(0, 2000, 7))


# --- id coder -----------------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 2, 5, 255, 256, 513, 5000, 70_001])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 49_408, n), np.minimum(rng.geometric(0.01, n), 300), np.full(n, 49_407), np.arange(n) % 7):
        block = encode_block(ids, 49_408)
        assert (decode_block(block) == ids).all()


@pytest.mark.parametrize("n, lanes", [(1, 1), (5, 5), (6, 5), (9, 5), (10, 5), (1000, 7)])
def test_lanes_are_runs_of_ids(n, lanes):
    ids = np.arange(n, dtype="<u4")
    steps = _by_step(ids, lanes)
    assert steps.shape == (-(-n // lanes), lanes) and (_by_lane(steps, n) == ids).all()
    assert (np.diff(steps[: n // lanes].astype(int), axis=0) == 1).all()


def test_predictable_ids_take_little_room():
    ids = np.tile(np.arange(500), 200)
    assert len(encode_block(ids, 49_408)) < 0.25 * len(ids)


def test_damage_is_found():
    block = encode_block(np.arange(3000) % 50, 100)
    for place in (0, 5, 12, 24, 40, len(block) - 1):
        bad = bytearray(block)
        bad[place] ^= 1
        with pytest.raises((DamagedBlock, ValueError, IndexError, MemoryError)):
            decode_block(bytes(bad))
    with pytest.raises(DamagedBlock):
        decode_block(block[:10])


# --- pipeline -------------------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    """Each stage's effect on planted rows, and the columns it returns."""
    root = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{root}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "minhash_near_dedup", "substring_dedup", "packing",
    ]
    sizes = [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, root).write.parquet(f"{tmp_path}/{i}")
        after = spark.read.parquet(f"{tmp_path}/{i}")
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        docs = after
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[4]
    assert docs.where("n_chars != length(text)").count() == 0
    pieces = corpus_pipeline.run(spark, root)
    assert pieces.selectExpr("count(distinct doc_id)").first()[0] == sizes[-1]


def test_pipeline_stages_on_awkward_tables(spark, tmp_path):
    columns = "doc_id long, text string, lang string, source string, n_chars long, repeats string, kept boolean, _id int"
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x y z"), (4, "word " * 500)]
    root = "/root/testdata/sf0.01"
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "r", True, 9) for i, t in rows], columns)
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, root)
            found = out.count()
            if name != "packing":
                assert out.columns == table.columns and found <= table.count()
            assert (found == 0) == (table.count() == 0) or name == "quality_classifier"
