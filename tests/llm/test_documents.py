"""Operators on documents against brute force, and their edge cases."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from eventmart.llm import (
    exact_dedup, line_dedup, minhash_dedup, packing, passages, piece_codec, quality, token_files, toxicity,
)
from eventmart.llm.common import maybe_among
from eventmart.llm.tokens import ODD, PIECES, ChunkIds, _even, chunk_ids, vocabulary
from eventmart.session import work_dir
from pyspark.sql import functions as F

EDGES = [
    (1, None), (2, ""), (3, "One two"), (4, "one TWO"), (5, " \t\n"), (6, "É one"), (7, "é one"),
    (7, "é one"), (8, "word " * 3000), (None, "lost id"), (None, "lost id"), (9, "a▁b  c\x1cd <|endoftext|> don't 'S 12"),
]
PASSAGE = " ".join(f"p{i}" for i in range(60))


@pytest.fixture(scope="module")
def edges(spark):
    """Awkward rows, with columns named as results are."""
    return spark.createDataFrame(
        [(i, t, "en", "s", 0, "x", True, 1) for i, t in EDGES],
        "doc_id long, text string, lang string, source string, n_chars long, keep_id string, kept boolean, hash int",
    )


@pytest.fixture(scope="module")
def none(edges):
    return edges.limit(0)


@pytest.fixture(scope="module")
def sample(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# --- exact dedup ---------------------------------------------------------------


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def test_exact_dedup_equals_brute_force(edges):
    groups = defaultdict(list)
    for i, t in EDGES:
        groups[lower(t)].append(i)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    got = exact_dedup.exact_dedup(edges).collect()
    want = sorted(((i, best[lower(t)], len(groups[lower(t)])) for i, t in EDGES), key=repr)
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=repr) == want
    assert sum(r.kept for r in got) == len(groups)


def test_exact_dedup_splits_buckets(sample):
    found = exact_dedup.exact_dedup(sample, capacity=5, start_depth=1, max_depth=10).collect()
    depths = defaultdict(set)
    for r in found:
        depths[(r.depth, r.bucket)].add(r.text_sha256)
    assert max(d for d, _ in depths) > 4
    assert all(len(keys) <= 5 for (d, _), keys in depths.items() if d < 10)


def test_exact_dedup_index_owns_the_texts(spark):
    """At its own capacity the directory doubles on the sf0.1 table, and look-ups go through it."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    entries, index = exact_dedup.build_index(docs)
    sizes = index.groupBy("depth", "bucket").agg(F.countDistinct("hash").alias("n")).collect()
    assert max(r.depth for r in sizes) > exact_dedup.START_DEPTH and max(r.n for r in sizes) <= exact_dedup.CAPACITY
    assert index.count() == index.select(exact_dedup.KEY).distinct().count()
    assert entries.join(index, exact_dedup.KEY).count() == entries.count()


def test_exact_dedup_writes_repeats_out_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "CHUNK", 3)
    rows = [(1, "a")] * 10 + [(2, "A")] * 7 + [(None, "b")] * 4 + [(3, "c")]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size) for r in got) == sorted(
        [(1, 2, 17)] * 10 + [(2, 2, 17)] * 7 + [(0, 0, 4)] * 4 + [(3, 3, 1)]
    )
    assert sorted((r.doc_id or 0) for r in got if r.kept) == [0, 2, 3]


def test_keep_one_keeps_columns_and_one_of_each(edges, none):
    kept = exact_dedup.keep_one(edges)
    assert kept.columns == edges.columns
    assert sorted(lower(t) for _, t in texts(kept)) == sorted({lower(t) for _, t in EDGES})
    assert exact_dedup.keep_one(none).count() == 0


# --- near-dedup ------------------------------------------------------------------


def shingle_set(text, k):
    words = [w.decode() for w in (text or "").encode().lower().split()]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute_components(rows, k, percent):
    sets = [shingle_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return sets, [root(x) for x in range(len(rows))]


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_minhash_equals_brute_force(sample, k, percent):
    rows = sorted(texts(sample))
    sets, roots = brute_components(rows, k, percent)
    want = {(i, len(s), rows[r][0]) for (i, _), s, r in zip(rows, sets, roots, strict=True)}
    got = minhash_dedup.minhash_classes(sample, percent, k).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_minhash_large_groups_in_blocks(spark, monkeypatch):
    """Chains of near copies, compared in blocks smaller than the group."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", 250)
    given_off = []
    keep = minhash_dedup.stored
    monkeypatch.setattr(minhash_dedup, "stored", lambda df, name: given_off.append((name, out := keep(df, name))) or out)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.integers(0, 4)):
            words[rng.integers(0, 60)] = f"x{rng.integers(0, 9)}"
        rows.append((i, " ".join(words)))
    sets, roots = brute_components(rows, 3, 85)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash_dedup.minhash_classes(docs, 85, 3).collect()}
    assert got == {i: rows[r][0] for (i, _), r in zip(rows, roots, strict=True)}
    # Every bucket unit gives off fewer links than it has members.
    assert all(df.count() < 60 * 20 * 2 for name, df in given_off if name == "links")


def test_minhash_links_of_a_group_are_a_forest():
    import pandas as pd

    n = 40
    sets = [np.arange(100, dtype=np.int64) + (i % 3) for i in range(n)]
    unit = pd.DataFrame(
        {"unit": 1, "side": 2, "node": [bytes([i]) for i in range(n)], "n": 100, "comp": [bytes([i]) for i in range(n)], "shingles": sets}
    )
    links = pd.concat(minhash_dedup._linked_in_blocks(85)(iter([unit])))
    assert len(links) == n - 1


def test_minhash_edges(edges, none):
    got = minhash_dedup.minhash_classes(edges, 85, 3).collect()
    size = {(r.doc_id, r.n_shingles) for r in got}
    assert {(1, 0), (2, 0), (5, 0), (3, 1), (8, 1)} <= size
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == {
        1: 1, 2: 2, 3: 3, 4: 3, 5: 5, 6: 6, 7: 7, 8: 8, 9: 9,
    }
    assert minhash_dedup.minhash_classes(none).count() == 0
    kept = minhash_dedup.keep_one_each(edges)
    assert kept.columns == edges.columns
    assert 4 not in {i for i, _ in texts(kept)}


# --- line dedup ------------------------------------------------------------------


def test_lines_cut_passages_and_keep_offsets(spark, none):
    rows = [
        (1, f"first\n{PASSAGE}\nend"), (2, f"second\n{PASSAGE.upper()}  \nrest"), (3, PASSAGE), (4, "first"),
        (5, f"a\n\n{PASSAGE}\n\n{PASSAGE}\nb"), (6, None), (7, ""), (8, "\n\n"),
    ]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, cuts int")
    got = {r.doc_id: r for r in line_dedup.drop_repeats(docs).collect()}
    assert {i: r.text for i, r in got.items()} == {
        1: rows[0][1], 2: "second\nrest", 3: "", 4: "first", 5: "a\n\nb", 6: None, 7: "", 8: "\n\n",
    }
    for i, text in rows:
        spans = got[i].repeats.kept_spans
        assert "\n".join(text[s.start : s.end] for s in spans) == got[i].text if text else not spans
    assert [got[i].repeats.n_cut for i in (1, 2, 3, 5)] == [0, 1, 1, 1]
    assert got[1].cuts == 7
    assert line_dedup.drop_repeats(none).count() == 0


def test_lines_equal_brute_force(sample):
    rows = sorted(texts(sample))
    first = {}
    for i, t in rows:
        for u, (digest, *_) in enumerate(line_dedup.line_units(t)):
            first.setdefault(digest, (i, u))
    want = {}
    for i, t in rows:
        cuts, run = 0, 0
        for u, (digest, _, _, words) in enumerate([*line_dedup.line_units(t), (None, 0, 0, 0)]):
            if digest is not None and first[digest] != (i, u):
                run += words
            else:
                cuts, run = cuts + (run >= 50), 0
        want[i] = cuts
    got = {r.doc_id: r.repeats.n_cut for r in line_dedup.drop_repeats(sample).collect()}
    assert got == want


def brute_cuts(rows, n=50):
    """Texts after the cut by all windows of ``n`` words and all runs of lines."""
    found = {i: [(m.start(), m.end(), m.group().encode().lower()) for m in re.finditer(r"[^ \t\n\r\v\f]+", t)] for i, t in rows}
    windows, lines, kept = {}, {}, {}
    for i, t in rows:
        words, spans = found[i], []
        for p in range(len(words) - n + 1):
            of, at = windows.setdefault(tuple(w for _, _, w in words[p : p + n]), (i, p))
            if (of, at) != (i, p):
                first = max(p, at + n) if of == i else p
                spans.append((words[first][0], words[p + n - 1][1]))
        run = []
        for u, (digest, start, end, size) in enumerate([*line_dedup.line_units(t), (None, 0, 0, 0)]):
            if digest is not None and lines.setdefault(digest, (i, u)) != (i, u):
                run.append((start, end, size))
                continue
            if sum(s for *_, s in run) >= n:
                spans.append((run[0][0], run[-1][1]))
            run = []
        pieces, at = [], 0
        for start, end in sorted(spans):
            pieces.append((at, start - 1))
            at = max(at, end + 1)
        pieces = [(a, b) for a, b in [*pieces, (at, len(t))] if b > a]
        kept[i] = "\n".join(t[a:b] for a, b in pieces) if spans else t
    return kept


def test_only_rows_that_may_match_are_moved(spark):
    hashed = F.xxhash64("id")
    docs = spark.range(5000).withColumn("other", F.lit(1))
    some = spark.range(0, 5000, 50).select(hashed.alias("h"))
    marked = maybe_among(docs, hashed, some, "h", "near")
    assert marked.columns == ["id", "other", "near"] and marked.count() == 5000
    near = {r.id for r in marked.where("near").collect()}
    assert near >= set(range(0, 5000, 50)) and len(near) < 200
    assert maybe_among(docs, hashed, some.limit(0), "h", "near").where("near").count() == 0


def test_passages_inside_lines(spark):
    broken = PASSAGE.replace(" p30 ", "\np30\t ").replace("p9 ", "P9  ")
    rows = [
        (1, f"é before {PASSAGE} after it"), (2, f"ü other words {broken} and more\nend"),
        (3, " ".join(PASSAGE.split()[:49]) + " of forty-nine"), (4, f"x {' '.join(PASSAGE.split()[5:55])} y"),
        (5, "again " * 130), (6, f"{PASSAGE} {PASSAGE.replace('p59', 'q')}"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.drop_repeats(docs).collect()}
    assert [got[i].text for i in (1, 2, 3, 4)] == [rows[0][1], "ü other words\nand more\nend", rows[2][1], "x\ny"]
    assert got[5].text == " ".join(["again"] * 50) and got[6].text == "q"
    assert {i: r.text for i, r in got.items()} == brute_cuts(rows)
    for i, text in rows:
        assert "\n".join(text[s.start : s.end] for s in got[i].repeats.kept_spans) == got[i].text


def test_passages_equal_brute_force(sample):
    rows = sorted((i, t or "") for i, t in texts(sample))
    got = {r.doc_id: r.text or "" for r in line_dedup.drop_repeats(sample).collect()}
    assert got == brute_cuts(rows)


# --- tokens: packing and files ------------------------------------------------------


@pytest.fixture(scope="module")
def library_ids():
    library = ChunkIds(vocabulary(None)).library
    return lambda text: [*library.encode(text or "", add_special_tokens=False).ids, 2]


def test_chunks_equal_the_library(sample, library_ids):
    own = ChunkIds(vocabulary(None), most=500)
    odd = [t for _, t in EDGES] + ["İstanbul ß ÀÉ ſ", "é é", "x y z", "日本語 テスト", "¼ ² ª º µ", "I'LL we're 'tis"]
    for text in odd + [t for _, t in texts(sample)[:100]]:
        assert np.frombuffer(own.encode(text or ""), "<u4").tolist() == library_ids(text)[:-1], text


def test_texts_encoded_together_look_a_word_up_once(sample, monkeypatch):
    rows = [t or "" for _, t in EDGES] + ["", " \n ", "日本語 テスト", "<|x|> y"] + [t or "" for _, t in texts(sample)[:100]]
    alone = ChunkIds(vocabulary(None))
    want = [alone.encode(t) for t in rows]
    for chars in (1, 300, 1 << 20):  # texts in slices of their own, of a few, in one
        monkeypatch.setattr("eventmart.llm.tokens.SLICE_CHARS", chars)
        assert list(ChunkIds(vocabulary(None), most=500).encode_all(rows)) == want
    together, asked = ChunkIds(vocabulary(None)), []
    word = together.known.make
    together.known = type("Counted", (dict,), {"__missing__": lambda _, w: asked.append(w) or word(w)})()
    assert b"".join(together.encode_all(["one two one"] * 1000)) == alone.encode("one two one") * 1000
    assert sorted(asked) == ["one", "two"]


def test_packing(sample, edges, none, library_ids):
    for docs in (sample, edges):
        pieces = packing.pack_documents(docs).toPandas()
        full = pieces.sort_values("offset").groupby("sequence_id")
        assert (full["length"].sum() <= 4096).all()
        lengths = full["length"].sum()
        assert ((lengths & (lengths - 1)) == 0).all()  # powers of two: nothing is padded
        assert all((g["offset"] == g["length"].cumsum() - g["length"]).all() for _, g in full)
        got = defaultdict(int)
        for r in pieces.itertuples():
            got[None if r.doc_id != r.doc_id else r.doc_id] += r.length
        want = defaultdict(int)
        for i, t in texts(docs):
            want[i] += len(library_ids(t))
        assert got == want
    rows = dict(texts(sample))
    for i, g in packing.pack_documents(sample).toPandas().sort_values("start").groupby("doc_id"):
        assert np.frombuffer(b"".join(g["ids"]), "<u4").tolist() == library_ids(rows[i])
    assert packing.pack_documents(none).count() == 0


def test_packing_tasks_leave_no_table_behind(monkeypatch, library_ids):
    context = SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0))
    monkeypatch.setattr(packing, "TaskContext", context)
    rows = ["one two", "", "three four"]
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": rows})
    packed = packing._packer(vocabulary(None), 2, packing.TIERS, packing.STEP_TOKENS)(iter([batch]))
    assert sum(sum(b.column("length").to_pylist()) for b in packed) == sum(len(library_ids(t)) for t in rows)
    assert not chunk_ids(vocabulary(None)).known


def test_passage_units_are_the_same_in_any_slices(monkeypatch):
    rows = [f"{i % 7} a b c d e {i}" * (i % 5) for i in range(60)]
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": [*range(60)], "text": rows, "text_hash": [*range(60)], "size": [len(t.encode()) for t in rows]}
    )
    found = []
    for size in (1, 200, 1 << 20):
        monkeypatch.setattr(passages, "SLICE_BYTES", size)
        found.append([r for b in passages._units(8)(iter([batch])) for r in b.to_pylist()])
    assert found[0] and found[0] == found[1] == found[2]


def test_step_groups_weigh_the_same():
    lengths = [4096] * 200 + [512] * 333 + [2048] * 77
    dealt = np.bincount(packing.step_groups(lengths), lengths)
    assert len(dealt) > 2 and dealt.max() - dealt.min() <= 4096


def test_token_files(spark, sample, edges, none, library_ids):
    for docs in (sample, edges):
        path = work_dir(spark, "files")
        token_files.write_tokens(docs, path, block_ids=5000)
        got = token_files.read_tokens(spark, path).orderBy("start").collect()
        place = 0
        rows = sorted(texts(docs), key=lambda r: (r[0] is not None, r[0] or 0))
        assert [r.doc_id for r in got] == [i for i, _ in rows]
        for r in got:
            assert (r.start, r.ids_crc32) == (place, zlib.crc32(bytes(r.ids)))
            place += r.n_tokens
        assert sorted(bytes(r.ids) for r in got) == sorted(np.array(library_ids(t), "<u4").tobytes() for _, t in rows)
    path = work_dir(spark, "files")
    token_files.write_tokens(none, path)
    assert token_files.read_tokens(spark, path).count() == 0


def test_even_characters_are_those_not_odd():
    for text in (c for i in range(0x300) for c in (chr(i), f"a{chr(i)}B")):
        assert _even(text) == (ODD.search(text) is None), text
        for word in text.lower().split() if _even(text) else ():
            assert not word.isalpha() or PIECES.findall(word) == [word]


# --- SentencePiece --------------------------------------------------------------------


def test_pieces_equal_the_library(spark, sample, edges, none):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=piece_codec.model_file(None))
    for docs in (sample, edges):
        rows = [(i, t or "") for i, t in texts(docs)]
        encoded = piece_codec.encode_texts(docs)
        got = sorted((tuple(r.ids) for r in encoded.collect()), key=repr)
        # The blank sign itself is written as bytes here and lost there.
        want = [(t, tuple(library.encode(t))) for _, t in rows if "▁" not in t]
        assert set(w for _, w in want) <= set(got) and len(got) == len(rows)
        back = piece_codec.decode_ids(encoded)
        assert sorted(r.text for r in back.collect()) == sorted(t for _, t in rows)
        assert all(r.same_text for r in piece_codec.round_trip(docs).collect())
    assert piece_codec.encode_texts(none).count() == 0


def test_search_window_is_bounded(sample):
    own = piece_codec.PieceCodec(piece_codec.model_file(None))
    text = "".join(t.replace(" ", "") for _, t in texts(sample)[:40])
    ids = own.encode(text).tolist()
    assert own.decode(ids) == text
    assert own.viterbi.widest <= 4 * own.viterbi.longest < len(text)


def test_words_are_searched_once_whatever_stands_beside_them():
    import sentencepiece

    own = piece_codec.PieceCodec(piece_codec.model_file(None))
    library = sentencepiece.SentencePieceProcessor(model_file=piece_codec.model_file(None))
    searched, whole = [], own.viterbi.whole
    own.viterbi.whole = lambda part: searched.append(part) or whole(part)
    text = " ".join(f"{before}harbourwerk{after}" for before in ("", "(", '"') for after in ("", ".", ",", "!!", ".\nUnd", " "))
    assert own.encode(text).tolist() == library.encode(text)
    assert len(searched) == len(set(searched)) and searched.count("▁harbourwerk") == 1
    rng = np.random.default_rng(5)
    for size in rng.integers(0, 90, 2000):
        text = "".join(rng.choice(list("ab eE  \n\tth(){}=*/#.,'103é中ñx$-_"), size))
        assert own.encode(text).tolist() == library.encode(text), text


# --- classifiers ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    root = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/labels.parquet")


def test_quality_on_held_out_rows(labelled, edges, none):
    docs, labels = labelled
    model = quality.train(docs, quality.teaching_labels(labels), sample_rows=2000)
    judged = docs.join(labels.where(quality.held_out("doc_id")), "doc_id").select(
        "quality", quality.scorer(model)("text").alias("s")
    )
    rows = judged.collect()
    right = sum((r.s >= quality.ACCEPT) == (r.quality == 1) for r in rows)
    assert right / len(rows) > 0.97
    assert len(model.pairs) == quality.PAIRS
    scores = [r[0] for r in edges.select(quality.scorer(model)(F.coalesce("text", F.lit("")))).collect()]
    assert len(scores) == len(EDGES) and all(0 <= s <= 1 for s in scores)
    assert none.select(quality.scorer(model)("text")).count() == 0


def test_quality_without_labels(edges, labelled):
    empty = quality.train(edges, labelled[1].limit(0))
    assert empty.score(np.zeros((1, len(quality.FEATURES)))).tolist() == [0.5]


def test_toxicity_on_held_out_rows(labelled, edges, none):
    docs, labels = labelled
    toxic = F.col("toxic") == 1
    categories = {"toxic_en": toxic & (F.col("lang") == "en"), "toxic": toxic}
    chain = toxicity.train(docs, quality.teaching_labels(labels), categories)
    judged = docs.join(labels.where(quality.held_out("doc_id")), "doc_id").select(
        "toxic", toxicity.scorer(chain)("text").alias("p")
    )
    rows = judged.collect()
    flagged = [(r.p[1] >= toxicity.FLAGGED, r.toxic == 1) for r in rows]
    assert sum(f == t for f, t in flagged) / len(flagged) > 0.97
    assert sum(f and not t for f, t in flagged) <= 0.01 * len(flagged)
    assert len(chain.chained[1]) == 1
    assert edges.select(toxicity.scorer(chain)(F.coalesce("text", F.lit(""))).alias("p")).where("size(p) = 2").count() == len(EDGES)
    assert none.select(toxicity.scorer(chain)("text")).count() == 0


def test_toxicity_without_labels(edges, labelled):
    chain = toxicity.train(edges, labelled[1].limit(0), {"toxic": F.col("toxic") == 1})
    assert edges.select(toxicity.scorer(chain)("text").alias("p")).where("p[0] > 0.011").count() == 0
