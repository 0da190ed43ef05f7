"""Suffix dedup, centroid clustering and conversation repair against brute force."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest

from conftest import SF_DIR
from eventmart.llm import centroid_clustering, conversation_repair, suffix_dedup

# --- suffix dedup ------------------------------------------------------------------


def brute_cut(rows, length):
    """(id, spans, what is left) of each row, from all strings of ``length`` bytes."""
    last = float("inf")
    rank = lambda i: last if i is None else i
    first = {}
    for i, text in rows:
        body = (text or "").encode()
        for s in range(len(body) - length + 1):
            key = body[s : s + length]
            first[key] = min(first.get(key, last), rank(i))
    out = []
    for i, text in rows:
        body, spans = (text or "").encode(), []
        for s in range(len(body) - length + 1):
            if first[body[s : s + length]] < rank(i):
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = s + length
                else:
                    spans.append([s, s + length])
        kept, at = b"", 0
        for a, b in spans:
            kept, at = kept + body[at:a], b
        out.append((i, len(body), tuple(map(tuple, spans)), hashlib.sha256(kept + body[at:]).hexdigest()))
    return sorted(out, key=repr)


def cut(docs, **options):
    found = suffix_dedup.find_repeats(docs, **options).collect()
    return sorted(
        ((r.doc_id, r.repeats.n_bytes, tuple((s.start, s.end) for s in r.repeats.spans), r.repeats.kept_sha256) for r in found),
        key=repr,
    )


def test_suffix_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = brute_cut(rows, 50)
    assert cut(docs) == want and any(r[2] for r in want)


@pytest.fixture(scope="module")
def passages():
    """Short alphabets, copies, shared passages, nulls, repeats, periods."""
    rng = np.random.default_rng(3)
    word = lambda n: "".join(rng.choice(list("abé\n"), n))
    shared = [word(40) for _ in range(6)]
    rows = [(i, word(rng.integers(0, 60)) + shared[rng.integers(6)] + word(rng.integers(0, 30))) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(10)] + [(7, rows[3][1]), (7, rows[3][1]), (7, rows[9][1])]
    return rows + [(None, rows[0][1]), (None, "zzz"), (300, None), (301, ""), (302, "x" * 700), (303, "x" * 900), (304, "ab" * 300), (5, "ab" * 200)]


@pytest.mark.parametrize("options", [{}, {"hot_groups": 1, "group_bytes": 512}])
def test_suffix_equals_brute_force(spark, passages, options, monkeypatch):
    """Also with every name treated as hot, every text as common, tiny groups and cut runs."""
    if options:
        monkeypatch.setattr(suffix_dedup, "COMMON", 1)
        monkeypatch.setattr(suffix_dedup, "LONGEST_RUN", 16)
    docs = spark.createDataFrame(passages, "doc_id long, text string").repartition(3)
    for length in (25, 50):
        assert cut(docs, min_length=length, **options) == brute_cut(passages, length)


def test_suffix_columns_and_empty_table(spark, passages):
    docs = spark.createDataFrame([(i, t, 1, "a", 2) for i, t in passages[:9]], "doc_id long, text string, repeats int, suffix_cut string, owner int")
    found = suffix_dedup.find_repeats(docs, min_length=25)
    assert found.columns == [*docs.columns, "_repeats"] and found.count() == 9
    assert found.select(docs.columns).exceptAll(docs).count() == 0
    assert suffix_dedup.find_repeats(docs.limit(0)).count() == 0
    left = found.select("doc_id", suffix_dedup.kept_bytes("text", "_repeats.spans").alias("b"), "_repeats.kept_sha256").collect()
    assert all(hashlib.sha256(r.b).hexdigest() == r.kept_sha256 for r in left)


def test_previous_factors_need_a_smaller_owner():
    rows = np.array([list(b"aaab"), list(b"aaab"), list(b"aaac"), list(b"aaab")], np.uint8)
    assert suffix_dedup.previous_factors(rows, np.array([5, 2, 1, 2])).tolist() == [True, False, False, False]


# --- centroid clustering -------------------------------------------------------------


def brute_clusters(rows, n, k=16, rounds=3, scale=64, seed=1):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == n and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(np.floor(scale * float(x))) for x in v]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in order[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))

    def near(v):
        return min((far(v, c), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        at = [near(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            own = [v for (_, v), a in zip(kept, at, strict=True) if a == j]
            if own:
                centroids[j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in kept), key=repr), centroids


def clusters(df, **options):
    found, centroids = centroid_clustering.cluster_vectors(df, **options)
    return sorted(((r.vec_id, r.cluster, r.distance) for r in found.collect()), key=repr), centroids.tolist()


def test_clusters_equal_brute_force(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    assert clusters(vectors) == brute_clusters(rows, 64)


def test_clusters_with_ties_and_gaps(spark):
    rng = np.random.default_rng(5)
    grid = lambda: [float(x) / 64 for x in rng.integers(-2, 3, 4)]
    rows = [(i, grid()) for i in range(200)] + [(i, grid()) for i in range(5)] + [(None, grid())]
    bad = [(900, None), (901, [1.0]), (902, [1.0, None, 0.0, 0.0]), (903, [float("nan")] * 4), (904, [float("inf"), 0.0, 0.0, 0.0]), (905, [])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + bad], "vec_id long, embedding array<double>, cluster string, whole int")
    found, centroids = centroid_clustering.cluster_vectors(df, components=4, k=9)
    assert found.columns == [*df.columns, "_cluster", "distance"]
    want, middle = brute_clusters(rows, 4, k=9)
    assert sorted(((r.vec_id, r._cluster, r.distance) for r in found.collect()), key=repr) == want
    assert centroids.tolist() == middle
    few = clusters(df.where("vec_id in (1, 900)").drop("cluster"), components=4)
    assert few[0] == [r for r in brute_clusters([x for x in rows if x[0] == 1], 4)[0]]
    assert centroid_clustering.cluster_vectors(df.limit(0), components=4)[0].count() == 0


def test_search_leaves_out_no_nearest():
    rng = np.random.default_rng(8)
    centroids = rng.integers(-50, 50, (40, 8))
    x = np.concatenate((rng.integers(-60, 60, (500, 8)), centroids))
    number, best = centroid_clustering.Centroids(centroids).nearest(x)
    exact = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (best == exact.min(axis=1)).all() and (number == exact.argmin(axis=1)).all()


# --- conversation repair -------------------------------------------------------------

NEXT = {"0": "u", "s": "u", "u": "a", "a": "u"}
FOLLOWS = {"0": "su", "s": "u", "u": "a", "a": "u"}
ROLE = {"u": "user", "a": "assistant"}


def brute_damage(rows):
    out = []
    for c, t, r, x in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if k:
            x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
            out += [(c, t, "user" if k == 4 else r, x)] * (2 if k == 3 else 1)
    return out


def brute_repair(rows):
    """The row of one conversation and its repaired rows, by plain dynamic programming."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("b" if not body else "d" if (role, text) in seen else "" if body[-1] in ".!?" else "t")
        seen.add((role, text))
    none = (10**9, "")

    def with_inserts(v):
        for _ in range(3):
            v = {q: min(v[q], (v[NEXT[q]][0] + 2, "I" + v[NEXT[q]][1])) for q in v}
        return v

    best = with_inserts({"0": (0, ""), "s": none, "u": none, "a": (0, "")})
    for (_, _, role, _), fault in list(zip(rows, faults, strict=True))[::-1]:
        new = {}
        for q in best:
            ways = [(best[q][0] + 3, "D" + best[q][1])]
            if fault not in ("b", "d"):
                more = int(fault == "t")
                if role[:1] and role[:1] in FOLLOWS[q]:
                    ways.append((best[role[0]][0] + more, "K" + best[role[0]][1]))
                ways.append((best[NEXT[q]][0] + 2 + more, "R" + best[NEXT[q]][1]))
            new[q] = min(ways)
        best = with_inserts(new)
    cost, audit = best["0"]
    out, q, i = [], "0", 0
    for letter in audit:
        if letter == "D":
            i += 1
        elif letter == "K":
            q = rows[i][2][0]
            out.append(rows[i][2:])
            i += 1
        else:
            q = NEXT[q]
            out.append((ROLE[q], "" if letter == "I" else rows[i][3]))
            i += letter == "R"
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    sha = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, sha), out


def by_conversation(rows, ids=()):
    groups = {c: [] for c in ids}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    return groups


def test_repair_of_damaged_table(spark):
    table = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = [tuple(r) for r in table.collect()]
    want = {c: brute_repair(g)[0] for c, g in by_conversation(brute_damage(rows), {r[0] for r in rows}).items()}
    damaged = conversation_repair.damage(table)
    got = {r[0]: tuple(r)[1:] for r in conversation_repair.repair_plans(damaged, table).collect()}
    assert got == want
    assert sorted(tuple(r) for r in damaged.selectExpr("conv_id", "turn", "role", "text", "explode(array_repeat(1, int(copies)))").drop("col").collect()) == sorted(brute_damage(rows))


@pytest.fixture(scope="module")
def odd_rows():
    rng = np.random.default_rng(11)
    roles = ["system", "user", "assistant", "tool", "", "User", "uvw", "sys"]
    texts = ["ok.", "no end", " \t\n", "", "why?  \n", "same.", "é!", "x" * 3000]
    rows = [
        (int(c), int(t), roles[rng.integers(8 if c % 3 else 3)], texts[rng.integers(8)])
        for c in range(60) for t in rng.integers(-3, 12, rng.integers(0, 14))
    ]
    rows += [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (400, None, "system", "c."), (400, 1, "user", "d")]
    rows += [(500, t, "user" if t % 2 else "assistant", f"t{t}.") for t in range(700)]
    return rows + [(600, 1, "user", "same.")] * 40 + [(601, 5, "assistant", "z.")]


@pytest.mark.parametrize("block", [conversation_repair.BLOCK_ROWS, 5])
def test_repair_equals_brute_force(spark, odd_rows, block, monkeypatch):
    monkeypatch.setattr(conversation_repair, "BLOCK_ROWS", block)
    df = spark.createDataFrame([(*r, 0, "x") for r in odd_rows], "conv_id long, turn long, role string, text string, conv int, audit string").repartition(5)
    want = {c: brute_repair(g) for c, g in by_conversation(odd_rows).items()}
    got = {r[0]: tuple(r)[1:] for r in conversation_repair.repair_plans(df).collect()}
    assert got == {c: w[0] for c, w in want.items()}
    repaired = {}
    for r in conversation_repair.repaired_rows(df).orderBy("conv_id", "turn").collect():
        repaired.setdefault(r.conv_id, []).append((r.role, r.text))
    assert repaired == {c: w[1] for c, w in want.items() if w[1]}
    assert all(re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in rows)) for rows in repaired.values())


def test_damage_and_repair_of_nulls(spark):
    rows = [(1, None, None, None), (None, None, "user", None), (2, 3, None, "a."), (None, 4, "assistant", "b."), (3, 0, "user", "c.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = {c: brute_repair(g)[0] for c, g in by_conversation(brute_damage(rows), {r[0] for r in rows}).items()}
    assert {r[0]: tuple(r)[1:] for r in conversation_repair.repair_plans(conversation_repair.damage(df), df).collect()} == want
    assert conversation_repair.repair_plans(df.limit(0), df.limit(0)).count() == 0
    nothing = conversation_repair.repair_plans(df.limit(0), df.where("conv_id = 3")).first()
    assert tuple(nothing) == (3, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
