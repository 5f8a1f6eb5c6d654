"""Whitening, vantage-point trees and the prefix trie against plain computations."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from surveyloom.llm import prefix_trie, vptree, whitening

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 8))
    rows = [(i, [float(v) for v in centres[i % 12] + 0.3 * rng.standard_normal(8)]) for i in range(900)]
    hot = rows[7][1]
    rows += [(i, hot) for i in range(900, 1350)]  # a third of all rows
    rows += [(1400, None), (1450, [1.0, None] + [0.0] * 6), (1500, [NAN] * 8), (1550, [INF] * 8), (1600, [0.0] * 8), (1650, []), (None, hot), (1700, [1.0, 2.0])]
    return rows


@pytest.fixture(scope="module")
def embedded(spark, vectors):
    extra = [(i, v, 1, "a", "b", "c", "d") for i, v in vectors]
    return spark.createDataFrame(extra, "vec_id long, embedding array<double>, id int, vec string, x string, n string, length string").repartition(6)


# ---- nearest neighbours ----------------------------------------------------------
def nearest(rows, asked, k):
    good = {i: np.array(v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q in asked:
        if q in good:
            a = good[q]
            scored = sorted((-(a @ b) / np.sqrt((a @ a) * (b @ b)), i) for i, b in good.items() if i != q and len(b) == len(a))
            out[q] = scored[:k]
    return out


def test_factor_one_finds_what_brute_force_finds(spark, vectors, embedded, monkeypatch):
    monkeypatch.setattr(vptree, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(vptree, "LEAF", 16)
    monkeypatch.setattr(vptree, "BLOCK", 7)
    rows = vptree.index(embedded, "vec_id", "embedding")
    assert rows.select("shard").distinct().count() > 3
    asked = rows.filter("id % 10 = 0")
    got = defaultdict(list)
    for r in vptree.neighbours(asked, rows, 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.id, r.score))
    want = nearest(vectors, {i for i, _ in vectors if i is not None and i % 10 == 0}, 5)
    assert got.keys() == {q for q, w in want.items() if w}
    for q, found in got.items():
        assert np.allclose([s for _, s in found], [-s for s, _ in want[q]], atol=1e-12)
        clear = [i for s, i in want[q]]
        ties = len({round(s, 12) for s, _ in want[q]}) < len(want[q])
        assert ties or [i for i, _ in found] == clear
    # the hot vector's copies score equally, so the smallest ids are found
    assert [i for i, _ in got[900]] == [7, 901, 902, 903, 904]


def test_a_larger_factor_skips_more_and_stays_within_it():
    rng = np.random.default_rng(0)
    centres = 4 * rng.standard_normal((40, 6))
    points = np.vstack([c + 0.2 * rng.standard_normal((100, 6)) for c in centres])
    tree = vptree.Tree(np.arange(len(points)), points)
    asked = np.arange(0, len(points), 50)
    exact, who, all_of_it = tree.search(asked, points[asked], 5, 1.0)
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    sims = unit[asked] @ unit.T
    sims[np.arange(len(asked)), asked] = -2
    assert np.allclose(exact, -np.sort(-sims, axis=1)[:, :5], atol=1e-12)
    assert all_of_it < 0.8 * len(asked) * len(points)
    near, found, part = tree.search(asked, points[asked], 5, 2.0)
    assert part < all_of_it
    assert (np.sqrt(2 - 2 * near) <= 2 * np.sqrt(2 - 2 * exact) + 1e-6).all()
    assert np.mean([len(set(a) & set(b)) / 5 for a, b in zip(found, who)]) >= 0.9


def test_repeated_ids_and_huge_components(spark):
    df = spark.createDataFrame([(0, [1e200, 1e200]), (1, [1.0, 1.0]), (1, [0.0, 1.0]), (50, [1e-200, 0.0]), (50, [1e-200, 0.0])], "vec_id long, embedding array<double>")
    rows = vptree.index(df, "vec_id", "embedding")
    got = {(r.query_id, r.id): r.score for r in vptree.neighbours(rows.filter("id % 50 = 0"), rows, 5).collect()}
    half = 1 / np.sqrt(2)
    assert got.keys() == {(0, 1), (0, 50), (50, 0), (50, 1)}
    assert got[0, 1] == pytest.approx(half) and got[0, 50] == pytest.approx(half) and got[50, 1] == 0.0


def test_no_vectors(spark):
    rows = vptree.index(spark.createDataFrame([], "vec_id long, embedding array<float>"), "vec_id", "embedding")
    assert vptree.neighbours(rows, rows, 5).count() == 0


# ---- whitening -------------------------------------------------------------------
@pytest.mark.parametrize("kind", ["spread", "ill", "multiple", "zero", "one", "mixed signs"])
def test_spectral_division_equals_a_dense_solver(kind):
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.standard_normal((20, 20)))[0]
    a = {
        "spread": (lambda x: x.T @ x)(rng.standard_normal((50, 20))), "ill": q @ np.diag(10.0 ** -np.arange(0, 12, 0.6)) @ q.T,
        "multiple": q @ np.diag([3.0] * 5 + [1.0] * 10 + [0.0] * 5) @ q.T, "zero": np.zeros((4, 4)), "one": np.array([[2.0]]),
        "mixed signs": (lambda x: x + x.T)(rng.standard_normal((20, 20))),
    }[kind]
    a = (a + a.T) / 2
    values, v = whitening.eigen(a)
    scale = max(np.abs(a).max(), 1e-300)
    assert np.allclose(values / scale, np.linalg.eigvalsh(a)[::-1] / scale, atol=1e-13)
    assert np.allclose(v.T @ v, np.eye(len(a)), atol=1e-12) and np.allclose(a @ v / scale, v * values / scale, atol=1e-13)


def test_polar_factor_is_the_sign_of_the_spectrum():
    q = np.linalg.qr(np.random.default_rng(2).standard_normal((9, 9)))[0]
    assert np.allclose(whitening.polar(q @ np.diag([-3, -1, -1e-6, 1e-6, 0.5, 1, 2, 3, 4]) @ q.T), q @ np.diag([-1] * 3 + [1] * 6) @ q.T, atol=1e-9)


def test_whitening_against_numpy(spark, vectors, embedded):
    good = [(i, v) for i, v in vectors if v and len(v) == 8 and None not in v and np.isfinite(v).all()]
    x = {j: np.floor(64 * np.array(v)).astype(int) + 1_000_000 for j, (_, v) in enumerate(good)}
    listed = np.array(sorted({tuple(v) for v in x.values()}))
    n, sums = len(listed), listed.sum(axis=0)
    centred = listed - sums / n
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    values, vecs = values[::-1], vecs[:, ::-1]
    want = defaultdict(list)
    for j, (i, _) in enumerate(good):
        want[i].append((int(((n * x[j] - sums) ** 2).sum()), np.abs((x[j] - sums / n) @ vecs / np.sqrt(values))))
    out = whitening.whitened(embedded, "vec_id", "embedding", 3)
    got = defaultdict(dict)
    rows = out.collect()
    assert len(rows) == 3 * len(good)
    for r in rows:
        assert r.n == n and r.identity_error < 1e-9 and r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        assert r.deviation == want[r.vec_id][0][0]
        assert abs(r.whitened) == pytest.approx(want[r.vec_id][0][1][r.component - 1], abs=1e-8)
        got[r.vec_id][r.component] = r.whitened
    unit = np.array([[got[i][c] for c in (1, 2, 3)] for i, _ in good if i is not None])
    assert np.isfinite(unit).all()


def test_whitening_of_little_and_of_much(spark):
    schema = "vec_id long, embedding array<double>"
    make = lambda rows: whitening.whitened(spark.createDataFrame(rows, schema), "vec_id", "embedding").collect()
    assert make([]) == [] and make([(1, None)]) == [] and make([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    two = make([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (None, [1.0, 0.0]), (4, [3.0])])
    assert sorted((r.vec_id or -1, r.component, r.n, r.deviation) for r in two) == [(-1, 1, 2, 4096), (1, 1, 2, 4096), (2, 1, 2, 4096), (2, 1, 2, 4096)]
    assert {abs(round(r.whitened, 12)) for r in two} == {1.0} and two[0].explained == pytest.approx(1.0)
    huge = make([(1, [1e300, 0.0]), (2, [-1e300, 1.0])])
    assert all(r.deviation is None for r in huge) and all(abs(abs(r.whitened) - 1) < 1e-6 for r in huge)


# ---- prefix trie -----------------------------------------------------------------
def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    seqs = {}
    for c, turns in own.items():
        turns.sort(key=lambda t: (t[:3], hashlib.sha256(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).digest()[:16]))
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        source = c - int(np.fmod(c, 100))
        seqs[c] = tuple(t[2:] for t in own.get(source, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = defaultdict(list)
    for s in members:
        if s:
            kids[s[:-1]].append(s)
    leaves, saved = {}, {}
    for s in sorted(members, key=len, reverse=True):
        leaves[s] = sum(leaves[k] for k in kids[s]) or 1
        saved[s] = sum(saved[k] for k in kids[s]) + (len(members[s]) - 1) * (len(s[-1][1]) if s else 0)
    return sorted(
        (min(m), len(s), min(members[s[:-1]]) if s else None, len(m), len(kids[s]), leaves[s], saved[s],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if seqs[c] == s).encode()).hexdigest())
        for s, m in members.items())


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(4)
    rows = []
    for c in [*range(0, 260), *range(500, 560), -7, -100, -150]:
        same = c % 3 == 0  # a third of all begin alike
        for t in range(rng.randint(1, 7)):
            text = "be brief" if t == 0 and same else rng.choice(["hi", "hi there", "ünï 🎉", "", f"own {c}"])
            rows.append((c, t, rng.choice(["user", "assistant"]) if t else "system", text))
    rows += [(c, t, "user", f"copied {t}") for c in range(600, 640) for t in range(4)]  # copies
    rows += [(700, t, "user", f"long {t}") for t in range(300)] + [(701, t, "user", f"long {t}") for t in range(300)]
    rows += [(None, 0, "user", "nobody"), (800, None, None, None), (800, None, "user", "x"), (800, 1, "user", None), (800, 1, "user", None), (801, 0, "user", "é" * 70_000)]
    return rows


@pytest.mark.parametrize("nodes", [50_000, 40])
def test_trie_against_plain_python(spark, talks, monkeypatch, nodes):
    monkeypatch.setattr(prefix_trie, "NODES", nodes)
    extra = "key string, conv string, at string, depth string, n_convs string"
    df = spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in talks], f"conv_id long, turn long, role string, text string, {extra}").repartition(5)
    got = prefix_trie.trie(df).collect()
    assert sorted(tuple(r) for r in got) == plain_trie(talks)


def test_trie_of_little(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.trie(spark.createDataFrame([], schema)).count() == 0
    # 102 takes two turns or more from 100 and has one of its own: without 100 it may be turnless
    for rows in ([(102, 1, "user", "x")], [(5, 0, None, None), (5, 0, None, None)], [(c, 0, "u", "x") for c in range(101, 140)]):
        assert sorted(tuple(r) for r in prefix_trie.trie(spark.createDataFrame(rows, schema)).collect()) == plain_trie(rows)


def test_findclose_over_block_borders(monkeypatch):
    rng = random.Random(9)
    for block in (2, 3, 64):
        monkeypatch.setattr(prefix_trie, "BLOCK", block)
        for _ in range(30):
            steps, depth = [], 0
            while len(steps) < 60 or depth:
                up = depth == 0 or (len(steps) < 60 and rng.random() < 0.5)
                steps.append(1 if up else -1)
                depth += steps[-1]
            tree = prefix_trie.Parentheses(np.array(steps, dtype=np.int8))
            opens = np.flatnonzero(np.array(steps) == 1)
            want, stack = {}, []
            for i, s in enumerate(steps):
                if s == 1:
                    stack.append(i)
                else:
                    want[stack.pop()] = i
            assert tree.findclose(opens).tolist() == [want[i] for i in opens]


def test_hot_end_is_hashed_in_order(spark):
    steps = spark.range(30_000).selectExpr("X'00' AS key", "id - 5 AS conv", "true AS last")
    assert prefix_trie.ends(steps).first().ends == hashlib.sha256(",".join(str(i - 5) for i in range(30_000)).encode()).hexdigest()
