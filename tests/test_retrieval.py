"""The stored index: counts, exact selection, posting blocks, clusters, histograms, the model."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyloom.operators import dense, fused, lsa, sparse, terms
from surveyloom.operators import retrieval as R
from surveyloom.sources.tables import first_rows


def test_terms_are_counted_as_by_hand(spark):
    texts = [(1, "red red wagon, red"), (2, None), (3, ""), (4, "wagon red"), (4, "blue"), (5, "ünï 日本 ünï")]
    got = {}
    for r in terms.term_counts(spark.createDataFrame(texts, "k int, text string").coalesce(1), "k", "text").collect():
        got.setdefault(r.k, Counter())[r.term] += r.n
    want = {}
    for k, text in texts:
        words = re.findall(r"\w+", (text or "").lower())
        for t in words + [f"{a} {b}" for a, b in zip(words, words[1:])]:
            want.setdefault(k, Counter())[t] += 1
    assert got == want


def test_words_cut_in_a_task_are_those_of_the_column(spark):
    from surveyloom.functions import text as T

    rng = np.random.default_rng(4)
    parts = ["ages", "station", "stations", "ations", "abcations", "ab12ings", "12tables", "tables_2", "__ed", "___ed", "éèêed", "日本語s", "٣٤es", "Ⅷed", "THE", "İgoa", "x" * 300 + "ied", "ábc", "𝒳𝒴𝒵ing", "\n", "", "the's", "-", "image's"]
    texts = [(i, " -"[i % 2].join(rng.choice(parts, 25))) for i in range(60)] + [(60, None), (61, ""), (62, "The the")]
    docs = spark.createDataFrame(texts, "k int, text string").repartition(2)
    stop = T.stop_list(["the", "s"])
    want = {r.k: Counter(r.t or []) for r in docs.select("k", T.terms(T.content_tokens("text", stop)).alias("t")).collect()}
    assert {r.k: Counter(dict(zip(r.terms, r.n))) for r in terms.counted(docs, "k", "text", stop).collect()} == want
    vocab = terms.fit_vocabulary(docs, "k", "text", stop, 90)
    names = [r.term for r in vocab.orderBy("term").collect()]
    known = terms.Terms.of(vocab)
    one = {r.k: (r.terms, r.weights, r.lead) for r in terms.text_weights(docs, "k", "text", stop, known).collect()}
    assert one == {r.k: (r.terms, r.weights, r.lead) for r in terms.weighted(terms.counted(docs, "k", "text", stop), "k", known).collect()}
    assert all({names[t] for t in one[k][0]} == set(want[k]) & set(names) for k in want)


@pytest.mark.parametrize("times", [1, 3, 50])
def test_only_terms_that_can_be_frequent_are_counted_by_name(spark, monkeypatch, times):
    rng = np.random.default_rng(9)
    texts = [(i, " ".join(f"w{x}" for x in rng.zipf(1.3, 60) % 100_000)) for i in range(400)]
    docs = spark.createDataFrame(texts, "k int, text string").repartition(3)
    count = terms._bucket_counts
    monkeypatch.setattr(terms, "_bucket_counts", lambda rows, stop: times * count(rows, stop))  # bounds that are too high are found out
    per_term = terms.frequent_counts(docs, "k", "text", (), 80)
    every = {r.term: (r.corpus_count, r.df) for r in terms.text_counts(docs, "k", "text").collect()}
    got = {r.term: (r.corpus_count, r.df) for r in per_term.collect()}
    assert all(every[t] == n for t, n in got.items()) and len(every) > 10_000
    assert times == 50 or len(got) < 1_000
    first = sorted(every, key=lambda t: (-every[t][0], t))[:80]
    assert {r.term for r in terms.most_frequent(per_term, 80).collect()} == set(first)
    assert terms.most_frequent(terms.frequent_counts(docs, "k", "text", (), 0), 0).count() == 0


def test_sums_and_blocks_hold_a_bounded_part(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(terms, "HELD", 4000)
    monkeypatch.setattr(terms, "TEXT_BYTES", 1000)
    monkeypatch.setattr(sparse, "POSTINGS", 500)
    texts = pa.RecordBatch.from_pydict({"_text": [" ".join(f"t{(i * 37 + j) % 900}" for j in range(40)) for i in range(300)]})
    out = list(terms._text_sums([texts], []))
    assert len(out) > 5 and max(b.nbytes for b in out) < 20_000 and sum(sum(b.column("n").to_pylist()) for b in out) == 300 * 79
    rows = pa.RecordBatch.from_pydict({"group": [i // 16 for i in range(300)], "terms": [[1] * (i % 30) for i in range(300)]})
    parts = list(sparse._whole_groups([rows]))
    assert max(len(p.column("terms").flatten()) for p in parts) <= 500 and sum(p.num_rows for p in parts) == 300
    groups = [set(p.column("group").to_pylist()) for p in parts]
    assert sum(len(g) for g in groups) == len(set().union(*groups))


@pytest.mark.parametrize("n", [0, 1, 7, 60, 61, 500, 2999, 3000, 4000])
def test_most_frequent_is_an_exact_selection(spark, n):
    rng = np.random.default_rng(1)
    rows = [(f"t{i:04d}", int(c), 1) for i, c in enumerate(rng.choice([1, 1, 1, 2, 3, 900, 70_000, 70_001, 2**40 + 5], 3000))]
    per_term = spark.createDataFrame(rows, "term string, corpus_count long, df long").repartition(7)
    got = [r.term for r in terms.most_frequent(per_term, n).collect()]
    assert len(got) == len(set(got)) and set(got) == {t for t, _, _ in sorted(rows, key=lambda r: (-r[1], r[0]))[:n]}
    assert "TakeOrdered" not in terms.most_frequent(per_term, n)._jdf.queryExecution().executedPlan().toString()


def test_first_rows_without_rows_and_with_all(spark):
    df = spark.range(50).select(F.concat(F.lit("x"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("t"))
    assert first_rows(df.limit(0), "t", 5).count() == 0 and first_rows(df, "t", 90).count() == 50
    assert sorted(r.t for r in first_rows(df, "t", 13).collect()) == [f"x{i:03d}" for i in range(13)]


@pytest.fixture(scope="module")
def postings():
    """Documents of four kinds, a few of each with large weights."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(1200):
        kind = i % 4
        own = rng.choice(np.arange(kind * 100, kind * 100 + 100), 30, replace=False)
        w = rng.random(30) * (8 if i < 80 else 1)
        rows.append((i, [int(t) for t in own], [float(x) for x in w / 20], kind * 100 - 1 if i < 80 else int(own.min())))
    rows += [(1200, [], [], -1)]
    asked = [(q, list(range(q, q + 25)), [0.2] * 25) for q in (0, 20, 110, 350)] + [(900, [], [])]
    return rows, asked


def test_posting_blocks_give_what_scoring_everything_gives(spark, postings, monkeypatch):
    monkeypatch.setattr(sparse, "GROUP_BITS", 4)
    rows, asked = postings
    index = sparse.in_groups(spark.createDataFrame(rows, "d long, terms array<int>, weights array<double>, lead long"))
    blocks = R.posting_blocks(index, "d").cache()
    q = spark.createDataFrame(asked, "q long, terms array<int>, weights array<double>")
    got = {}
    for r in R.sparse_top_k(q, blocks, "q", "d", 5, 12).collect():
        got.setdefault(r.q, {})[r["rank"]] = (r.d, r.score)
    for k, own, w in asked:
        weight = dict(zip(own, w))
        every = sorted((-round(sum(weight.get(t, 0) * x for t, x in zip(ts, ws)), 12), d) for d, ts, ws, _ in rows if set(ts) & set(own))
        assert [got.get(k, {})[i + 1][0] for i in range(min(5, len(every)))] == [d for _, d in every[:5]]
    exploded = sparse.asked(q, "q")
    bounds = sparse.group_bounds(exploded, blocks, "q")
    kept = sparse.reachable(bounds, exploded, blocks, "q", "d", 5)
    opened, possible = kept.count(), bounds.count()
    assert possible > 70 and opened < 0.5 * possible  # the rest of the groups is never opened


@pytest.mark.parametrize("repeated", [False, True])
def test_postings_are_scored_where_they_lie(spark, postings, monkeypatch, tmp_path, repeated):
    monkeypatch.setattr(sparse, "GROUP_BITS", 4)
    monkeypatch.setattr(sparse, "PAIRS", 50)
    monkeypatch.setattr(sparse, "QUESTIONS", 3)
    rows, asked = postings
    if repeated:
        rows = rows + [(i % 300, ts, ws, lead) for i, ts, ws, lead in rows[500:900]]
    index = sparse.in_groups(spark.createDataFrame(rows, "d long, terms array<int>, weights array<double>, lead long"))
    R.posting_blocks(index, "d").write.option("parquet.block.size", 2000).parquet(str(tmp_path / "blocks"))
    blocks = spark.read.parquet(str(tmp_path / "blocks"))
    q = spark.createDataFrame(asked, "q long, terms array<int>, weights array<double>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4000)  # pieces that end within a group
    try:
        found = R.sparse_top_k(q, blocks, "q", "d", 5, 12)
        got = {}
        for r in found.orderBy("q", "rank").collect():
            got.setdefault(r.q, []).append((r.d, r.score))
        plan = found._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for k, own, w in asked:
        weight, total = dict(zip(own, w)), Counter()
        for d, ts, ws, _ in rows:
            if set(ts) & set(own):
                total[d] += sum(weight.get(t, 0) * x for t, x in zip(ts, ws))
        want = sorted((-round(x, 12), d) for d, x in total.items())[:5]
        assert [(d, -x) for x, d in want] == got.get(k, [])
    assert "Join" not in plan  # no block moves
    assert repeated == (not sparse.in_one_group(blocks, "d"))


def test_clusters_that_cannot_reach_are_skipped_and_none_else():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((30, 16))
    points = np.repeat(centres, 100, axis=0) + 0.05 * rng.standard_normal((3000, 16))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    ids, sample = np.arange(3000), points[::10]
    at = dense.centres_of(sample)
    place = dense.nearest(points, at)
    radius = np.array([np.linalg.norm(points[place == c] - at[c], axis=1).max(initial=0) for c in range(len(at))])
    asked = points[:40]
    search = dense.Search(asked, at, radius, sample, 7, 12)
    order = np.argsort(place, kind="stable")
    for a, b in dense.segments(place[order]):
        search.see(int(place[order[a]]), ids[order[a:b]], points[order[a:b]])
    for q in range(40):
        s = np.round(points @ asked[q], 12)
        want = sorted(range(3000), key=lambda d: (-s[d], d))[:7]
        assert search.found[q][1].tolist() == want
    assert search.skipped > 0.6 * (search.skipped + search.compared)


def test_dense_search_of_few_and_of_hot_vectors(spark, monkeypatch):
    monkeypatch.setattr(dense, "DENSE_ROWS", 2)  # several blocks of questions
    one, other = [0.6, 0.8], [1.0, 0.0]
    corpus = spark.createDataFrame([(f"d{i:02d}", one) for i in range(40)] + [("x", other)], "d string, vec array<double>").repartition(3)
    q = spark.createDataFrame([(i, v) for i, v in enumerate([one, other, [0.0, 0.0], [-1.0, 0.0], one])], "q int, vec array<double>")
    got = {}
    for r in R.dense_top_k(q, corpus, "q", "d", 3, 12).orderBy("q", "rank").collect():
        got.setdefault(r.q, []).append(r.d)
    assert got == {0: ["d00", "d01", "d02"], 1: ["x", "d00", "d01"], 2: ["d00", "d01", "d02"], 3: ["d00", "d01", "d02"], 4: ["d00", "d01", "d02"]}
    assert R.dense_top_k(q, corpus.limit(0), "q", "d", 3).count() == 0 and R.dense_top_k(q.limit(0), corpus, "q", "d", 3).count() == 0


def test_many_questions_give_k_results_a_block_not_a_task(spark, monkeypatch):
    rng = np.random.default_rng(4)
    points = np.round(rng.standard_normal((400, 8)), 3)
    corpus = spark.createDataFrame([(i, [float(c) for c in x]) for i, x in enumerate(points)] + [(None, [9.0] * 8)], "d long, vec array<double>").repartition(6)
    asked = spark.createDataFrame([(i % 90, [float(c) for c in x]) for i, x in enumerate(points[:100])], "q long, vec array<double>")  # ten keys twice
    monkeypatch.setattr(dense, "DENSE_ROWS", 40)
    monkeypatch.setattr(dense, "SAMPLE", 100)
    clusters, given = dense.cluster(corpus, "d"), []
    clusters.rows = clusters.rows.repartitionByRange(6, "cluster").sortWithinPartitions("cluster")
    monkeypatch.setattr(dense, "best", lambda scored, *more: given.append(scored) or sparse.best(scored, *more))
    got = {}
    for r in dense.dense_search(asked, clusters, "q", "d", 3, 12).orderBy("q", "rank").collect():
        got.setdefault(r.q, []).append((r.d, r.score))
    ids, every = [*range(400), None], np.vstack([points, [[9.0] * 8]])
    for q in range(90):
        found = [(-s, -1 if d is None else d) for x in [points[q]] + [points[90 + q]] * (q < 10) for d, s in zip(ids, np.round(every @ x, 12))]
        assert [(-1 if d is None else d, -s) for d, s in got[q]] == [(d, s) for s, d in sorted(found)[:3]]
    assert given[0].count() == 3 * 100


@pytest.mark.parametrize("scale", [1.0, 1e25])
def test_scores_that_single_precision_cannot_tell_apart(scale):
    x = np.ones((3000, 4)) * scale
    x[:, 0] += scale * 1e-10 * np.random.default_rng(6).permutation(3000)
    search = dense.Search(np.ones((2, 4)), np.zeros((1, 4)), np.array([3.0 * scale]), x[:50], 5, None)
    search.scan(np.zeros(3000, dtype=int), np.arange(3000), x)
    want = np.lexsort((np.arange(3000), -np.einsum("ij->i", x)))[:5].tolist()
    assert [names.tolist() for _, names in search.found] == [want, want]


def test_bins_follow_the_order_of_ranks():
    rng = np.random.default_rng(3)
    scores, ids = np.round(rng.normal(size=400) * (rng.random(400) < 0.6), 2), rng.permutation(400)
    at = fused.bins(scores[None, :], ids, np.array([50, 200, 201]))[0]
    order = np.lexsort((ids, -scores))
    assert (np.diff(at[order]) >= 0).all() and 0 <= at.min() and at.max() < fused.BINS


def test_many_candidates_of_one_bin_are_counted_without_a_square():
    import tracemalloc

    rng = np.random.default_rng(6)
    scores, ids = np.round(rng.normal(size=20_000) * (rng.random(20_000) < 0.5) * 0.002, 5), rng.permutation(20_000)
    borders = np.array([4000, 9000])
    at = fused.bins(scores[None, :], ids, borders)[0]
    some = rng.choice(20_000, 9_000, replace=False)
    tracemalloc.start()
    ahead = fused.Ahead(ids[some], scores[some], at[some])
    for a in range(0, 20_000, 3_000):
        ahead.see(scores[a : a + 3_000], ids[a : a + 3_000], at[a : a + 3_000])
    got = ahead.counts()
    assert tracemalloc.get_traced_memory()[1] < 4_000_000  # pairs of a thousand documents and these candidates took 9 MB each
    tracemalloc.stop()
    rank = np.argsort(np.lexsort((ids, -scores)))
    above = np.cumsum(np.bincount(at, minlength=fused.BINS))
    assert (got == rank[some] - np.where(at[some] > 0, above[at[some] - 1], 0)).all()


@pytest.mark.parametrize("digits", [12, None])
def test_few_eligible_documents_far_down(spark, monkeypatch, digits):
    """Eligible documents stand one behind the other far from the top, so the lists of the first pass settle nothing."""
    monkeypatch.setattr(fused, "RRF_K", 2)
    n = 600
    down = np.linspace(0.9, -0.9, n)
    other = np.random.default_rng(1).permutation(n)
    rows = [(i, [float(down[i]), float(np.sqrt(1 - down[i] ** 2))], [1], [float(0.9 * other[i] / n + 0.01)], 300 <= i < 420) for i in range(n)]
    index = spark.createDataFrame(rows, "d long, vec array<double>, terms array<int>, weights array<double>, mine boolean").repartition(3)
    q = spark.createDataFrame([(7, [1.0, 0.0], [1, 2], [1.0, 0.5]), (8, [0.0, 0.0], [], []), (9, [0.0, 1.0], [1], [0.5])], "q long, vec array<double>, terms array<int>, weights array<double>")
    fetched = []
    monkeypatch.setattr(fused, "_fetch", lambda *a, f=fused._fetch: fetched.append(1) or f(*a))
    got = {}
    for r in R.fused_top_k(q, index, "q", "d", 4, F.col("mine"), digits).orderBy("q", "rank").collect():
        got.setdefault(r.q, []).append((r.d, r.dense_rank, r.sparse_rank))
    for key, vec, weight in ((7, [1.0, 0.0], 1.0), (8, [0.0, 0.0], 0.0), (9, [0.0, 1.0], 0.5)):
        lists = [np.array([np.dot(vec, r[1]) for r in rows]), np.array([weight * r[3][0] for r in rows])]
        ranks = [np.empty(n, dtype=int) for _ in lists]
        for rank, s in zip(ranks, lists):
            rank[np.lexsort((np.arange(n), -np.round(s, 12)))] = np.arange(1, n + 1)
        score = 1 / (2 + ranks[0]) + 1 / (2 + ranks[1])
        want = sorted((d for d in range(n) if rows[d][4]), key=lambda d: (-score[d], d))[:4]
        assert got[key] == [(d, ranks[0][d], ranks[1][d]) for d in want]
    assert fetched


def test_tree_of_triangles_equals_one_qr(spark, monkeypatch):
    monkeypatch.setattr(lsa, "MERGED", 2)
    rng = np.random.default_rng(4)
    rows = [(sorted(rng.choice(12, 4, replace=False).tolist()), rng.random(4).tolist()) for _ in range(90)] + [([], [])]
    a = np.zeros((91, 12))
    for i, (t, w) in enumerate(rows):
        a[i, t] = w
    basis = rng.standard_normal((12, 5))
    df = spark.createDataFrame([([int(x) for x in t], w) for t, w in rows], "terms array<int>, weights array<double>").repartition(9)
    r = lsa._tall_qr(df, spark.sparkContext.broadcast(basis))
    assert np.allclose(r.T @ r, basis.T @ a.T @ a @ basis)
    assert np.allclose(lsa._multiplied(df, spark.sparkContext.broadcast(basis), 12), a.T @ a @ basis, rtol=1e-5, atol=1e-5)


def test_lsa_of_topics_within_a_thousandth(spark, monkeypatch, tmp_path):
    """Texts of 20 topics with noise, 20 dimensions; long rows are projected in several turns."""
    monkeypatch.setattr(lsa, "CELLS", 500)
    rng = np.random.default_rng(6)
    words = [["w" + "".join(rng.choice(list("bcdfgklmn"), 5)) for _ in range(12)] for _ in range(20)]
    texts = [(i, " ".join([*rng.choice(words[i % 20], 40), *rng.choice(words[rng.integers(20)], 4)])) for i in range(400)] + [(400, ""), (401, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    model = R.LsaModel.fit(docs, "doc_id", "text", dimensions=20, max_features=600)
    model.save(str(tmp_path / "m"))
    model = R.LsaModel.load(spark, str(tmp_path / "m"))
    got = np.stack([np.array(r.vec) for r in model.embed(docs, "doc_id", "text").orderBy("doc_id").collect()])
    vocab = [r.term for r in R.fit_vocabulary(docs, "doc_id", "text", max_features=600).orderBy("term").collect()]
    where, m = {t: i for i, t in enumerate(vocab)}, np.zeros((402, len(vocab)))
    rows = R.counted(docs, "doc_id", "text")
    for r in R.weighted(rows, "doc_id", R.Terms.of(R.fit_vocabulary(docs, "doc_id", "text", max_features=600))).collect():
        m[r.doc_id, r.terms] = r.weights
    assert len(where) == 600 and np.allclose(np.linalg.norm(m[:400], axis=1), 1)
    want = m @ np.linalg.svd(m, full_matrices=False)[2][:20].T
    length = np.linalg.norm(want, axis=1, keepdims=True)
    want = np.divide(want, length, out=np.zeros_like(want), where=length > 0)
    assert np.abs(got @ got.T - want @ want.T).max() < 1e-3 and not got[400:].any()


def test_unbounded_vocabulary_searches_by_strings(spark):
    docs = spark.createDataFrame([(1, "red wagon"), (2, "blue wagon"), (3, "green")], "d int, text string")
    asked = spark.createDataFrame([(1, "a red wagon"), (2, "purple"), (3, "green green")], "q int, text string")
    want = {1: [1, 2], 3: [3]}
    for features in (None, 100):
        got = {}
        for r in R.search(docs, asked, "d", "q", k=5, max_features=features, digits=12).orderBy("q", "rank").collect():
            got.setdefault(r.q, []).append(r.d)
        assert got == want


def test_lsa_counts_documents_without_a_term(spark):
    docs = spark.createDataFrame([(i, f"red{i} wagon{i % 3} blue{i % 2} sky") for i in range(6)] + [(6, ""), (7, None)], "k int, text string")
    got = {r.k: r.vec for r in R.LsaModel.fit(docs, "k", "text").embed(docs, "k", "text").collect()}
    assert {len(v) for v in got.values()} == {7}  # one less than documents, as the SQL of R11_lsa_embedding says
    assert np.allclose([np.linalg.norm(got[k]) for k in range(8)], [1] * 6 + [0] * 2, atol=1e-6)


def test_lsa_products_keep_to_a_small_part_of_memory():
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(3)
    basis = rng.standard_normal((500, 288))
    lists = [rng.integers(0, 500, n) for n in (0, 3000, 40, 0, 900, 1)]
    weights = [rng.random(len(x)) for x in lists]
    batch = pa.RecordBatch.from_pydict({"terms": [x.tolist() for x in lists], "weights": [w.tolist() for w in weights]})
    tracemalloc.start()
    got = lsa._projected(batch, basis)
    assert tracemalloc.get_traced_memory()[1] < 4_000_000  # one product of all postings takes 9 MB
    tracemalloc.stop()
    assert np.allclose(got, [w @ basis[x] if len(x) else np.zeros(288) for x, w in zip(lists, weights)])
