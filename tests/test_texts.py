"""Chunks, tokens, retrieval against brute force, tagging, grounding."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyloom.functions import text as X
from surveyloom.operators import chunk as H
from surveyloom.operators import matching as M
from surveyloom.operators import retrieval as R
from surveyloom.operators import statements as Q
from surveyloom.operators import tagging as T
from surveyloom.plans.index import build_index, load_index, question_side


def test_stems_agree_with_the_word_rule(spark):
    words = ["covered", "coverage", "cover", "ages", "v012", "stations", "nations", "is", "bus", "naïves", "b2_01", "tries", "as", "x_ings"]
    got = spark.createDataFrame([(" ".join(words),)], "t string").select(X.tokens("t").alias("w")).first().w
    assert got == [X.stem_word(w) for w in words]


def test_sections_and_packing(spark):
    text = "intro line\r\n# One\nbody a\n\n## \n\n#### Two ##\nb\n##### not a heading\nc"
    df = spark.createDataFrame([(text,)], "text string").withColumn("stem", F.lit("file"))
    got = [(s.heading, s.body) for s in df.select(H.sections("text", "stem").alias("s")).first().s]
    assert got == [("file", "intro line"), ("One", "body a"), ("Two ##", "b\n##### not a heading\nc")]
    long = "\n\n".join(["a" * 900, "b" * 900, "c" * 100, "d" * 1900])
    pieces = spark.createDataFrame([(long,)], "t string").select(H.split_long("t").alias("p")).first().p
    assert [len(p) for p in pieces] == [900, 900 + 2 + 100, 1900]


def brute_force(qv, dv, qs, ds, k):
    out = {}
    for i in range(len(qv)):
        dense, sparse = np.round(qv[i] @ dv.T, 6), np.round(qs[i] @ ds.T, 6)
        ranks = []
        for s in (dense, sparse):
            order = sorted(range(len(s)), key=lambda d: (-s[d], d))
            r = np.empty(len(s), int)
            r[order] = np.arange(1, len(s) + 1)
            ranks.append(r)
        fused = 1 / (60 + ranks[0]) + 1 / (60 + ranks[1])
        out[i] = sorted(range(len(fused)), key=lambda d: (-fused[d], d))[:k]
    return out


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(7)
    n, m, dims, vocab = 900, 6, 8, 40
    dv, qv = rng.normal(size=(n, dims)), rng.normal(size=(m, dims))
    dv[300:600] = dv[300]  # a third of the documents are copies
    dv, qv = (a / np.linalg.norm(a, axis=1, keepdims=True) for a in (dv, qv))
    ds, qs = (rng.random((x, vocab)) * (rng.random((x, vocab)) < 0.03) for x in (n, m))
    ds[300:600] = ds[300]

    def side(v, s, name):
        rows = [(i, v[i].tolist(), [f"t{j}" for j in np.flatnonzero(s[i])], [float(x) for x in s[i][s[i] > 0]], f"s{i % 5}") for i in range(len(v))]
        return spark.createDataFrame(rows, f"{name} long, vec array<double>, terms array<string>, weights array<double>, source string")

    return side(qv, qs, "q"), side(dv, ds, "d"), (qv, dv, qs, ds)


def test_fused_top_k_equals_brute_force_with_copies_and_zero_scores(spark, corpus):
    queries, index, raw = corpus
    got = {}
    for r in R.fused_top_k(queries, index, "q", "d", 4).collect():
        got.setdefault(r.q, {})[r["rank"]] = r.d
    want = brute_force(*raw, 4)
    assert {q: [v[i] for i in sorted(v)] for q, v in got.items()} == want


def test_fused_top_k_among_few_sources(spark, corpus):
    queries, index, raw = corpus
    got = {}
    for r in R.fused_top_k(queries, index, "q", "d", 3, F.col("source") == "s2").collect():
        got.setdefault(r.q, {})[r["rank"]] = r.d
    want = {q: [d for d in ds if d % 5 == 2][:3] for q, ds in brute_force(*raw, 900).items()}
    assert {q: [v[i] for i in sorted(v)] for q, v in got.items()} == want


def test_dense_top_k(spark, corpus):
    queries, index, (qv, dv, _, _) = corpus
    got = {(r.q, r["rank"]): r.d for r in R.dense_top_k(queries, index, "q", "d", 5).collect()}
    for i in range(len(qv)):
        s = np.round(qv[i] @ dv.T, 6)
        want = sorted(range(len(s)), key=lambda d: (-s[d], d))[:5]
        assert [got[(i, r)] for r in range(1, 6)] == want


TEXTS = [
    (1, "anemia level of women", "v457: anemia level"), (2, "covered by health insurance schemes", "v481: covered by health insurance"),
    (3, "owns a mobile telephone", "v169a: mobile"), (4, "state of residence", "v024: state"), (5, "sampling weights explained", "Sampling weights"),
]


def test_index_lookup_and_lsa(spark, tmp_path):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string, title string").withColumn("text", H.text_to_embed()).withColumn("source", F.lit("codebook"))
    paths = build_index(docs, str(tmp_path / "i"), stop=X.stop_list(["of", "a", "by"]), dimensions=3, keep=["source", "title"])
    vocab, index = load_index(spark, paths)
    assert index.select(F.size("vec")).distinct().first()[0] == 3
    vectors = index.select("doc_id", "vec").withColumnRenamed("doc_id", "q")
    asked = spark.createDataFrame([(2, "what does V481 mean?"), (1, "anemia"), (5, "weights v999")], "q long, text string")
    queries = question_side(asked.join(vectors, "q"), vocab, "q", stop=X.stop_list(["of", "a", "by"]))
    names = spark.createDataFrame([("v481", 2), ("v457", 1)], "name string, doc_id long")
    got = {(r.q, r["rank"]): (r.doc_id, r.match) for r in R.retrieve(queries, index, names, "q", "doc_id", 2).collect()}
    assert got[(2, 1)] == (2, "exact variable name") and got[(1, 1)] == (1, "similarity") and got[(5, 1)] == (5, "similarity")


def test_lsa_cosines_match_a_dense_decomposition(spark):
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i)}x" for i in range(12)]
    texts = [(i, " ".join(rng.choice(words, 9))) for i in range(30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    model = R.LsaModel.fit(docs, "doc_id", "text", dimensions=4)
    got = np.stack([np.array(r.vec) for r in model.embed(docs, "doc_id", "text").orderBy("doc_id").collect()])
    vocab = R.fit_vocabulary(docs, "doc_id", "text")
    where = {r.term: i for i, r in enumerate(vocab.orderBy("term").collect())}
    m = np.zeros((30, len(where)))
    for r in R.tfidf(R.term_counts(docs, "doc_id", "text"), vocab, "doc_id").collect():
        m[r.doc_id, where[r.term]] = r.weight
    _, _, vt = np.linalg.svd(m, full_matrices=False)
    want = m @ vt[:4].T
    want /= np.linalg.norm(want, axis=1, keepdims=True)
    assert np.abs(got @ got.T - want @ want.T).max() < 1e-4


def test_matching_equals_scoring_every_pair(spark):
    rng = np.random.default_rng(11)
    inds, ways = ["d1", "d2", "d3"], {"tv": "r1", "radio": "r2", "talk": "r2"}
    pick = lambda xs: [x for x in xs if rng.random() < 0.4]
    orgs = [(i, f"org {rng.integers(0, 400):04d}", str(rng.choice(["national", "state", "multi-state"], p=[0.2, 0.4, 0.4])), pick(["a", "b", "c"]), pick(inds), pick([*ways, "none"])) for i in range(300)]
    pops = [(p, [str(rng.choice(["a", "b", "c", "z"]))], pick(inds), pick(["r1", "r2"])) for p in range(25)]
    o = spark.createDataFrame(orgs, "org_id long, name string, scope string, states array<string>, related_indicators array<string>, channels array<string>")
    p = spark.createDataFrame(pops, "population long, states array<string>, elevated array<string>, wide array<string>")
    got = {}
    for r in M.rank_organizations(o, p, "population", ways).orderBy("population", "rank").collect():
        got.setdefault(r.population, []).append((r.total, r.org_id))
    for pid, states, elevated, wide in pops:
        scored = []
        for oid, name, scope, places, needs, channels in orgs:
            geo = 1 if scope == "national" else 2 if set(places) & set(states) else None if scope == "state" else 0
            if geo is not None:
                total = geo + len(set(needs) & set(elevated)) + len({ways[c] for c in channels if c in ways} & set(wide))
                if total > 0:
                    scored.append((-total, name, oid))
        assert got.get(pid, []) == [(-t, oid) for t, _, oid in sorted(scored)[:10]]


def test_repeated_areas_count_once(spark):
    orgs = spark.createDataFrame(
        [("a", "Aa", "state", ["x"] * 12, ["n"], [])] + [(c, c.upper(), "state", ["x", "y"], ["n"], []) for c in "bcd"],
        "org_id string, name string, scope string, states array<string>, related_indicators array<string>, channels array<string>")
    population = spark.createDataFrame([(1, ["x", "x", "y"], ["n"], [])], "p int, states array<string>, elevated array<string>, wide array<string>")
    got = {r.org_id: (r.geography, r.total) for r in M.rank_organizations(orgs, population, "p", top=4).collect()}
    assert got == {o: (2, 3) for o in "abcd"}


@pytest.mark.parametrize("question, intent, outreach", [
    ("Explain the meaning of v133", "documentation", False),
    ("Which variables describe household wealth?", "documentation", False),
    ("How many women between 20 and 29 were interviewed?", "count", False),
    ("What share of urban women has a bank account?", "percentage", False),
    ("Where are the most underserved women living?", "underserved", False),
    ("Which group should a charity prioritize first?", "underserved", True),
    ("Name NGOs or outreach channels for these women", "underserved", True),
])
def test_question_intent(spark, question, intent, outreach):
    row = T.tag_questions(spark.createDataFrame([(question,)], "text string")).first()
    assert (row.intent, row.needs_outreach) == (intent, outreach)


def test_question_entities(spark):
    q = spark.createDataFrame([(1, "Percentage of women aged 18-24 without a mobile phone in Bihar and Madhya Pradesh, by state")], "k int, text string")
    labels = spark.createDataFrame([(10, "bihar"), (23, "madhya pradesh"), (5, "pradesh"), (6, "har")], "code int, label string")
    tagged = T.tag_questions(q.join(T.places(q, labels, "k"), "k"), states="places").first()
    assert sorted(tagged.states) == [10, 23] and tuple(tagged.age) == (18, 24)
    assert tagged.outcome.indicator == "no_mobile_phone" and tagged.group_by == ["v024"]


def test_numbers_must_be_backed(spark):
    long = "123456789012345678901234567890123"
    backed = f"34.56% of 20,417 rows; {long}; 20.12345678904; 0.995; 9.96; 0.04"
    evidence = spark.createDataFrame([(i, backed) for i in range(8)], "k int, text string")
    said = spark.createDataFrame([
        (0, "Some 34.6% of 20,417 rows."), (1, "Some 34.6%, but 71.3% elsewhere, in 7 places."), (2, f"{long} and {long[:-1]}4"),
        (3, "20.12345678904 is not 20.123456789049, nearly 20.1234567890"), (4, "1.00 or 1.0, 10.0, 20,000 and 35"), (5, "0.0 and 0.1"), (6, "007 and 10 and 11"), (7, ""),
    ], "k int, text string")
    got = {r.k: r.problems for r in Q.unverified_numbers(said, evidence, "k").collect()}
    assert got == {0: [], 1: ["71.3"], 2: [f"{long[:-1]}4"], 3: ["20.123456789049"], 4: ["20,000"], 5: ["0.1"], 6: ["11"], 7: []}


def test_facts_without_a_seen_source_are_dropped(spark):
    facts = spark.createDataFrame([("real", "x", "real.example.org/about"), ("real", "y", "made.up/1"), ("ghost", "z", "nowhere/2")], "org string, text string, source_url string")
    seen = spark.createDataFrame([("real.example.org/about",)], "url string")
    assert [r.org for r in M.sourced_facts(facts, seen, "org").collect()] == ["real"]
    assert tuple(M.dropped_facts(facts, seen, "org").first()) == (2, 1)


def test_fused_corpus_holds_documents_and_items_without_embedding(spark, tmp_path):
    """Two of five documents and one of two items have a vector; the others are ranked with a zero vector."""
    from checks import texts

    words = ["alpha", "beta", "gamma", "delta", "omega"]
    tables = {
        "documents": spark.createDataFrame([(i, f"{w} text", "src1") for i, w in enumerate(words)], "doc_id long, text string, source string"),
        "embeddings": spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>"),
        "benchmark": spark.createDataFrame([(1, "beta text"), (4, "omega text")], "item_id long, text string"),
    }
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    got = {(r.item_id, r["rank"]): r for r in texts.r14w(spark, str(tmp_path)).collect()}
    assert {q for q, _ in got} == {1, 4} and all({got[q, r].doc_id for r in range(1, 6)} == {0, 1, 2, 3, 4} for q in (1, 4))
    assert got[1, 1].doc_id == 1 and got[1, 1].dense_score == 1.0
    omega = next(got[4, r] for r in range(1, 6) if got[4, r].doc_id == 4)
    assert omega.sparse_rank == 1 and omega.dense_score == 0.0


def test_scores_that_differ_below_six_digits_are_ranked(spark, tmp_path):
    from checks import texts

    spark.createDataFrame([(0, [1.0]), (1, [0.5]), (2, [0.50000006])], "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {r["rank"]: (r.doc_id, r.score) for r in texts.r12f(spark, str(tmp_path)).filter("query_id = 0").collect()}
    assert got == {1: (0, 1.0), 2: (2, 0.5), 3: (1, 0.5)}
