"""WARC round trips, byte-level BPE against tiktoken, and the pipeline."""

import base64
import hashlib
import heapq
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from surveyloom.llm import bpe, components, queries, warc

SF = "/root/testdata/sf0.001"


def test_loser_tree_merges():
    rng = random.Random(2)
    for k in range(10):
        for _ in range(30):
            runs = [sorted((rng.randrange(9), i, j) for j in range(rng.randrange(6))) for i in range(k)]
            assert list(warc.loser_tree([iter(r) for r in runs])) == list(heapq.merge(*runs))


def test_warc_round_trip(spark, tmp_path):
    big, small = "<p>é" + "x" * 1200, "tiny"
    pages = [(1, "https://b.example.com/x?q=1", big), (2, "http://A.example.com/", big), (9, None, big), (9, "http://z.org/", big), (None, "mailto:x", big),
             (3, "http://b.example.com/a\nb", small), (4, "http://b.example.com/c", small), (5, "u", None), (6, "", ""), (7, "http://日本.example/", "ß" * 600)]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("file", F.lit("extra"))
    got = warc.round_trip(rows, folder=str(tmp_path / "archive")).collect()
    want = Counter()
    for i, _, html in pages:
        body = (html or "").encode()
        original = 9 if html == big else None
        revisit = original is not None and i != original
        want[i, "revisit" if revisit else "response", original if revisit else None, len(body), hashlib.sha1(body).hexdigest()] += 1
    assert Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in got) == want
    keys = [r["url_key"] for r in warc.merge_runs(warc.write_archives(warc.captures(rows, "page_id", "url", "html", F.lit("1970-01-01T00:00:00Z"), 1000), str(tmp_path / "again"))).collect()]
    assert keys == sorted(keys) and "com,example,b)/x?q=1" in keys
    assert warc.round_trip(rows.limit(0), folder=str(tmp_path / "none")).count() == 0


def test_warc_members_are_checked():
    member = bytearray(warc.record(1, "http://a.org/", "1970-01-01T00:00:00Z", b"payload", "0" * 40, None))
    with pytest.raises(ValueError):
        warc.parse(bytes(member))


def test_bpe_equals_tiktoken(spark, corpus, docs):
    import tiktoken

    path, pattern = queries.byte_bpe()
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    more = ["<|endoftext|>", "aaaaaaaaaaaaaaaaaaaaaaaaa", "  \n\t  x  ", "z" * 3000, "’s don't I'LL", "🎉" * 40, "  \x85", "0123456789" * 9]
    rows = docs.select("doc_id", "text").union(spark.createDataFrame([(900 + i, t) for i, t in enumerate(more)], "doc_id long, text string"))
    texts = [(i, t) for i, t in corpus] + [(900 + i, t) for i, t in enumerate(more)]
    want = Counter()
    for i, t in texts:
        ids = own.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, bpe.digests(rows, "doc_id", "text", path, pattern).collect())) == want
    assert bpe.digests(rows.limit(0), "doc_id", "text", path, pattern).count() == 0
    with pytest.raises(ValueError):
        bpe.with_ids(rows.withColumn("IDS", F.lit(1)), "text", path, pattern)


def test_generations_bound_the_memory():
    known = bpe.Known()
    known["old"] = b"1"
    for i in range(bpe.KEPT_WORDS):
        known[str(i)] = b"2"
    known.age()
    assert len(known) == 0 and known["old"] == b"1" and known["new"] == "new" and known.new == ["new"]


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in {y for e in edges if e[0] != e[1] for y in e}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes, name
        after = after.cache()
        ids = {r["doc_id"] for r in after.select("doc_id").collect()}
        assert 0 < len(ids) and ids <= {r["doc_id"] for r in before.select("doc_id").collect()}, name
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert last.count() == before.count() and last.filter("not round_trip").count() == 0
    assert {n for n, _ in corpus_pipeline.STAGES} == {"quality", "line_dedup", "near_copies", "decontamination", "byte_bpe"}


def test_pipeline_on_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_each_operator_has_one_query():
    numbers = Counter(name.split("_")[0] for name in queries.QUERIES)
    assert numbers == Counter({f"op{n}": 1 for n in range(1, 11)})


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    from checks.compare import compare, duck

    text, _, ok = compare(spark, duck(SF), name, queries.QUERIES[name], queries.ORACLES[name], SF)
    assert ok, text
