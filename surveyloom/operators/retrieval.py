"""Searching a stored index: sparse, fused by rank, and with identifiers pinned.

The parts live in `terms` (counts, vocabulary, weights), `sparse` (posting
blocks), `dense` (clustered vectors) and `fused` (histograms of scores).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import cut
from .dense import dense_search, dense_top_k
from .fused import RRF_K, fused_top_k
from .lsa import LsaModel
from .sparse import best, in_groups, posting_blocks, score, sparse_top_k
from .terms import Terms, corpus_counts, counted, fit_vocabulary, frequent_counts, term_counts, text_counts, text_weights, tfidf, vocabulary, weighted

__all__ = [
    "IDENTIFIER", "RRF_K", "LsaModel", "Terms", "best", "corpus_counts", "counted", "dense_search", "dense_top_k", "fit_vocabulary", "frequent_counts", "fused_top_k", "hit_rate",
    "in_groups", "mentioned", "pin_exact", "posting_arrays", "posting_blocks", "retrieve", "score", "search", "sparse_top_k", "term_counts", "text_counts", "text_weights", "tfidf", "vocabulary",
    "weighted", "with_postings",
]

# Fixed value: what an identifier mentioned in a question looks like.
IDENTIFIER = r"(?i)\b([a-z]{1,5}\d{1,4}[a-z]?(?:_\d{1,2})?|caseid|ssmod|sweight|sdist)\b"


def search(
    docs: DataFrame, queries: DataFrame, doc: str, query: str, text: str = "text", query_text: str = "text",
    k: int = 10, stop: Sequence[str] = (), max_features: int | None = None, digits: int | None = None,
) -> DataFrame:
    """Fit on the documents and answer a batch of text queries, sparse only. Starts jobs.

    Vocabulary and posting blocks are written once. Without
    `max_features` the vocabulary has no bound, so weights come from joins.
    """
    vocab = cut(fit_vocabulary(docs, doc, text, stop, max_features), "vocabulary")
    if max_features is None:
        index = posting_arrays(tfidf(term_counts(docs, doc, text, stop), vocab, doc), doc).withColumn("lead", F.element_at("terms", 1))
        asked = posting_arrays(tfidf(term_counts(queries, query, query_text, stop, vocab), vocab, query), query)
    else:
        known = Terms.of(vocab)
        index, asked = text_weights(docs, doc, text, stop, known), text_weights(queries, query, query_text, stop, known)
    blocks = cut(posting_blocks(cut(in_groups(index), "index"), doc), "blocks")
    return sparse_top_k(cut(asked, "questions"), blocks, query, doc, k, digits)


def posting_arrays(postings: DataFrame, key: str) -> DataFrame:
    """(key, terms, weights): one row per document."""
    packed = postings.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("term", "weight"))).alias("p"))
    return packed.select(key, F.col("p.term").alias("terms"), F.col("p.weight").alias("weights"))


def with_postings(df: DataFrame, postings: DataFrame, key: str) -> DataFrame:
    """Adds posting arrays by key."""
    return df.join(postings.select(key, "terms", "weights"), key)


def mentioned(queries: DataFrame, identifiers: DataFrame, query: str, doc: str, text: str = "text", pattern: str = IDENTIFIER) -> DataFrame:
    """(query, doc, position): known identifiers in the query text, by first mention. `identifiers(name, doc)`.

    Of several documents with one name the first by id is meant.
    """
    found = queries.select(query, F.posexplode(F.regexp_extract_all(text, F.lit(pattern), F.lit(1))).alias("position", "name"))
    known = identifiers.groupBy(F.lower("name").alias("name")).agg(F.min(doc).alias(doc))
    return found.withColumn("name", F.lower("name")).join(known, "name").groupBy(query, doc).agg(F.min("position").alias("position"))


def pin_exact(fused: DataFrame, pins: DataFrame, query: str, doc: str, k: int) -> DataFrame:
    """Mentioned documents first (score 1.0, in order of mention), then the fused ones; k per query.

    The k best fused are enough: each pin that is also among them frees one place it takes itself.
    """
    exact = pins.select(query, doc, F.lit(1.0).alias("score"), F.lit("exact variable name").alias("match"),
                        F.lit(0).alias("_tier"), F.col("position").alias("_place"))
    rest = fused.join(pins.select(query, doc), [query, doc], "left_anti").select(
        query, doc, "score", F.lit("similarity").alias("match"), F.lit(1).alias("_tier"), F.col("rank").alias("_place"))
    order = Window.partitionBy(query).orderBy("_tier", "_place", doc)
    return (
        exact.unionByName(rest).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .drop("_tier", "_place")
    )


def retrieve(
    queries: DataFrame, index: DataFrame, identifiers: DataFrame, query: str, doc: str, k: int = 5,
    sources: Sequence[str] | None = None, text: str = "text", digits: int | None = None,
) -> DataFrame:
    """Pinned identifiers, then rank fusion, restricted to `sources` afterwards. The index then needs a `source` column."""
    eligible = None if sources is None else F.col("source").isin(*sources)
    pins = mentioned(queries, identifiers, query, doc, text)
    if sources is not None:
        pins = pins.join(index.filter(eligible).select(doc), doc, "left_semi")
    return pin_exact(fused_top_k(queries, index, query, doc, k, eligible, digits), pins, query, doc, k)


def hit_rate(results: DataFrame, expected: DataFrame, query: str, title: str, k: int = 3) -> DataFrame:
    """(n_queries, n_hits, hit_rate): queries with the expected text inside a title among their first k results."""
    shown = results.filter(F.col("rank") <= k).join(expected.select(query, "expected"), query, "right")
    hits = shown.groupBy(query).agg(F.max(F.coalesce(F.contains(F.col(title), F.col("expected")), F.lit(False))).alias("hit"))
    return hits.agg(
        F.count(F.lit(1)).alias("n_queries"), F.count_if("hit").alias("n_hits"),
        F.try_divide(F.count_if("hit").cast("double"), F.count(F.lit(1)).cast("double")).alias("hit_rate"),
    )
