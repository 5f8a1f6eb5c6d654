"""From raw documents to token ids: quality, lines, near copies, benchmark leaks, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps with
their columns; the last returns their ids. Every stage is written before the
next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm import bpe, jaccard, line_join, site_quality, tiling
from surveyloom.llm.queries import THRESHOLD, byte_bpe, quality_model, table
from surveyloom.sources.tables import cut


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return site_quality.keep_good(docs, quality_model(spark, sf_dir, docs), "text", "source", "lang", THRESHOLD)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier line go; every document stays, with its new length."""
    out = line_join.without_lines(docs, "doc_id", "text")
    return out.withColumn("n_chars", F.length("text").cast("long"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by the n-gram Jaccard join one stays."""
    return jaccard.one_of_each(docs, "doc_id", "text")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover a benchmark item go."""
    return tiling.clean(docs, "text", table(spark, sf_dir, "benchmark"), "item_id", "text")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, round_trip): ids are unsigned 32-bit, little-endian, and decode to the text."""
    slim = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    return bpe.with_round_trip(slim, "text", *byte_bpe()).drop("text")


STAGES = [("quality", quality), ("line_dedup", lines), ("near_copies", near_copies), ("decontamination", decontaminate), ("byte_bpe", tokenize)]
# Trained scores and merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
