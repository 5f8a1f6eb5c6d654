"""Document quality with hierarchical empirical Bayes over hosts and their paths.

A document's own evidence is a log-likelihood ratio from the n-gram model. The
share of good documents of a host is Beta-distributed around the corpus share,
that of a path around its host; how tightly is estimated from the grouped
counts by moments. A group's posterior share is

    (strength * parent share + expected good documents) / (strength + documents)

so sparse groups stay near their parent and large ones speak for themselves. A
document is kept when evidence and the posterior share of its path together
give a probability of at least `threshold`.

The corpus is reduced to one row per path by partial aggregation before any
shuffle, hot hosts included. Path and host tables are written once; their known
size lets Spark choose the join, and a large one is joined by key with skewed
keys split. Null hosts and paths are groups of their own, null texts are empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import cut
from .hashlr import Model
from .words import pieces, text_array

WEAKEST, STRONGEST = 2.0, 1e6


def evidence(text: Column, model: Model, spark: SparkSession) -> Column:
    """The model's log-odds without its prior, bounded. Only the text travels to Python."""
    shared = spark.sparkContext.broadcast(model)  # two weight tables of fixed size
    offset = float(np.log(model.prior / (1 - model.prior)))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        scores = [np.clip(shared.value.log_odds(words) - offset, -30, 30) for words in pieces(text_array(texts))]
        return pa.array(np.concatenate(scores) if scores else [], pa.float64())

    return score(text)


def _logit(p: Column) -> Column:
    q = F.greatest(F.least(p, F.lit(1 - 1e-9)), F.lit(1e-9))
    return F.log(q / (1 - q))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _strength(groups: DataFrame, parent: Column, share: Column, n: Column) -> float:
    """How many documents the parent's share counts for: between-group variance against that of counts, by moments.

    One row reaches the driver.
    """
    spread = F.pow(share - parent, 2)
    row = groups.agg(
        F.sum(n * spread).alias("between"), F.sum(parent * (1 - parent)).alias("chance"), F.sum(n).alias("n"),
        F.sum(n * parent * (1 - parent)).alias("whole"),
    ).first()
    if not row["n"] or not row["whole"]:
        return STRONGEST
    excess = (row["between"] - row["chance"]) / row["n"]  # variance of true shares
    if excess <= 0:
        return STRONGEST
    return float(min(max(row["whole"] / row["n"] / excess - 1, WEAKEST), STRONGEST))


def path_shares(scored: DataFrame, prior: float) -> DataFrame:
    """(host, path, n_path, n_host, host_share, path_share) of every path, from rows (host, path, evidence)."""
    paths = cut(
        scored.select("host", "path", _sigmoid(F.col("evidence") + float(np.log(prior / (1 - prior)))).alias("p"))
        .groupBy("host", "path").agg(F.count(F.lit(1)).alias("n_path"), F.sum("p").alias("good_path")),
        "paths",
    )
    hosts = cut(paths.groupBy("host").agg(F.sum("n_path").alias("n_host"), F.sum("good_path").alias("good_host")), "hosts")
    whole = hosts.agg(F.sum("n_host").alias("n"), F.sum("good_host").alias("good")).first()
    share = float(whole["good"] / whole["n"]) if whole["n"] else prior
    strength = _strength(hosts, F.lit(share), F.col("good_host") / F.col("n_host"), F.col("n_host"))
    hosts = hosts.withColumn("host_share", (strength * F.lit(share) + F.col("good_host")) / (strength + F.col("n_host"))).drop("good_host")
    both = cut(paths.join(hosts, "host"), "paths-of-hosts")
    strength = _strength(both, F.col("host_share"), F.col("good_path") / F.col("n_path"), F.col("n_path"))
    return both.withColumn("path_share", (strength * F.col("host_share") + F.col("good_path")) / (strength + F.col("n_path"))).drop("good_path")


def classify(docs: DataFrame, model: Model, text: str, host: str, path: str, threshold: float, keep_columns: list[str]) -> DataFrame:
    """(row, evidence, host_share, path_share, p_good, kept) of every row of docs; `row` holds the keep_columns."""
    # Null has a name of its own, so that joins need no null-safe comparison.
    named = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    slim = docs.select(F.struct(*keep_columns).alias("row"), F.col(text).cast("string").alias("text"), named(host).alias("host"), named(path).alias("path"))
    # Texts are scored once: the written evidence serves the groups and the verdicts.
    stored = cut(slim.withColumn("evidence", evidence(F.col("text"), model, docs.sparkSession)).drop("text"), "evidence")
    shares = cut(path_shares(stored, model.prior), "path-shares").select("host", "path", "host_share", "path_share")
    p = _sigmoid(F.col("evidence") + _logit(F.col("path_share")))
    return stored.join(shares, ["host", "path"], "left").select("row", "evidence", "host_share", "path_share", p.alias("p_good"), (p >= threshold).alias("kept"))


def keep_good(docs: DataFrame, model: Model, text: str, host: str, path: str, threshold: float) -> DataFrame:
    """The rows of docs, all columns, that are kept."""
    return classify(docs, model, text, host, path, threshold, docs.columns).filter("kept").select("row.*")
