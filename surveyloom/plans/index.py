"""The retrieval index: built once from the chunks, then searched by batches of questions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import retrieval as R


def build_index(
    chunks: DataFrame, out: str, key: str = "doc_id", text: str = "text", vectors: DataFrame | None = None,
    stop: Sequence[str] = (), max_features: int = 50_000, dimensions: int = 256, keep: Sequence[str] = (),
) -> dict[str, str]:
    """Writes `vocabulary`, `index`, `blocks` and, if it fits one, `model` under `out`. Starts jobs.

    index(key, kept columns, vec, terms, weights, group): a row for each chunk;
    terms are positions in the ordered vocabulary. blocks: `posting_blocks` of
    it. `vectors(key, vec)` are the dense vectors; without them an LSA model of
    the chunks supplies them.
    """
    spark, base = chunks.sparkSession, out.rstrip("/")
    paths = {n: f"{base}/{n}" for n in ("vocabulary", "index", "blocks")}

    def stored(df: DataFrame, path: str) -> DataFrame:
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    # texts are cut again for the weights: stored, their terms would take several times the room
    vocab = stored(R.fit_vocabulary(chunks, key, text, stop, max_features), paths["vocabulary"])
    weights = R.text_weights(chunks, key, text, stop, R.Terms.of(vocab))
    if vectors is None:
        weights = stored(weights, f"{base}/weights")
        model = R.LsaModel.of_rows(weights, vocab, dimensions, stop)
        paths["model"] = f"{base}/model"
        model.save(paths["model"])
        vectors = model.embed_rows(weights, key)
    dense = chunks.select(key, *keep).join(vectors, key)
    index = stored(R.in_groups(dense.join(weights, key)), paths["index"])
    stored(R.posting_blocks(index, key), paths["blocks"])
    return paths


def load_index(spark: SparkSession, paths: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(paths["vocabulary"]), spark.read.parquet(paths["index"])


def question_side(
    questions: DataFrame, vocab: DataFrame, key: str, text: str = "text", stop: Sequence[str] = (), model: R.LsaModel | None = None,
) -> DataFrame:
    """Questions with their vectors (`vec`, made by the index's model unless present) and postings in its vocabulary."""
    weights = R.text_weights(questions, key, text, stop, R.Terms.of(vocab))
    if model is not None:
        questions = questions.join(model.embed_rows(weights, key), key)
    return R.with_postings(questions, weights, key)
