"""Logistic regression on hashed word and character n-grams, trained on labelled rows and calibrated.

Words give single words and pairs, lower-cased in ASCII; characters give runs
of four bytes. Either view is a table of hashed weights; a text's score is the
bias plus, per view, the summed weights over the square root of their number,
so texts of every length use all their words. The model is two tables of fixed
size and three numbers, whatever the corpus.

Training reads a bounded sample of labelled rows (`sample`, chosen by a hash of
the id); their features are made in Arrow batches by Spark, and the weights are
fitted on the driver by full-batch gradient steps. Every fifth sampled row is
held out to calibrate: a logistic map from scores to probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import LOWER, U, Words, give_back, mix, pieces, text_array

BITS = 18
SAMPLE = 6_000  # labelled rows used for training, at most about that many
STEPS = 80


def word_features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, bounds of rows) of single words and of pairs inside a row."""
    h = words.hashes(lower=True)
    n = len(h)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(words.rows + 1, np.int64)
    both = np.empty(2 * n, U)
    both[0::2] = h
    both[1:-1:2] = mix(h[:-1] * U(3) + h[1:])
    both[-1] = 0
    valid = np.ones(2 * n, bool)
    valid[2 * words.of[1:][np.diff(words.of) > 0] - 1] = False  # no pair behind the last word
    at = np.concatenate(([0], np.cumsum(valid)))
    return (both[valid] >> U(64 - BITS)).astype(np.int64), at[2 * words.of]


def char_features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, bounds of rows) of runs of four bytes of the lower-cased text."""
    data = LOWER[words.data].astype(np.uint32)
    if len(data) < 4:
        return np.zeros(0, np.int64), np.zeros(words.rows + 1, np.int64)
    gram = data[:-3] | data[1:-2] << np.uint32(8) | data[2:-1] << np.uint32(16) | data[3:] << np.uint32(24)
    bucket = ((gram * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)
    # A row's own runs end three bytes before it does.
    low = np.minimum(words.bounds[:-1], len(bucket))
    high = np.maximum(np.minimum(words.bounds[1:] - 3, len(bucket)), low)
    valid = np.zeros(len(bucket) + 1, np.int64)
    np.add.at(valid, low, 1)
    np.add.at(valid, high, -1)
    own = np.cumsum(valid[:-1]) > 0
    at = np.concatenate(([0], np.cumsum(own)))
    return bucket[own], at[np.append(low, len(bucket))]


@dataclass
class Model:
    words: np.ndarray
    chars: np.ndarray
    bias: float
    slope: float
    shift: float
    prior: float  # share of good rows among the labelled ones

    def log_odds(self, words: Words) -> np.ndarray:
        """Calibrated log-odds that each row of the slice is good."""
        score = np.full(words.rows, self.bias)
        for table, (bucket, of) in ((self.words, word_features(words)), (self.chars, char_features(words))):
            total = np.concatenate(([0.0], np.cumsum(table[bucket], dtype=np.float64)))
            n = np.diff(of)
            score += (total[of[1:]] - total[of[:-1]]) / np.sqrt(np.maximum(n, 1))
        return self.slope * score + self.shift


def sample_labels(labels: DataFrame, key: str, good: Column, sample: int) -> DataFrame:
    """(key, good) of about `sample` labelled rows at most; a key labelled twice is good only if both say so."""
    rows = labels.select(F.col(key).alias("key"), good.cast("int").alias("good")).dropna().groupBy("key").agg(F.min("good").alias("good"))
    share = min(1.0, sample / max(rows.count(), 1))
    return rows.filter(F.pmod(F.xxhash64(F.lit("train"), "key"), F.lit(1 << 30)) < int(share * (1 << 30)))


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, good: Column, sample: int = SAMPLE) -> Model:
    """Fits the model on labelled rows. Without both classes it holds every text for as good as the labelled ones are."""
    chosen = F.broadcast(sample_labels(labels, key, good, sample))  # about `sample` rows of two numbers
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).join(chosen, "key")

    def run(batches):
        for batch in batches:
            made = []
            for words in pieces(text_array(batch.column("text"))):
                views = [word_features(words), char_features(words)]
                for i in range(words.rows):
                    index, value = [], []
                    for view, (bucket, of) in enumerate(views):
                        own, n = np.unique(bucket[of[i] : of[i + 1]], return_counts=True)
                        index.append((own + (view << BITS)).astype("<i4"))
                        value.append((n / max(np.sqrt(n.sum()), 1)).astype("<f4"))
                    made.append((np.concatenate(index).tobytes(), np.concatenate(value).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").cast(pa.string()), batch.column("good"), pa.array([m[0] for m in made], pa.binary()), pa.array([m[1] for m in made], pa.binary())],
                ["key", "good", "index", "value"],
            )

    slim = rows.select(F.col("key").cast("string"), "good", "text")
    features = slim.mapInArrow(run, "key string, good int, index binary, value binary")
    # The sample is bounded, so one task fits it and the driver gets only the model.
    fitted = features.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(_fit_table, "words binary, chars binary, numbers array<double>").collect()
    if not fitted:
        return Model(np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32), 0.0, 1.0, 0.0, 0.5)
    return Model(np.frombuffer(fitted[0]["words"], "<f4"), np.frombuffer(fitted[0]["chars"], "<f4"), *fitted[0]["numbers"])


def _fit_table(found: pa.Table) -> pa.Table:
    found = found.sort_by([("key", "ascending"), ("index", "ascending")])
    y = found.column("good").to_numpy().astype(np.float64)
    prior = float(np.clip(y.mean(), 0.05, 0.95))
    if y.min() == y.max():
        w, bias, slope, shift = np.zeros(2 << BITS), 0.0, 1.0, float(np.log((y.sum() + 1) / ((1 - y).sum() + 1)))
    else:
        blocks = list(_blocks(found))
        held = np.arange(len(y)) % 5 == 4
        w, bias = _fit(blocks, y, ~held, 2 << BITS)
        score = np.concatenate([_scores(block, w) for block in blocks]) + bias
        slope, shift = _calibrate(score[held], y[held]) if len(set(y[held])) == 2 else (1.0, 0.0)
        del blocks
    give_back()
    w = w.astype("<f4")
    numbers = [float(bias), slope, shift, prior]
    return pa.table({"words": [w[: 1 << BITS].tobytes()], "chars": [w[1 << BITS :].tobytes()], "numbers": [numbers]}, pa.schema([("words", pa.binary()), ("chars", pa.binary()), ("numbers", pa.list_(pa.float64()))]))


def _blocks(found: pa.Table, rows: int = 100):
    """(first row, rows, row of each feature, index, value) of a few texts at a time."""
    for at in range(0, found.num_rows, rows):
        part = found.slice(at, rows)
        index = [np.frombuffer(b.as_buffer(), "<i4") for b in part.column("index")]
        value = [np.frombuffer(b.as_buffer(), "<f4") for b in part.column("value")]
        row = np.repeat(np.arange(len(index), dtype=np.int16), [len(i) for i in index])
        yield at, len(index), row, np.concatenate(index), np.concatenate(value)


def _scores(block: tuple, w: np.ndarray) -> np.ndarray:
    _, rows, row, index, value = block
    return np.bincount(row, w[index] * value, rows)


def _fit(blocks: list, y: np.ndarray, used: np.ndarray, size: int, l2: float = 3e-5) -> tuple[np.ndarray, float]:
    """Adam on the mean log-loss of the used rows with a small ridge."""
    w, bias = np.zeros(size), float(np.log(y[used].mean() / (1 - y[used].mean())))
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for t in range(1, STEPS + 1):
        g, gb = l2 * w, 0.0
        for block in blocks:
            at, rows, row, index, value = block
            own = slice(at, at + rows)
            z = np.clip(_scores(block, w) + bias, -30, 30)
            e = np.where(used[own], 1 / (1 + np.exp(-z)) - y[own], 0.0) / used.sum()
            g += np.bincount(index, e[row] * value, size)
            gb += e.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.05 * np.sqrt(1 - 0.99**t) / (1 - 0.9**t)
        w -= rate * m / (np.sqrt(v) + 1e-6)
        bias -= rate * mb / (np.sqrt(vb) + 1e-6)
    return w, bias


def _calibrate(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of the logistic map that fits held-out rows, by Newton steps with smoothed targets."""
    n1, n0 = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, beta = np.stack([score, np.ones_like(score)]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(beta @ x, -30, 30)))
        h = (x * (p * (1 - p))) @ x.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x @ (p - target) + 1e-3 * (beta - [1.0, 0.0]))
        beta = beta - step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 1e-3)), float(beta[1])


def score_batches(batches: Iterator[pa.RecordBatch], text: str, model: Model, more) -> Iterator[pa.RecordBatch]:
    """Each batch without `text` and with the columns `more(words, log_odds)` makes of its slices, as arrays by name."""
    for batch in batches:
        made: dict[str, list[np.ndarray]] = {}
        for words in pieces(text_array(batch.column(text))):
            for name, values in more(words, model.log_odds(words)).items():
                made.setdefault(name, []).append(values)
        if made:
            kept = [c for c in batch.schema.names if c != text]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(np.concatenate(v)) for v in made.values())], [*kept, *made])


