"""Document quality: counting rules and a calibrated n-gram model against fixed thresholds.

The rules fail a text with fewer than 10 words, or with over 20 % of its words
in five-word windows that occur twice or more in it. What passes is kept when
the model's probability of a good row is at least `threshold`. Null counts as
an empty text. Rows are independent: no shuffle, copies get equal verdicts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashlr import Model, score_batches
from .words import U, Words, mix, range_hash, windows

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


def per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of flags between consecutive bounds."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def earlier_equal(hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is a later copy, is in a group of two or more) of each hash among those of its row."""
    key = mix(hashes + row.astype(U) * U(0xD6E8FEB86659FD93))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    later, group = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:]] = same
    group[order[1:]] |= same
    group[order[:-1]] |= same
    return later, group


def base_counts(words: Words) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each row of a slice."""
    data, n = words.data, words.counts()
    inside = np.zeros(len(data) + 1, np.int8)
    inside[words.starts] += 1
    np.add.at(inside, words.ends, -1)
    inside = np.cumsum(inside[:-1]) > 0
    # Lines: between newlines and row bounds.
    breaks = np.flatnonzero(data == 10)
    low = np.sort(np.concatenate((words.bounds[:-1], breaks + 1)), kind="stable")
    high = np.sort(np.concatenate((words.bounds[1:], breaks)), kind="stable")
    high = np.maximum(high, low)
    has = np.searchsorted(words.starts, high) > np.searchsorted(words.starts, low)
    low, high = low[has], high[has]
    row = np.searchsorted(words.bounds, low, "right") - 1
    copies, _ = earlier_equal(range_hash(data.astype(U), low, high), row)
    # Words in repeated windows.
    window, first = windows(words.hashes(), words.of, 5)
    _, again = earlier_equal(window, words.doc()[first])
    cover = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(cover, first[again], 1)
    np.add.at(cover, first[again] + 5, -1)
    return {
        "n_words": n.astype(np.int64),
        "word_chars": per_row(inside & ((data & 0xC0) != 0x80), words.bounds),
        "n_symbols": per_row(SYMBOLS[data], words.bounds),
        "n_dup_lines": np.bincount(row[copies], minlength=words.rows).astype(np.int64),
        "n_repeat_words": per_row(np.cumsum(cover[:-1]) > 0, words.of),
    }


def verdicts(docs: DataFrame, model: Model, key: str, text: str, threshold: float) -> DataFrame:
    """(key, the base counts, base_failed, p_good, kept) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two weight tables of fixed size

    def more(words: Words, odds: np.ndarray) -> dict[str, np.ndarray]:
        base = base_counts(words)
        failed = (base["n_words"] < 10) | (100 * base["n_repeat_words"] > 20 * base["n_words"])
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        return {**base, "base_failed": failed, "p_good": p, "kept": ~failed & (p >= threshold)}

    slim = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = dict(slim.dtypes)["key"]
    schema = f"key {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, p_good double, kept boolean"
    return slim.mapInArrow(lambda batches: score_batches(batches, "text", shared.value, more), schema).withColumnRenamed("key", key)
