"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text is the set of its words, pairs of neighbours and pairs with one word
between, hashed to 2^BITS coordinates. Each coordinate has its own learning rate,
and the L1 penalty leaves most weights at zero, so a model is a short table that
every task gets.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 20
# Labelled rows that a model is fitted on at most: those with the least hash of their id.
TRAIN_ROWS = 10_000
# Coordinates that fewer of these rows have are not learned from.
MIN_ROWS = 5
PASSES = 5
WORD = re.compile(r"\w+")
CACHE_WORDS = 200_000


class Hasher:
    """64-bit hashes of words, kept up to a bound."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def words(self, text: str) -> np.ndarray:
        import xxhash

        words = WORD.findall(text.lower())
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        for w in set(words).difference(self.known):
            self.known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(self.known.__getitem__, words), dtype=np.uint64, count=len(words))


@cache
def hasher() -> Hasher:
    return Hasher()


def _mixed(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    mix = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(salt))
    mix ^= mix >> np.uint64(29)
    mix *= np.uint64(0xBF58476D1CE4E5B9)
    return mix


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Coordinates of ``text``, with repeats; none for a null text or one without words."""
    w = hasher().words(text or "")
    every = np.concatenate((w, _mixed(w[:-1], w[1:], 1), _mixed(w[:-2], w[2:], 2)))
    return (every >> np.uint64(64 - bits)).astype(np.int32)


@dataclass
class Model:
    """Weights that are not zero, by coordinate, and the intercept."""

    intercept: float
    at: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.int32))
    weights: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.float32))
    bits: int = BITS

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, dtype=np.float32)
        out[self.at] = self.weights
        return out

    def score(self, text: str | None, dense: np.ndarray) -> float:
        found = features(text, self.bits)
        found = np.unique(found[dense[found] != 0])
        return float(_sigmoid(self.intercept + dense[found].sum(dtype=np.float64)))


def _sigmoid(x: float) -> float:
    return 1 / (1 + np.exp(-min(max(x, -35.0), 35.0)))


def ftrl(
    rows: list[np.ndarray],
    labels: list[int],
    bits: int = BITS,
    alpha: float = 2.0,
    beta: float = 1.0,
    l1: float = 10.0,
    l2: float = 0.1,
    passes: int = PASSES,
    held: np.ndarray | None = None,
) -> Model:
    """The model after ``passes`` over ``rows`` (distinct coordinates of each) in their order.

    ``held`` is a mask of the coordinates to learn from: without it, those MIN_ROWS rows have.
    Without rows every score is 0; with one label only, the label's share.
    """
    if not rows or len(set(labels)) < 2:
        share = min(max(float(np.mean(labels)) if labels else 0.0, 1e-9), 1 - 1e-9)
        return Model(float(np.log(share / (1 - share))), bits=bits)
    if held is None:
        held = np.bincount(np.concatenate(rows), minlength=1 << bits) >= MIN_ROWS
    rows = [np.append(r[held[r]], 1 << bits) for r in rows]  # the last coordinate is the intercept
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    penalty = np.full((1 << bits) + 1, l1)
    penalty[-1] = 0

    def weights(at) -> np.ndarray:
        zi, ni = z[at], n[at]
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - penalty[at], 0)
        return -shrunk / ((beta + np.sqrt(ni)) / alpha + l2)

    for _ in range(passes):
        for at, label in zip(rows, labels, strict=True):
            w = weights(at)
            slope = _sigmoid(w.sum()) - label
            after = n[at] + slope * slope
            z[at] += slope - (np.sqrt(after) - np.sqrt(n[at])) / alpha * w
            n[at] = after
    w = weights(np.arange((1 << bits) + 1))
    kept = np.flatnonzero(w[:-1]).astype(np.int32)
    return Model(float(w[-1]), kept, w[kept].astype(np.float32), bits)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are kept for measuring."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, bits: int = BITS) -> tuple[list, list]:
    """Coordinates and labels of at most ``rows`` labelled documents, in order of their ids' hash."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64(F.col("doc_id").cast("bigint"))
    # At most ``rows`` ids, so the broadcast is bounded.
    chosen = known.orderBy(order, "doc_id").limit(rows).select(F.col("doc_id").alias("id"), "toxic")

    def coordinates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [np.unique(features(x, bits)).tobytes() for x in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "toxic": batch["toxic"], "at": found})

    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("id", "toxic", "text")
    found = texts.mapInPandas(coordinates, "id bigint, toxic int, at binary")
    got = found.orderBy(F.xxhash64("id"), "id", "at").limit(rows).collect()
    return [np.frombuffer(r["at"], dtype=np.int32) for r in got], [r["toxic"] for r in got]


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    return ftrl(*training_rows(docs, labels, rows))


def score_texts(text: Column, model: Model) -> Column:
    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dense = model.dense()
        for texts in batches:
            yield pd.Series([model.score(x, dense) for x in texts], dtype="float64")

    return scores(text)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, held_out, score, predicted; a row for each row.

    A null text, and one without words, is scored by the intercept; a long one whole, by one
    task. The label, language, source and id of a row have no part in its score, so rows that
    share a text share it. Other columns may have any names; an empty table gives no rows.
    """
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_texts(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
