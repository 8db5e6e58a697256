"""Toxicity by FTRL-proximal logistic regression over hashed n-grams and skip-grams.

Features are the presence of single words, pairs of neighbours and pairs with a word
between, each hashed to a coordinate. FTRL-proximal gives every coordinate a rate of
its own; its L1 term leaves most weights at zero, so the model is small enough for a
broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows

WORD = re.compile(r"[^\W_]+")

# Odd multipliers that tell the words of a pair and the kinds of feature apart.
FIRST, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
NEIGHBOURS, SKIPPED = np.uint64(0x165667B19E3779F9), np.uint64(0x27D4EB2F165667C5)


@dataclass(frozen=True)
class Settings:
    """`train_rows` bounds the labelled rows learned from: those of smallest hash.

    `l1` counts once for each row learned from, as the sums it is held against do, so
    that a feature of a few rows keeps no weight. Toxic rows count `toxic_weight` times.
    """

    train_rows: int = 10_000
    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.01
    l2: float = 1.0
    toxic_weight: float = 3.0
    epochs: int = 6
    cached_words: int = 300_000


@dataclass
class Model:
    """Weights that are not zero, by coordinate; the bias has the last coordinate."""

    coordinates: np.ndarray
    weights: np.ndarray
    settings: Settings

    def dense(self) -> np.ndarray:
        weights = np.zeros((1 << self.settings.bits) + 1)
        weights[self.coordinates] = self.weights
        return weights


class Hasher:
    """Coordinates of a text's features, repeats included."""

    def __init__(self, settings: Settings):
        self.shift = np.uint64(64 - settings.bits)
        self.cached_words = settings.cached_words
        self.hashes: dict[str, int] = {}

    def coordinates(self, text: str | None) -> np.ndarray:
        words = WORD.findall(text.lower()) if text else []
        hashes = self.hashes
        if len(hashes) > self.cached_words:
            hashes.clear()
        for word in set(words).difference(hashes):
            hashes[word] = xxhash.xxh64_intdigest(word)
        h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        first, second = h * FIRST, h * SECOND
        mixed = [h * FIRST, (first[:-1] ^ second[1:]) * NEIGHBOURS, (first[:-2] ^ second[2:]) * SKIPPED]
        return (np.concatenate(mixed) >> self.shift).astype(np.int64)


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def learn(rows: list[tuple[np.ndarray, int]], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over rows of distinct coordinates and labels, in their order."""
    bias = 1 << settings.bits
    threshold = settings.l1 * len(rows)
    z, n = np.zeros(bias + 1), np.zeros(bias + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        l1 = np.where(at == bias, 0.0, threshold)
        rate = (settings.beta + np.sqrt(n[at])) / settings.alpha + settings.l2
        return np.where(np.abs(zs) <= l1, 0.0, (np.sign(zs) * l1 - zs) / rate)

    for _ in range(settings.epochs):
        for coordinates, label in rows:
            at = np.append(coordinates, bias)
            w = weights(at)
            gradient = (sigmoid(w.sum()) - label) * (settings.toxic_weight if label else 1.0)
            square = gradient * gradient
            step = (np.sqrt(n[at] + square) - np.sqrt(n[at])) / settings.alpha
            z[at] += gradient - step * w
            n[at] += square
    at = np.flatnonzero(n)
    found = weights(at)
    return at[found != 0], found[found != 0]


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn `toxic` of `labels` from the texts of `docs`, joined by doc_id.

    NULL labels, texts and ids teach nothing; a document labelled twice counts with
    its larger label, and of rows of one id the text of least hash. At most `train_rows` labelled ids are used, those of smallest
    hash, so that one task can hold them. With nothing to learn from all weights are
    zero and every score is 0.5.
    """
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(settings.train_rows)
    )
    # The bound on `chosen` makes it fit for a broadcast.
    labelled = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    # Rows that share an id are one; their texts are reduced before they are shuffled.
    rows = labelled.groupBy("doc_id").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.max("toxic").alias("toxic")
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(settings)
        for batch in batches:
            texts, labels, keys = (batch.column(c).to_pylist() for c in ("text", "toxic", "doc_id"))
            distinct = [np.unique(hasher.coordinates(t)).astype(np.int32) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([int(x > 0) for x in labels], pa.int32()), pa.array(distinct, pa.list_(pa.int32()))],
                names=["doc_id", "toxic", "at"],
            )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [
            (np.array(at, np.int64), label)
            for batch in batches
            for at, label in zip(batch.column("at").to_numpy(zero_copy_only=False), batch.column("toxic").to_pylist())
        ]
        coordinates, weights = learn(rows, settings)
        yield pa.RecordBatch.from_arrays([pa.array(coordinates, pa.int64()), pa.array(weights)], names=["at", "weight"])

    features = rows.mapInArrow(hashed, "doc_id long, toxic int, at array<int>")
    in_order = features.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", F.xxhash64("at"))
    learned = in_order.select("toxic", "at").mapInArrow(train, "at long, weight double").toArrow()
    return Model(learned.column("at").to_numpy(), learned.column("weight").to_numpy(), settings)


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] | None = None) -> DataFrame:
    """The rows of `docs` with `score`, 0 to 1, and `predicted`, 1 from 0.5 on.

    NULL and empty texts have no features and get the score of the bias. Texts are
    read whole. Input columns named as an output are replaced.
    """
    keep = tuple(c for c in keep or docs.columns if c not in ("score", "predicted"))
    shared = docs.sparkSession.sparkContext.broadcast((model.coordinates, model.weights))
    settings = model.settings

    def make():
        weights = Model(*shared.value, settings).dense()
        hasher = Hasher(settings)

        def one(text: str | None) -> float:
            at = hasher.coordinates(text)
            present = np.unique(at[weights[at] != 0])
            return sigmoid(weights[present].sum() + weights[-1])

        def many(texts: list[str | None]):
            scores = [one(text) for text in texts]
            return scores, [int(s >= 0.5) for s in scores]

        return many

    return map_rows(docs, ["text"], keep, "score double, predicted int", make)
