"""FTRL-proximal logistic regression over hashed word grams, shared by toxicity and quality.

Training sees a bounded sample of labelled rows (``max_rows``, smallest hash of the id first); features are hashed on
the executors and the driver receives at most ``max_rows`` sparse rows. Scoring covers every row: a map over Arrow
batches, no shuffle. L1 leaves few weights; only those travel (a number and a float32 each, ``2 ** bits`` at most) and a worker
spreads them over an array to look features up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import unused
from .textcore import Words, distinct_in, mixed, slices, texts

U = np.uint64

#: Bytes of text whose features are made at once: some 150 bytes of arrays a byte.
SLICE = 1 << 19

#: 0 parts tokens, 1 letters, digits and all bytes of other scripts, 2 signs.
KINDS = np.full(256, 2, np.uint8)
KINDS[[0x20, *range(0x09, 0x0E)]] = 0
KINDS[128:] = 1
KINDS[[c for c in range(128) if chr(c).isalnum()]] = 1


@dataclass(frozen=True)
class Grams:
    """What a text's features are: grams (word offsets), words cut to ``prefixes`` bytes (the back-off for unseen forms of a stem) and, with ``repeats``, how much of the text repeats itself.

    Each distinct gram of a text is one binary feature; an empty text has none.
    """

    offsets: tuple[tuple[int, ...], ...] = ((0,), (0, 1))
    prefixes: tuple[int, ...] = ()
    repeats: bool = False
    bits: int = 20

    def of(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first feature of each text and one more, feature numbers)."""
        n = len(at) - 1
        words = Words(data, at, KINDS)
        docs, keys = [], []
        for offsets in self.offsets:
            place, h = words.grams(offsets)
            docs.append(words.doc[place])
            keys.append(h >> U(64 - self.bits))
        for size in self.prefixes:
            place, h = words.prefixes(size)
            docs.append(words.doc[place])
            keys.append(h >> U(64 - self.bits))
        if self.repeats:
            for size in (1, 2, 3):
                place, h = words.grams(tuple(range(size)))
                d, _, count = distinct_in(words.doc[place], h)
                total = np.bincount(d, count, n)
                again = np.bincount(d, count - 1, n)
                shown = np.flatnonzero(total > 0)
                level = np.floor(10 * again[shown] / total[shown]).astype(np.uint64)
                docs.append(shown)
                keys.append(mixed(level + U(100 * size + 7)) >> U(64 - self.bits))
        doc, key, _ = distinct_in(np.concatenate(docs), np.concatenate(keys))
        return np.searchsorted(doc, np.arange(n + 1)), key.astype(np.int64)


@dataclass(frozen=True)
class Ftrl:
    """Per-coordinate rates (alpha, beta), L1 and L2 of the proximal step, passes over the sample."""

    alpha: float = 0.1
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 1.0
    passes: int = 3
    seed: int = 5

    def fit(self, rows: list[np.ndarray] | list[bytes], labels: np.ndarray, size: int) -> tuple[np.ndarray, float]:
        """(weights, bias). Zeros where the accumulated gradient stays within l1. rows: feature numbers, or their deflated gaps."""
        z, n = np.zeros(size), np.zeros(size)
        rate = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
        bias, bias_n = float(np.log(rate / (1 - rate))), 1.0
        order = np.random.Generator(np.random.PCG64(self.seed))
        for _ in range(self.passes):
            for i in order.permutation(len(rows)):
                x = rows[i] if isinstance(rows[i], np.ndarray) else np.cumsum(np.frombuffer(zlib.decompress(rows[i]), np.int32))
                w = self._weights(z[x], n[x])
                p = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35)))
                g = p - labels[i]
                if len(x):
                    sigma = (np.sqrt(n[x] + g * g) - np.sqrt(n[x])) / self.alpha
                    z[x] += g - sigma * w
                    n[x] += g * g
                bias_n += g * g
                bias -= 0.02 * g / np.sqrt(bias_n) * self.alpha
        return self._weights(z, n).astype(np.float32), bias

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return -(np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)


@dataclass
class Model:
    """``at`` and ``value``: the weights that are not zero."""

    grams: Grams
    at: np.ndarray
    value: np.ndarray
    bias: float
    empty: float
    trained_rows: int

    @classmethod
    def of(cls, grams: Grams, weights: np.ndarray, bias: float, empty: float, trained_rows: int) -> Model:
        at = np.flatnonzero(weights).astype(np.int32)
        return cls(grams, at, weights[at].astype(np.float32), bias, empty, trained_rows)

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.grams.bits, np.float32)
        out[self.at] = self.value
        return out

    def score_batch(self, column: pa.Array, weights: np.ndarray) -> np.ndarray:
        data, at = texts(column)
        first, key = self.grams.of(data, at)
        total = np.concatenate([[0.0], np.cumsum(weights[key], dtype=np.float64)])
        out = 1 / (1 + np.exp(-np.clip(total[first[1:]] - total[first[:-1]] + self.bias, -35, 35)))
        return np.where(np.diff(first) == 0, self.empty, out) if self.trained_rows else np.full(len(at) - 1, self.empty)


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, grams: Grams, ftrl: Ftrl, empty: float, max_rows: int = 8000) -> Model:
    """Fits on at most ``max_rows`` labelled rows. Null ids or labels are not used; several labels of one id count as their largest, and of
    several documents with one id the one whose features come first in order of bytes is used.

    ``empty`` is the score of texts without any word, and of all texts when no row is labelled.
    """
    chosen = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label_col)).cast("int").alias("__y"))
        .orderBy(F.xxhash64("__id"), "__id").limit(max_rows)
    )  # at most max_rows pairs of 12 bytes: the bound of the broadcast below
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(chosen), "__id").select("__id", "__y", "__text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "__text", SLICE):
                first, key = grams.of(*texts(batch.column("__text")))
                # A text's features ascend: their gaps deflate to a third, which is what the driver then holds.
                raw = [zlib.compress(np.diff(key[a:b], prepend=0).astype(np.int32).tobytes(), 1) for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("__id"), batch.column("__y"), pa.array(raw, pa.binary())], ["__id", "__y", "x"])

    kind = rows.schema["__id"].dataType.simpleString()
    # One row an id, whatever number of documents repeat it: so max_rows bounds what the driver gets.
    one_each = rows.mapInArrow(features, f"__id {kind}, __y int, x binary").groupBy("__id", "__y").agg(F.min("x").alias("x"))
    got = sorted(one_each.collect(), key=lambda r: (r[0], r[2]))
    size = 1 << grams.bits
    y = np.array([r[1] for r in got], float)
    if not len(y):
        return Model.of(grams, np.zeros(size, np.float32), 0.0, empty, 0)
    weights, bias = ftrl.fit([r[2] for r in got], y, size)
    return Model.of(grams, weights, bias, empty, len(y))


def scored(docs: DataFrame, model: Model, text_col: str, out: str = "score") -> DataFrame:
    """``docs`` with one more column at the end, the score of each whole text. Columns pass through unchanged, whatever their names.

    Where a column is called like ``out`` already, the new one has underscores behind its name.
    """
    from pyspark.sql.types import DoubleType, StructField, StructType

    out = unused(docs, out)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.schema.fields, StructField(out, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value.dense()
        for whole in batches:
            for batch in slices(whole, text_col, SLICE):
                s = shared.value.score_batch(batch.column(text_col), weights)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], [*batch.schema.names, out])

    return docs.mapInArrow(run, schema)


def scores_only(docs: DataFrame, model: Model, id_col: str, text_col: str) -> DataFrame:
    """(id, score): the text goes to the workers and does not come back."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value.dense()
        for whole in batches:
            for batch in slices(whole, "__text", SLICE):
                s = shared.value.score_batch(batch.column("__text"), weights)
                yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array(s)], ["__id", "__score"])

    out = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).mapInArrow(run, f"__id {kind}, __score double")
    return out.select(F.col("__id").alias(id_col), F.col("__score").alias("score"))


def verdict(score: Column, at: float) -> Column:
    return F.when(score >= at, 1).otherwise(0)


