"""Quality classifier: logistic regression over hashed word n-grams, trained with
follow-the-regularised-leader (FTRL-proximal) updates.

A text becomes the set of its hashed 1- and 2-grams, scaled to unit length. A
bounded sample of labelled rows is dealt to a fixed number of shards; every shard
runs FTRL over its rows, and the shards' weights are averaged, for a few rounds.
A score is one sparse dot product with a weight vector of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.common import Shipped, append_columns, binaries, map_batches, staged
from hearth.llm.hashing import WordHasher, rolled

DIMENSIONS = 1 << 20
TRAIN_ROWS = 20_000         # bound of the training sample (labelled rows)
SHARDS = 8
ROUNDS = 2
EPOCHS = 4
ALPHA, BETA, L1, L2 = 20.0, 1.0, 0.1, 0.01
#: Tokens are words (digits, letters, every byte of a non-ASCII character) and runs
#: of other visible characters; blanks part them.
FOLD = bytes(32 if 9 <= c <= 13 else c for c in range(256))
CLASSES = bytes(0 if c == 32 else 1 if c >= 128 or chr(c).isalnum() else 2 for c in range(256))


def hasher() -> WordHasher:
    return WordHasher(FOLD, CLASSES)


def features(texts: list[bytes | None], hashes: WordHasher) -> Iterator[np.ndarray]:
    """Per text, sorted distinct feature numbers of its tokens and pairs of tokens
    (none for null or empty)."""
    for slab in hashes.slabs(texts):
        one = (slab.hashes >> np.uint64(44)).astype(np.int32)
        two = (rolled(slab.hashes, 2).view(np.uint64) >> np.uint64(44)).astype(np.int32)
        for start, end in zip(slab.offsets[:-1].tolist(), slab.offsets[1:].tolist()):
            yield np.unique(np.concatenate([one[start:end], two[start:max(start, end - 1)]]))


class Ftrl:
    """FTRL-proximal state; the last place is the bias."""

    def __init__(self, weights: np.ndarray | None = None):
        self.n = np.zeros(DIMENSIONS + 1)
        self.z = np.zeros(DIMENSIONS + 1)
        if weights is not None:     # the state whose weights these are, before any gradient
            self.z = -weights * (BETA / ALPHA + L2) - np.sign(weights) * L1
            self.z[-1] = -weights[-1] * BETA / ALPHA

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)
        w = np.where(np.abs(z) <= L1, 0.0, w)
        return w

    def bias(self) -> float:
        return float(-self.z[-1] / ((BETA + np.sqrt(self.n[-1])) / ALPHA))

    def update(self, at: np.ndarray, y: int, weight: float = 1.0) -> None:
        x = 1.0 / np.sqrt(max(1, len(at)))
        w, b = self.weights(at), self.bias()
        p = 1.0 / (1.0 + np.exp(-np.clip(w.sum() * x + b, -35, 35)))
        for where, g, old in ((at, weight * (p - y) * x, w), (np.array([DIMENSIONS]), weight * (p - y), b)):
            sigma = (np.sqrt(self.n[where] + g * g) - np.sqrt(self.n[where])) / ALPHA
            self.z[where] += g - sigma * old
            self.n[where] += g * g

    def vector(self) -> np.ndarray:
        w = self.weights()
        w[-1] = self.bias()
        return w


def training_rows(docs: DataFrame, labels: DataFrame, learn_from: Column, rows: int = TRAIN_ROWS) -> DataFrame:
    """``shard, doc_id, y, features`` of at most ``rows`` labelled documents: those
    whose id hashes lowest among the label rows that ``learn_from`` admits. The
    sample is broadcast (its size has that bound) and its texts never leave the
    executors. Of several texts under one id, that with the least features counts, in
    the order of arrays, so that a run can be repeated; of several labels, the larger."""
    sample = labels.filter(learn_from & F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("quality").cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def run(batches):
        hashes = hasher()
        for batch in batches:
            sets = list(features(binaries(batch.column(1)), hashes))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sets, pa.list_(pa.int32()))],
                                             names=["doc_id", "y", "features"])

    sets = map_batches(found.select(F.col("doc_id").cast("long"), "text", "y"), run, "doc_id long, y int, features array<int>")
    one = sets.groupBy("doc_id").agg(F.min(F.struct("features", "y")).alias("s")).select("doc_id", "s.y", "s.features")
    return one.withColumn("shard", F.pmod(F.hash("doc_id"), F.lit(SHARDS)))


def train(rows: DataFrame) -> np.ndarray:
    """Weights (the last is the bias) after ``ROUNDS`` rounds of averaging. Both
    labels weigh the same in total. Without rows all weights are 0, so that every
    score is one half."""
    rows = staged(rows)
    count = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    rare = {y: max(count.values()) / n for y, n in count.items()}
    weights = np.zeros(DIMENSIONS + 1)
    for _ in range(ROUNDS):
        shipped = Shipped(rows.sparkSession, weights.astype(np.float32))

        def shard(frame: pd.DataFrame) -> pd.DataFrame:
            model = Ftrl(shipped.get().astype(np.float64))
            frame = frame.sort_values("doc_id")
            examples = [(np.asarray(f, np.int64), y) for f, y in zip(frame["features"], frame["y"])]
            for epoch in range(EPOCHS):
                for i in np.random.default_rng(epoch).permutation(len(examples)):
                    model.update(*examples[i], rare[examples[i][1]])
            w = model.vector()
            at = np.flatnonzero(w)
            return pd.DataFrame({"at": at, "w": w[at], "n": len(examples)})

        parts = rows.groupBy("shard").applyInPandas(shard, "at int, w double, n long")
        # shards weigh by their rows; a shard without a weight counts as 0
        total = max(1, sum(count.values()))
        mean = parts.groupBy("at").agg((F.sum(F.col("w") * F.col("n")) / total).alias("w")).toArrow()
        weights = np.zeros(DIMENSIONS + 1)
        weights[mean["at"].to_numpy()] = mean["w"].to_numpy()
    return weights


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``docs`` plus ``quality_score`` (0 to 1) of the whole ``text``; null and
    empty texts have no n-grams and score by the bias."""
    column = docs.columns.index("text")
    shipped = Shipped(docs.sparkSession, weights.astype(np.float32))

    def run(batches):
        w, hashes = shipped.get().astype(np.float64), hasher()
        for batch in batches:
            sums = []
            for at in features(binaries(batch.column(column)), hashes):
                sums.append(w[at].sum() / np.sqrt(max(1, len(at))) + w[-1])
            yield batch, [pa.array(1.0 / (1.0 + np.exp(-np.clip(np.array(sums, np.float64), -35, 35))), pa.float64())]

    return append_columns(docs, [T.StructField("quality_score", T.DoubleType())], run)
