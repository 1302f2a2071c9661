"""Toxicity by logistic regression trained with FTRL-proximal.

Features are hashed words, word pairs and skip-pairs, present or absent, in 2**BITS
places.  Each coordinate has its own rate, alpha / (beta + sqrt(sum of squared
gradients)), and an L1 term keeps most weights at zero, so what is broadcast is a
short list of (place, weight) within a table of fixed size.

Training reads at most about TRAIN_ROWS labelled rows, up to half of them toxic (a
documented bound; the rows are chosen by a hash of the id).  Their features are made in parallel; the passes
over them run in one task, whose input that bound limits.  Scoring is a map over
all documents without a shuffle.

Edge cases: null and empty texts have no features and score by the bias alone; rows
without a label train nothing, a label table without rows gives a bias of 0 and
scores of 0.5; repeated rows score alike; further columns of ``docs`` are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchkit.llm.common import WordHashes, bounded_sample, held_out, mapped, slices, written
from batchkit.llm.features import word_grams

BITS = 20
SKIPS = (1, 2)
TRAIN_ROWS = 20_000
PASSES = 5
ALPHA, BETA, L1, L2 = 1.0, 1.0, 10.0, 0.1
THRESHOLD = 0.7


class Ftrl:
    """FTRL-proximal over sparse binary features; place 2**bits is the bias, which isn't penalised."""

    def __init__(self, bits: int = BITS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        l1 = np.where(at == len(self.z) - 1, 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2))

    def step(self, at: np.ndarray, label: int, weight: float = 1.0) -> None:
        """One row: a prediction, then an update of its coordinates."""
        at = np.append(at, len(self.z) - 1)
        w = self.weights(at)
        g = weight * (1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label)
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g

    def sparse(self) -> tuple[np.ndarray, np.ndarray]:
        used = np.flatnonzero(self.n)
        w = self.weights(used)
        return used[w != 0], w[w != 0]


def train(labelled: DataFrame, text: str = "text", label: str = "label", rows: int = TRAIN_ROWS, passes: int = PASSES) -> DataFrame:
    """(place int, weight double): the weights that aren't zero; place 2**BITS is the bias.

    ``labelled`` must already be bounded (see :func:`sample_for`).
    """
    def features(batches):
        words = WordHashes()
        for b in slices(batches):
            at = [word_grams(h, BITS, SKIPS).astype(np.int32) for h, _ in words.many(b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("label"), b.column("order"), pa.array(at, pa.list_(pa.int32()))], names=["label", "order", "at"])

    known = labelled.select(F.col(text).alias("text"), F.col(label).cast("int").alias("label")).where("label in (0, 1)") \
                    .withColumn("order", F.xxhash64(F.lit(7), "text")).transform(mapped, features, "label int, order long, at array<int>")

    def fit(batches):
        model, seen = Ftrl(), []
        for b in batches:
            seen += zip(b.column("label").to_pylist(), (np.asarray(x.values) for x in b.column("at")), strict=True)
        for _ in range(passes):
            for y, at in seen:
                model.step(at, y)
        place, weight = model.sparse()
        yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(weight)], names=["place", "weight"])

    return known.repartition(1).sortWithinPartitions("order").transform(mapped, fit, "place int, weight double")


def sample_for(docs: DataFrame, labels: DataFrame, target: str, doc_id: str = "doc_id", rows: int = TRAIN_ROWS, balanced: bool = False) -> DataFrame:
    """The bounded labelled sample (text, label) of rows that aren't held out; ``balanced``: up to half of each label."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(target).cast("int").alias("label")) \
                  .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("id")).groupBy("id").agg(F.max("label").alias("label"))
    known = written(known, "labels")
    if balanced:
        sample = bounded_sample(known.where("label = 1"), rows // 2, 11, "id").unionByName(bounded_sample(known.where("label = 0"), rows // 2, 11, "id"))
    else:
        sample = bounded_sample(known, rows, 11, "id")
    # the ids of the sample are bounded by ``rows``: small enough to be sent to where the texts are read
    return docs.select(F.col(doc_id).alias("id"), "text").join(F.broadcast(sample), "id").select("text", "label")


def score(docs: DataFrame, weights: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) per row of ``docs``."""
    got = weights.toArrow()  # at most 2**BITS + 1 rows
    table = np.zeros((1 << BITS) + 1)
    table[got.column("place").to_numpy()] = got.column("weight").to_numpy()
    used = np.flatnonzero(table)
    shared = docs.sparkSession.sparkContext.broadcast((used, table[used]))
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        full = np.zeros((1 << BITS) + 1)
        full[shared.value[0]] = shared.value[1]
        words = WordHashes()
        for b in slices(batches):
            sums = np.array([full[word_grams(h, BITS, SKIPS)].sum() for h, _ in words.many(b.column("text").to_pylist())], float) + full[-1]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(1 / (1 + np.exp(-np.clip(sums, -35, 35))))], names=["id", "score"])

    scored = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).transform(mapped, run, f"id {kind}, score double")
    return scored.select(F.col("id").alias(doc_id), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, target: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted): learnt from the labels that aren't held out, applied to every row."""
    got = score(docs, train(sample_for(docs, labels, target, balanced=True)))
    return got.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
