"""Quality by nearest neighbours in a latent-semantic space.

Terms are language-free: runs of three byte classes, repeats of words, lengths (see
:mod:`batchkit.llm.features`).  Labelled rows, at most about TRAIN_ROWS (a documented
bound), give a term-document matrix with tf-idf weights, whose truncated singular
value decomposition gives DIMENSIONS latent axes; the labelled vectors and the
projection are broadcast, both of bounded size.  Every document is projected and
compared with all labelled vectors by blocked matrix products (exact cosines); its
NEIGHBOURS most similar vote with weight similarity**POWER.

The score is the weighted share of votes for label 1, in which both classes weigh as
in the sample.  Edge cases: null and empty texts have no terms and take the share of
label 1 in the sample, as does everything where no labels exist (then 1.0, nothing
is rejected); repeated rows score alike; further columns of ``docs`` are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchkit.llm.common import WordHashes, held_out, mapped, slices
from batchkit.llm.features import TERMS, all_shape_terms
from batchkit.llm.toxicity import sample_for

TRAIN_ROWS = 4000
DIMENSIONS = 48
NEIGHBOURS = 15
POWER = 8
THRESHOLD = 0.5
#: Documents per matrix product.
BLOCK = 256


class Model:
    """Projection to the latent space, and the labelled vectors in it."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, dimensions: int = DIMENSIONS):
        self.labels = labels.astype(np.float32)
        self.prior = float(labels.mean()) if len(labels) else 1.0
        df = np.zeros(TERMS)
        for at, _ in rows:
            df[at] += 1
        self.idf = (np.log((1 + len(rows)) / (1 + df)) + 0.05).astype(np.float32)
        x = np.zeros((len(rows), TERMS), np.float32)
        for i, (at, w) in enumerate(rows):
            x[i, at] = w
        x = self._unit(x * self.idf)
        # the right singular vectors, from the smaller of the two Gram matrices
        used = np.flatnonzero(df)
        y = x[:, used].astype(np.float64)
        if len(used) and len(rows):
            values, vectors = np.linalg.eigh(y.T @ y)
            keep = np.argsort(values)[::-1][:dimensions]
            self.axes = np.zeros((TERMS, len(keep)), np.float32)
            self.axes[used] = vectors[:, keep]
        else:
            self.axes = np.zeros((TERMS, 1), np.float32)
        self.vectors = self._unit(x @ self.axes)

    @classmethod
    def load(cls, arrays: dict) -> "Model":
        out = cls.__new__(cls)
        vars(out).update(arrays)
        return out

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        size = np.linalg.norm(x, axis=1, keepdims=True)
        return x / np.where(size > 0, size, 1)

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]], neighbours: int = NEIGHBOURS) -> np.ndarray:
        """The vote for label 1 of each row."""
        out = np.full(len(rows), self.prior)
        k = min(neighbours, len(self.labels))
        if not k:
            return out
        for at in range(0, len(rows), BLOCK):
            part = rows[at:at + BLOCK]
            latent = self._unit(np.stack([self._project(*r) for r in part]))
            near = latent @ self.vectors.T
            top = np.argpartition(near, len(self.labels) - k, axis=1)[:, -k:]
            weight = np.clip(np.take_along_axis(near, top, 1), 0, 1) ** POWER
            total = weight.sum(axis=1)
            vote = (weight * self.labels[top]).sum(axis=1)
            out[at:at + len(part)] = np.where(total > 0, vote / np.where(total > 0, total, 1), self.prior)
        return out

    def _project(self, at: np.ndarray, w: np.ndarray) -> np.ndarray:
        return (w * self.idf[at]) @ self.axes[at]


def train(labelled: DataFrame) -> Model:
    """The model of a bounded frame (text, label): its terms are made in parallel, the decomposition on the driver (TERMS x TERMS)."""
    def terms(batches):
        words = WordHashes()
        for b in slices(batches):
            rows = all_shape_terms(b.column("text").to_pylist(), words)
            yield pa.RecordBatch.from_arrays([b.column("label"), b.column("order"), pa.array([a.astype(np.int16) for a, _ in rows], pa.list_(pa.int16())), pa.array([w for _, w in rows], pa.list_(pa.float32()))],
                                             names=["label", "order", "at", "w"])

    got = labelled.select("text", F.col("label").cast("int").alias("label")).where("label in (0, 1)").withColumn("order", F.xxhash64(F.lit(7), "text")) \
                  .transform(mapped, terms, "label int, order long, at array<smallint>, w array<float>").toArrow().sort_by("order")
    rows = [(np.asarray(a.values).astype(np.int64), np.asarray(w.values)) for a, w in zip(got.column("at"), got.column("w"), strict=True)]
    return Model(rows, got.column("label").to_numpy().astype(np.int64))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) per row of ``docs``; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        words, model = WordHashes(), Model.load(shared.value)
        for b in slices(batches):
            scores = []
            texts = b.column("text").to_pylist()
            for i in range(0, len(texts), BLOCK):
                scores.append(model.score(all_shape_terms(texts[i:i + BLOCK], words)))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())], names=["id", "score"])

    scored = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).transform(mapped, run, f"id {kind}, score double")
    return scored.select(F.col("id").alias(doc_id), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, target: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted): learnt from the labels that aren't held out, applied to every row."""
    got = score(docs, train(sample_for(docs, labels, target, rows=TRAIN_ROWS)))
    return got.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches the threshold; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches):
        words, model = WordHashes(), Model.load(shared.value)
        for b in slices(batches):
            texts = b.column(b.schema.get_field_index(text)).to_pylist()
            scores = [model.score(all_shape_terms(texts[i:i + BLOCK], words)) for i in range(0, len(texts), BLOCK)]
            yield b.filter(pa.array(np.concatenate(scores) >= threshold)) if scores else b

    return docs.transform(mapped, run, docs.schema)
