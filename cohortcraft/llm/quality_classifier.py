"""Quality classifier: hashed word n-gram logistic regression, follow-the-regularised-leader.

Fitted on a bounded draw of labelled rows (``LIMIT``), applied to every whole
text as sparse dot products. Labels, language, source and id are never inputs
of a score.

Defined cases: null or empty text: the score of the intercept alone. No
labelled rows: every score is 0.5. Repeated rows get the same score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortcraft.llm import hashed_words as H
from cohortcraft.llm import labelled

LIMIT = 10_000
"""Labelled rows that the fit may use (a documented bound of the sample)."""

BITS = 18


class Ftrl:
    """Per-coordinate FTRL-proximal for the logistic loss; the last coordinate is the intercept."""

    def __init__(self, n: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> None:
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(n + 1), np.zeros(n + 1)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, at: np.ndarray, x: np.ndarray, y: float) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - y) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def train(xs: list[np.ndarray], ys: np.ndarray, bits: int = BITS, epochs: int = 3) -> bytes:
    model = Ftrl(1 << bits)
    intercept = 1 << bits
    rows = [H.counted(x) for x in xs]
    rng = np.random.default_rng(11)
    for _ in range(epochs):
        for r in rng.permutation(len(rows)):
            at, x = rows[r]
            model.update(np.append(at, intercept), np.append(x, 1.0), float(ys[r]))
    return model.weights().astype("<f4").tobytes()


def fit(docs: DataFrame, labels: DataFrame, limit: int = LIMIT, bits: int = BITS) -> np.ndarray:
    """docs (doc_id, text), labels (doc_id, label 0/1) -> weights, the intercept last."""
    model = labelled.fit(docs, labels, limit, bits, lambda xs, ys: train(xs, ys, bits))
    return np.zeros((1 << bits) + 1, np.float32) if model is None else np.frombuffer(model, "<f4")


def scored(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """Columns of ``docs`` but ``text``, with ``score`` in [0, 1] and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2^bits floats, whatever the input
    bits = int(len(weights) - 1).bit_length() - 1
    rest = [c for c in docs.columns if c not in (text, "score", "predicted")]
    plain = docs.select(*rest, F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value[:-1].reshape(-1, 1)
        for batch in batches:
            for i, j, flat, first in H.features(batch.column("_text"), bits):
                margin = H.linear(flat, first, table)[:, 0] + float(shared.value[-1])
                score = 1 / (1 + np.exp(-np.clip(margin, -35, 35)))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), pa.array(score, pa.float64())], names=[*rest, "score"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.select(*rest).schema)
    out = plain.mapInArrow(run, f"{kept + ', ' if rest else ''}score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
