"""A bounded sample of labelled documents as hashed features, for fitting.

The sample holds the ``limit`` labelled rows with the smallest hash of the id (a
fixed draw; all of them when there are fewer). Its size is bounded by that
parameter, so its ids may be broadcast and its features may meet in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortcraft.llm import hashed_words as H
from cohortcraft.llm.storage import written


def _features(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, flat, first in H.features(batch.column("text"), bits):
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column("u").slice(i, j - i), batch.column("label").slice(i, j - i), lists], names=["u", "label", "features"])

    return run


def fit(docs: DataFrame, labels: DataFrame, limit: int, bits: int, train: Callable[[list[np.ndarray], np.ndarray], bytes]) -> bytes | None:
    """docs (doc_id, text), labels (doc_id, label int): run ``train(features, labels)`` in a task, return its bytes.

    Rows without an id or a label are left out; no rows: None.
    """
    drawn = (
        labels.where("doc_id IS NOT NULL AND label IS NOT NULL")
        .select("doc_id", F.col("label").cast("int").alias("label"), F.xxhash64("doc_id", F.lit("draw")).alias("u"))
        .orderBy("u", "doc_id", "label")
        .limit(limit)
    )
    sample = written(drawn, "labelled")
    rows = docs.join(F.broadcast(sample), "doc_id").select("u", "label", "text")
    ready = rows.mapInArrow(_features(bits), "u bigint, label int, features array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xs, ys = [], []
        for batch in batches:
            column = batch.column("features")
            flat, first = np.asarray(column.values), np.asarray(column.offsets)
            xs += [flat[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
            ys.append(np.asarray(batch.column("label")))
        if xs:
            yield pa.RecordBatch.from_arrays([pa.array([train(xs, np.concatenate(ys))], pa.binary())], names=["model"])

    model = ready.repartition(1).sortWithinPartitions("u", "label").mapInArrow(run, "model binary").first()
    return None if model is None else bytes(model["model"])
