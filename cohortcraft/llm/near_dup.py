"""MinHash near-dedup of documents on sets of five-word shingles.

``near_duplicates(docs)`` adds ``n_shingles``, ``component_id`` and ``kept`` per
document. Words are white-space words of the text with A-Z lower-cased; two
documents are linked when ``100 * |A & B| >= percent * |A | B|`` on their full
sets; a component is everything reachable over links and keeps its smallest id.

Defined cases: a null or empty text has an empty set, is linked with nothing
and kept. Fewer words than a shingle: the whole sequence is the one shingle.
Rows without an id are never linked and not kept (component_id null). Rows that
repeat an id are one document: each is returned, with one component. Copies
are collapsed before any pair is looked at, so a copy group may hold any share
of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortcraft.llm import minhash as M
from cohortcraft.llm.storage import written

BANDING = M.tune(0.85, 5e-6, rows=8)
"""39 bands of 8: misses a pair at similarity 0.85 with 5e-6, meets one at 0.5 with 0.14."""


def _sketch(k: int, banding: M.Banding):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            for i, j, values, first in M.text_shingles(batch.column("text"), k):
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), *M.sketch_columns(values, first, banding)], names=["id", "n_shingles", "digest", "bands"])

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = [batch.column(c) for c in ("node", "grp", "blocks")]
            for i, j, values, first in M.text_shingles(batch.column("text"), k):
                raw = values.tobytes()
                sets = pa.array([raw[8 * a : 8 * b] for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in rest), sets], names=["node", "grp", "blocks", "shingles"])

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 85, k: int = 5, banding: M.Banding = BANDING) -> DataFrame:
    """(id_col, n_shingles, component_id, kept) for every row of ``docs``."""
    plain = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("text"))
    base = written(plain.mapInArrow(_sketch(k, banding), "id bigint, n_shingles bigint, digest binary, bands array<bigint>"), "sketches")

    def fetch(groups: DataFrame) -> DataFrame:
        texts = plain.join(groups, plain["id"] == groups["node"]).select("node", "grp", "blocks", "text")
        return texts.mapInArrow(_sets(k), "node bigint, grp bigint, blocks int, shingles binary").where("length(shingles) > 0")

    found = M.linked(base, fetch, percent)
    without = base.where("id IS NULL").select("id", "n_shingles", F.lit(None).cast("bigint").alias("component"))
    rows = found.select("id", "n_shingles", F.coalesce("component", "id").alias("component")).unionByName(without)
    return rows.select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 85, k: int = 5, banding: M.Banding = BANDING) -> DataFrame:
    """The rows of ``docs``, all columns, of which one document of each component is left.

    Rows that repeat a kept id and its text are one document: one of them stays;
    an id's different texts stay each. Rows without an id cannot be told apart
    from others and stay.
    """
    marked = written(near_duplicates(docs, id_col, text, percent, k, banding), "near-duplicates")
    dropped = marked.where(F.col(id_col).isNotNull() & ~F.col("kept")).select(id_col).distinct()
    # dealt by id at every size (no switch between join forms); the ids are hashed, texts are not sorted
    left = docs.join(dropped.hint("shuffle_hash"), id_col, "left_anti").select(*docs.columns)
    again = written(marked.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").select(id_col), "repeated-ids")
    if again.isEmpty():  # the rule for ids, and so nothing to do
        return left
    once, repeated = left.join(again, id_col, "left_anti"), left.join(again, id_col, "left_semi")
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    distinct = repeated.withColumn("_digest", digest).dropDuplicates([id_col, "_digest"]).select(*docs.columns)
    return once.select(*docs.columns).unionByName(distinct)
