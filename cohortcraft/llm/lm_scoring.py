"""LM scoring: corpus counts and a causal self-attention model over subword ids.

``fit`` learns from the training rows: word counts, subword counts, neighbour
classes and attention weights, each over all of them. The attention model is
trained in rounds that share out the texts by a hash: every partition of a
round's texts runs its own pass from the same parameters and the results are
averaged by number of symbols, summed on the executors. ``scored`` gives each whole text its base score (smoothed
word unigrams) and the model's log10 probability.

Word counts are joined, not broadcast: only the words that occur most, at most
``HEAD`` of them, go to every task; other occurrences meet their counts in a
join on the word.

Defined cases: null or empty text: one token, the end. Without training rows
all counts are 0 and the model is the initial one. Repeated rows get equal
scores; a null id counts as a training row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortcraft.llm import attention_lm as A
from cohortcraft.llm import kernels as K
from cohortcraft.llm.storage import written
from cohortcraft.llm.subwords import encoder

HEAD = 1 << 18
ROUNDS, STEP = 2, 0.25
TRAINER_IDS = 4 << 20
"""Subword ids that one training pass takes, about."""

PROFILE_IDS = 1 << 20
"""Subword ids whose neighbours are summed at a time."""

SLICE = 2 << 20
_PIECE = 1 << 15  # parameters in one row of a training result


# --- word counts ------------------------------------------------------------


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text) -> (word, n), summed per batch."""
    for batch in batches:
        data, offsets = K.buffer(batch.column("text"))
        words, counts = np.zeros(0, K.U64), np.zeros(0, np.int64)
        for i, j in K.slices(offsets, SLICE):
            chunk = K.lower(data[offsets[i] : offsets[j]])
            start, end, _ = K.words(chunk, offsets[i : j + 1] - offsets[i])
            own, n = np.unique(K.word_hashes(chunk, start, end), return_counts=True)
            words, at = np.unique(np.concatenate([words, own]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n]), len(words)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], names=["word", "n"])


@dataclass(frozen=True)
class WordCounts:
    table: DataFrame  # (word, c) of all training words
    tokens: int  # N, the ends included
    distinct: int  # V, the end included
    ends: int
    floor: int  # words with c >= floor are the head
    head: tuple[np.ndarray, np.ndarray]  # sorted words and their counts


def count_words(training: DataFrame) -> WordCounts:
    """Counts over all training rows (column ``text``)."""
    table = written(training.select("text").mapInArrow(_count_words, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("c")), "word-counts")
    ends = training.count()
    sizes = table.groupBy(F.floor(F.log2("c")).cast("int").alias("p")).agg(F.count("*").alias("n"), F.sum("c").alias("c")).collect()  # 63 rows at most
    floor, room = 0, HEAD
    for r in sorted(sizes, key=lambda r: -r["p"]):
        room -= r["n"]
        if room < 0:
            floor = 1 << (r["p"] + 1)
            break
    rows = table.where(F.col("c") >= floor).toArrow()  # at most HEAD words
    words, counts = rows["word"].to_numpy().view(K.U64), rows["c"].to_numpy()
    order = np.argsort(words)
    return WordCounts(
        table, sum(r["c"] for r in sizes) + ends, sum(r["n"] for r in sizes) + (ends > 0), ends, floor, (words[order], counts[order])
    )


# --- subword ids and model ----------------------------------------------------


_TOP = 20
"""Leading bits of a hash that tell where to look for it."""


def _bounds(words: np.ndarray) -> np.ndarray:
    """Where the words of each value of the leading bits begin in ``words``, which are sorted."""
    return np.searchsorted(words >> K.U64(64 - _TOP), np.arange((1 << _TOP) + 1, dtype=K.U64)).astype(np.int32)


def _places(words: np.ndarray, bounds: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of each hash in ``words``; any place for a hash that is not there."""
    top = (hashes >> K.U64(64 - _TOP)).astype(np.int64)
    at = np.minimum(bounds[top], len(words) - 1)
    several = np.flatnonzero((words[at] != hashes) & (bounds[top + 1] - at > 1))
    at[several] = np.minimum(np.searchsorted(words, hashes[several]), len(words) - 1)
    return at


def _read(path: str, dtype: str, shared_head):
    """Rows (key, id, held_out, text) -> token counts, logs of frequent words, other words and subword ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, (words, counts) = encoder(path), shared_head.value
        logs, bounds = np.log10(counts + 1.0), _bounds(words)
        for batch in batches:
            data, offsets = K.buffer(batch.column("text"))
            for i, j in K.slices(offsets, SLICE):
                part = batch.slice(i, j - i)
                chunk = data[offsets[i] : offsets[j]]
                start, end, first = K.words(chunk, offsets[i : j + 1] - offsets[i])
                h = K.word_hashes(K.lower(chunk), start, end)
                known, log = np.zeros(len(h), bool), np.zeros(len(h))
                if len(words):
                    at = _places(words, bounds, h)
                    known = words[at] == h
                    log = np.where(known, logs[at], 0.0)
                sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[first])
                ids, id_first = enc.encode_words(chunk, start, end, first)
                raw, width = ids.astype(dtype).tobytes(), np.dtype(dtype).itemsize
                cells = [raw[width * a : width * b] for a, b in zip(id_first[:-1], id_first[1:], strict=True)]
                rare = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(~known)])[first].astype(np.int32)), pa.array(h[~known].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("key", "id", "held_out")),
                        pa.array(np.diff(first) + 1),
                        pa.array(sums(known).astype(np.int64)),
                        pa.array([float(log[a:b].sum()) for a, b in zip(first[:-1], first[1:], strict=True)], pa.float64()),
                        rare,
                        pa.array(cells, pa.binary()),
                    ],
                    names=["key", "id", "held_out", "n_tokens", "head_known", "head_log", "rare", "ids"],
                )

    return run


def _flat(column: pa.Array, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    rows = [np.frombuffer(x, dtype) for x in column.to_pylist()]
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    return (np.concatenate(rows) if rows else np.zeros(0, dtype)), first


@dataclass(frozen=True)
class Model:
    flat: np.ndarray
    class_of: np.ndarray
    log_in_class: np.ndarray
    end: int
    dtype: str

    @property
    def parameters(self) -> dict[str, np.ndarray]:
        return A.unpack(self.flat, self.end + 1)


def _count_ids(dtype: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column("ids"), dtype)[0], minlength=size)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], names=["i", "n"])

    return run


def _sum_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (piece, weight, values) sorted by piece -> one row per piece, values weighted and summed."""
    key, total, weight = None, None, 0.0
    names = ["piece", "weight", "values"]
    row = lambda: pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([weight]), pa.array([total.astype("<f8").tobytes()], pa.binary())], names=names)
    for batch in batches:
        for piece, w, values in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if piece != key:
                if key is not None:
                    yield row()
                key, total, weight = piece, 0.0, 0.0
            total = total + np.frombuffer(values, "<f8")
            weight += w
    if key is not None:
        yield row()


def _trainer(shared, step: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = []
        m: Model = shared.value
        for batch in batches:
            texts += [np.frombuffer(x, m.dtype) for x in batch.column("ids").to_pylist()]
        if not texts:
            return
        p, _ = A.train(m.parameters, texts, m.end, m.class_of, step)
        flat, weight = A.pack(p).astype(np.float64), float(sum(len(t) + 1 for t in texts))
        pieces = range(0, len(flat), _PIECE)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k // _PIECE for k in pieces], pa.int32()),
                pa.array([weight] * len(pieces)),
                pa.array([(weight * flat[k : k + _PIECE]).astype("<f8").tobytes() for k in pieces], pa.binary()),
            ],
            names=["piece", "weight", "values"],
        )

    return run


def _count_neighbours(dtype: str, size: int):
    """Rows (ids) -> (i, p0 ..): neighbour profiles of the ids that occur, one table of fixed size per task."""
    names = [f"p{k}" for k in range(A.PROFILE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        project, total = A.projection(size), np.zeros((size, A.PROFILE))
        held, waiting = [], 0
        for batch in batches:
            for cell in batch.column("ids").to_pylist():
                held.append(np.frombuffer(cell, dtype))
                waiting += len(held[-1]) + 1
                if waiting >= PROFILE_IDS:
                    A.add_neighbours(total, held, project)
                    held, waiting = [], 0
        A.add_neighbours(total, held, project)
        own = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(own), *(pa.array(column) for column in total[own].T.copy())], names=["i", *names])

    return run


def _profiles(encoded: DataFrame, counts: np.ndarray, dtype: str) -> np.ndarray:
    """(ids, PROFILE) sums over the neighbours of every occurrence in ``encoded``; only this table reaches the driver."""
    names = [f"p{k}" for k in range(A.PROFILE)]
    tasks = max(1, -(-int(counts.sum()) // (4 * TRAINER_IDS)))  # few, as each may return a row for every id
    rows = encoded.select("ids").coalesce(tasks).mapInArrow(_count_neighbours(dtype, len(counts)), ", ".join(["i bigint", *(f"{c} double" for c in names)]))
    sums = rows.groupBy("i").agg(*(F.sum(c).alias(c) for c in names)).toArrow()
    out = np.zeros((len(counts), A.PROFILE))
    at = sums["i"].to_numpy()
    for k, c in enumerate(names):
        out[at, k] = sums[c].to_numpy()
    return out


def fit_model(encoded: DataFrame, vocabulary: int, dtype: str) -> Model:
    """encoded (key, ids) of the training rows."""
    context = encoded.sparkSession.sparkContext
    end = vocabulary
    counts = np.zeros(end + 1, np.int64)
    sums = encoded.select("ids").mapInArrow(_count_ids(dtype, end), "i bigint, n bigint").groupBy("i").agg(F.sum("n").alias("n"))
    for r in sums.collect():  # one row per subword id
        counts[r["i"]] = r["n"]
    counts[end] = encoded.count()
    class_of = A.neighbour_classes(_profiles(encoded, counts, dtype), counts)
    model = Model(A.pack(A.initial(end + 1)), class_of, A.in_class_logs(counts, class_of), end, dtype)
    trainers = max(1, -(-int(counts.sum()) // (ROUNDS * TRAINER_IDS)))
    turn = F.pmod(F.shiftright("key", 32), F.lit(ROUNDS))
    for k in range(ROUNDS):
        shared = context.broadcast(model)
        texts = encoded.where(turn == k).repartition(trainers).sortWithinPartitions("key")
        rows = texts.mapInArrow(_trainer(shared, STEP), "piece int, weight double, values binary")
        partial = written(rows, "trained")
        kind = "piece int, weight double, values binary"
        near = partial.repartition("piece", F.pmod(F.col("weight").cast("bigint"), F.lit(16))).sortWithinPartitions("piece").mapInArrow(_sum_pieces, kind)
        partial = near.repartition("piece").sortWithinPartitions("piece").mapInArrow(_sum_pieces, kind)
        pieces = sorted(partial.collect(), key=lambda r: r["piece"])  # the parameters once
        if pieces:
            flat = np.concatenate([np.frombuffer(bytes(r["values"]), "<f8") / r["weight"] for r in pieces])
            model = Model(flat.astype(np.float32), class_of, model.log_in_class, end, dtype)
    return model


# --- scores -------------------------------------------------------------------


def _score(shared_model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared_model.value
        p = m.parameters
        for batch in batches:
            rest = [c for c in batch.schema.names if c != "ids"]
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                ids, first = _flat(part.column("ids"), m.dtype)
                score = A.score(p, ids, first, m.end, m.class_of, m.log_in_class) / np.log(10)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), pa.array(score)], names=[*rest, "score"])

    return run


def scored(docs: DataFrame, held_out: Column, tokenizer: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; learns from rows not held out."""
    context = docs.sparkSession.sparkContext
    vocabulary = encoder(tokenizer).size
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"
    plain = docs.select(
        F.xxhash64(F.col(id_col).cast("string"), F.lit("lm")).alias("key"), F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).alias("text")
    )
    kind = plain.schema["id"].dataType.simpleString()
    words = count_words(plain.where("NOT held_out"))
    counted = f"key bigint, id {kind}, held_out boolean, n_tokens bigint, head_known bigint, head_log double"
    read = plain.mapInArrow(_read(tokenizer, dtype, context.broadcast(words.head)), f"{counted}, rare array<bigint>, ids binary")
    rows = written(read.withColumn("row", F.monotonically_increasing_id()), "subword-ids")
    model = fit_model(rows.where("NOT held_out").select("key", "ids"), vocabulary, dtype)
    rare = rows.select("row", F.explode("rare").alias("word")).join(words.table.where(F.col("c") < words.floor), "word")
    sums = rare.groupBy("row").agg(F.count("*").alias("rare_known"), F.sum(F.log10(F.col("c") + 1)).alias("rare_log"))
    out = rows.drop("rare", "key").mapInArrow(
        _score(context.broadcast(model)), f"id {kind}, held_out boolean, n_tokens bigint, head_known bigint, head_log double, row bigint, score double"
    )
    n, v, ends = float(words.tokens), float(words.distinct), float(words.ends)
    known = F.col("head_known") + F.coalesce("rare_known", F.lit(0)) + (1 if ends else 0)
    logs = F.col("head_log") + F.coalesce("rare_log", F.lit(0.0)) + F.log10(F.lit(ends + 1))
    return out.join(sums, "row", "left").select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        known.cast("bigint").alias("n_known"),
        F.lit(words.tokens).cast("bigint").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.log10(F.lit(n + v + 1))).alias("base_score"),
        "score",
    )
