"""Ranked lexical search: inverted shards with block maxima, searched by Block-Max MaxScore.

``build`` writes shards of whole documents (about ``SHARD_BYTES`` of text each)
as rows of a table. A shard holds, per term, a posting list cut into blocks of
``BLOCK`` postings: packed document gaps and counts, and per block its skyline,
the (count, length) pairs that no other pair of the block beats. The best
contribution of a block under any collection statistics lies on its skyline, so
shards never change when documents are added.

``search`` takes the query set in blocks of about ``BLOCK_TERMS`` terms, one at
a time. In a shard, lists are ordered by their bounds; those whose bounds
together stay below the tenth best score so far are non-essential. Candidates
come from the essential lists alone. On the non-essential lists, strongest
first, the bound of the one block that could hold a candidate decides whether it
is dropped, and only blocks that still matter are unpacked. A task keeps its
best documents over all its shards; the heaps of all tasks are merged per item.

A shard is one row of several MB, so it is stored in a row group of its own and
handed to Python by itself (``ONE_BY_ONE``): an executor holds one shard per
task, whatever the number of shards in a file.

Scores are the integers of the contract of ``op13``: per query term
``w * ((10^9 * tf) div (1000 * tf + 8 * m))`` with ``m = 10 + (90 * n * N) div L``
and ``w = floor(1000 * ln((2N + 2) / (2df + 1)))``.

Terms are compared as bytes; hashes only find them. Null and empty texts have
no terms and count in nothing. Rows that share a document id are documents of
their own; query rows that share an id are one item with the terms of all.
Equal scores go by ascending id, a null id last. Ids of documents are integers.
Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from cohortcraft.llm import kernels as K
from cohortcraft.llm.storage import settings, written
from cohortcraft.llm.workers import ship_package

SHARD_BYTES = 8 << 20
BLOCK = 64
BLOCK_TERMS = 100_000
"""Query terms (counted per item) that a task holds at a time."""
WINDOW = 4096
"""Documents of a shard whose scores are added up at a time."""
ALONE = {"parquet.block.row.count.limit": "1", "parquet.enable.dictionary": "false"}
"""Options of the writer of shards: a reader decodes a row group at a time; no value of a shard occurs twice."""
ONE_BY_ONE = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1"}
"""Settings under which shards are read."""
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(SHARD_BYTES // 2)}
"""Settings under which texts are read: what is handed to Python at a time."""

# name -> numpy type of the packed arrays of a shard
_ARRAYS = {
    "ids": "<i8",  # per document
    "id_null": "u1",
    "lengths": "<u4",
    "hashes": "<u8",  # per term, ascending
    "term_at": "<i8",  # per term, and the end: its bytes
    "term_bytes": "u1",
    "df": "<u4",
    "gap_width": "u1",
    "tf_width": "u1",
    "list_at": "<i8",  # per term: its postings' bytes
    "block_at": "<i8",  # per term, and the end: its blocks
    "first": "<u4",  # per block
    "last": "<u4",
    "sky_at": "<i8",  # per block, and the end: its skyline
    "sky_tf": "<u4",
    "sky_n": "<u4",
    "payload": "u1",
}
SHARD_SCHEMA = T.StructType(
    [T.StructField("documents", T.LongType()), T.StructField("total", T.LongType())]
    + [T.StructField(name, T.BinaryType()) for name in _ARRAYS]
)


def _groups(data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, opens): words sorted by hash with equal words together, in their own order; where a term begins."""
    order = np.argsort(hashes, kind="stable").astype(start.dtype)
    ordered = hashes[order]
    opens = np.ones(len(order), bool)
    opens[1:] = ordered[1:] != ordered[:-1]
    del ordered
    head = order[np.flatnonzero(opens)][np.cumsum(opens, dtype=start.dtype) - 1]  # the first word of each word's hash
    length = end - start
    differs = length[order] != length[head]
    if not differs.any():
        step = 1 << 16
        for a in range(0, len(order), step):
            part, size = slice(a, a + step), length[order[a : a + step]]
            inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            same = data[np.repeat(start[order[part]], size) + inner] == data[np.repeat(start[head[part]], size) + inner]
            if not same.all():
                differs[part] |= True
                break
    if differs.any():  # two words share a hash: number the words themselves
        raw, numbers = data.tobytes(), {}
        words = zip(start.tolist(), end.tolist(), strict=True)
        number = np.fromiter((numbers.setdefault(raw[a:b], len(numbers)) for a, b in words), np.int64, len(start))
        order = np.lexsort((np.arange(len(start)), number, hashes)).astype(start.dtype)
        opens[1:] = number[order][1:] != number[order][:-1]
    return order, opens


def _widths(largest: np.ndarray) -> np.ndarray:
    return np.where(largest < 1 << 8, 1, np.where(largest < 1 << 16, 2, 4)).astype(np.uint8)


def _pack(out: np.ndarray, at: np.ndarray, values: np.ndarray, width: np.ndarray) -> None:
    """Little-endian ``values`` of ``width`` bytes each at byte positions ``at``."""
    for byte in range(4):
        wide = width > byte
        out[at[wide] + byte] = (values[wide] >> (8 * byte)) & 255


def _shard(texts: pa.Array, ids: pa.Array) -> dict:
    """One shard's row from texts and their integer ids."""
    data, offsets = K.buffer(texts)
    data = K.lower(data)
    start, end, first = K.words(data, offsets, K.ALNUM_BREAK)
    lengths = np.diff(first)
    kind = np.int32 if len(data) < 1 << 31 else np.int64  # of what there is one of per word
    start, end = start.astype(kind), end.astype(kind)
    document = np.repeat(np.arange(len(lengths), dtype=kind), lengths)
    hashes = K.word_hashes(data, start, end)
    order, opens = _groups(data, start, end, hashes)
    term = np.cumsum(opens, dtype=kind) - 1
    doc = document[order]
    new = opens.copy()
    new[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(new)  # one posting per (term, document)
    tf = np.diff(np.append(at, len(order))).astype(kind)
    doc, term = doc[at], term[at]
    heads = order[np.flatnonzero(opens)]
    start, end, hashes = start[heads], end[heads], hashes[heads]  # from here on of terms
    del document, order, opens, new, at, heads  # as long as the words
    n_terms = len(start)
    df = np.bincount(term, minlength=n_terms)
    list_first = np.cumsum(df) - df
    within = np.arange(len(term)) - np.repeat(list_first, df)
    starts = within % BLOCK == 0
    block = np.cumsum(starts) - 1
    block_first = np.flatnonzero(starts)
    gap = doc - doc[block_first][block] if len(doc) else doc
    gap_width, tf_width = (
        _widths(np.maximum.reduceat(x, list_first)) if n_terms else np.zeros(0, np.uint8) for x in (gap, tf)
    )
    size = df * (gap_width.astype(np.int64) + tf_width)
    list_at = np.cumsum(size) - size
    payload = np.zeros(int(size.sum()), np.uint8)
    wide_gap, wide_tf = gap_width[term].astype(np.int64), tf_width[term].astype(np.int64)
    _pack(payload, list_at[term] + within * wide_gap, gap, wide_gap)
    _pack(payload, list_at[term] + df[term] * wide_gap + within * wide_tf, tf, wide_tf)
    # skyline: by length, then from the highest count down, keep what exceeds every count before it
    n = lengths[doc]
    sky = np.lexsort((-tf, n, block))
    peak = np.maximum.accumulate((block[sky] << 32) + tf[sky]) if len(sky) else sky
    keep = np.ones(len(sky), bool)
    keep[1:] = peak[1:] > peak[:-1]
    sky = sky[keep]
    block_last = np.append(block_first[1:], len(term))[: len(block_first)] - 1
    word_size = end - start
    inner = np.arange(int(word_size.sum())) - np.repeat(np.cumsum(word_size) - word_size, word_size)
    arrays = {
        "ids": pa.compute.fill_null(ids.cast(pa.int64()), 0).to_numpy(zero_copy_only=False),
        "id_null": pa.compute.is_null(ids).to_numpy(zero_copy_only=False),
        "lengths": lengths,
        "hashes": hashes,
        "term_at": np.append(0, np.cumsum(word_size)),
        "term_bytes": data[np.repeat(start, word_size) + inner],
        "df": df,
        "gap_width": gap_width,
        "tf_width": tf_width,
        "list_at": list_at,
        "block_at": np.append(0, np.cumsum(-(-df // BLOCK))),
        "first": doc[block_first],
        "last": doc[block_last],
        "sky_at": np.append(0, np.cumsum(np.bincount(block[sky], minlength=len(block_first)))),
        "sky_tf": tf[sky],
        "sky_n": n[sky],
        "payload": payload,
    }
    row = {name: arrays[name].astype(kind).tobytes() for name, kind in _ARRAYS.items()}
    return {"documents": int((lengths > 0).sum()), "total": int(lengths.sum()), **row}


def _concat(parts: list[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays([p.cast(kind) for p in parts])


def build(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Shards of all rows of ``docs``, written to the shared folder and read back."""
    ship_package(docs.sparkSession)
    source = docs.select(docs[doc_id].cast("bigint").alias("id"), docs[text].alias("text"))
    schema = pa.schema([("documents", pa.int64()), ("total", pa.int64()), *((n, pa.binary()) for n in _ARRAYS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, ids, held = [], [], 0

        def emit() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_shard(_concat(texts, pa.large_string()), _concat(ids, pa.int64()))], schema)

        for batch in batches:
            offsets = K.buffer(batch.column(1))[1]
            for a, b in K.slices(offsets, SHARD_BYTES // 2):
                size = int(offsets[b] - offsets[a])
                if texts and held + size > SHARD_BYTES:
                    yield emit()
                    texts, ids, held = [], [], 0
                texts.append(batch.column(1).slice(a, b - a))
                ids.append(batch.column(0).slice(a, b - a))
                held += size
        if texts:
            yield emit()

    with settings(docs.sparkSession, BATCHES):
        return written(source.mapInArrow(run, SHARD_SCHEMA), "search-shards", ALONE)


class Shard:
    """A shard's arrays, with the bounds that were already worked out."""

    def __init__(self, row: dict) -> None:
        for name, kind in _ARRAYS.items():
            setattr(self, name, np.frombuffer(row[name], kind))
        self.known: dict[int, tuple] = {}

    def find(self, hashes: np.ndarray, words: list[bytes]) -> np.ndarray:
        """Index of each word among the shard's terms; -1 where it is none."""
        out = np.full(len(words), -1, np.int64)
        at = np.searchsorted(self.hashes, hashes)
        near = np.flatnonzero(at < len(self.hashes))
        near = near[self.hashes[at[near]] == hashes[near]]
        raw = self.term_bytes
        for i in near.tolist():
            k = int(at[i])
            while k < len(self.hashes) and self.hashes[k] == hashes[i]:
                if raw[self.term_at[k] : self.term_at[k + 1]].tobytes() == words[i]:
                    out[i] = k
                    break
                k += 1
        return out

    def lists(self, term: int, impact) -> tuple:
        """(first, last, bound of each block, bound of the list), bounds without the term's weight."""
        found = self.known.get(term)
        if found is None:
            a, b = int(self.block_at[term]), int(self.block_at[term + 1])
            s, e = int(self.sky_at[a]), int(self.sky_at[b])
            best = np.maximum.reduceat(impact(self.sky_tf[s:e].astype(np.int64), self.sky_n[s:e]), self.sky_at[a:b] - s)
            found = self.known[term] = (self.first[a:b].astype(np.int64), self.last[a:b].astype(np.int64), best, int(best.max()))
        return found

    def blocks(self, term: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, counts) of a term's blocks a..b-1."""
        df, wide, narrow = int(self.df[term]), int(self.gap_width[term]), int(self.tf_width[term])
        lo, hi = a * BLOCK, min(df, b * BLOCK)
        at = int(self.list_at[term])
        gap = np.frombuffer(self.payload, f"<u{wide}", hi - lo, at + lo * wide)
        tf = np.frombuffer(self.payload, f"<u{narrow}", hi - lo, at + df * wide + lo * narrow)
        begin = self.first[self.block_at[term] + a : self.block_at[term] + b].astype(np.int64)
        return np.repeat(begin, BLOCK)[: hi - lo] + gap, tf.astype(np.int64)


class Best:
    """The k best (score, id) of an item."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.score, self.id, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """A document below this score cannot enter."""
        return max(1, int(self.score[-1])) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        score, ids, null = (np.concatenate(p) for p in ((self.score, score), (self.id, ids), (self.null, null)))
        order = np.lexsort((ids, null, -score))[: self.k]
        self.score, self.id, self.null = score[order], ids[order], null[order]


def search_shard(shard: Shard, terms: list[tuple[int, int]], impact, best: Best) -> None:
    """Add a shard's best documents for one item to ``best``.

    ``terms`` holds (index in the shard, weight); ``impact(tf, n)`` is a
    posting's contribution before the weight.
    """
    lists = sorted(((shard.lists(t, impact), t, w) for t, w in terms), key=lambda x: x[0][3] * x[2])
    bound = [x[0][3] * x[2] for x in lists]
    below = [0]  # what all weaker lists can add
    for b in bound:
        below.append(below[-1] + b)
    n_docs = len(shard.lengths)
    for low in range(0, n_docs, WINDOW):
        high = min(n_docs, low + WINDOW)
        essential = next((i for i in range(len(lists)) if below[i + 1] >= best.least), len(lists))
        if essential == len(lists):
            return  # no document of this shard can enter
        score = np.zeros(high - low, np.int64)
        seen = np.zeros(high - low, bool)
        for (first, last, _, _), t, w in lists[essential:]:
            a, b = int(np.searchsorted(last, low)), int(np.searchsorted(first, high))
            if a < b:
                doc, tf = shard.blocks(t, a, b)
                if first[a] < low or last[b - 1] >= high:
                    inside = (doc >= low) & (doc < high)
                    doc, tf = doc[inside], tf[inside]
                score[doc - low] += w * impact(tf, shard.lengths[doc])
                seen[doc - low] = True
        cand = np.flatnonzero(seen)
        have, cand = score[cand], cand + low
        for i in range(essential - 1, -1, -1):
            (first, last, block_best, _), t, w = lists[i]
            if not len(cand):
                break
            at = np.searchsorted(last, cand)
            inside = at < len(last)
            at[~inside] = 0
            inside &= first[at] <= cand
            stays = have + np.where(inside, block_best[at] * w, 0) + below[i] >= best.least
            cand, have, at, inside = cand[stays], have[stays], at[stays], inside[stays]
            for b in np.unique(at[inside]).tolist():
                doc, tf = shard.blocks(t, b, b + 1)
                asked = np.flatnonzero(inside & (at == b))
                k = np.minimum(np.searchsorted(doc, cand[asked]), len(doc) - 1)
                hit = doc[k] == cand[asked]
                asked, k = asked[hit], k[hit]
                have[asked] += w * impact(tf[k], shard.lengths[cand[asked]])
        enters = have >= best.least
        cand, have = cand[enters], have[enters]
        if len(cand):
            best.add(have, shard.ids[cand], shard.id_null[cand].astype(bool))


def impacts(n_docs: int, total: int):
    """``impact(tf, n)`` for a collection of ``n_docs`` documents with ``total`` terms."""

    def impact(tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 10 + (90 * n.astype(np.int64) * n_docs) // total
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)

    return impact


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, term, block): the distinct terms of every item, dealt into blocks of about ``BLOCK_TERMS``."""
    ship_package(items.sparkSession)
    source = items.select(items[item_id].alias("item_id"), items[text].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = K.buffer(batch.column(1))
            data = K.lower(data)
            start, end, first = K.words(data, offsets, K.ALNUM_BREAK)
            raw = data.tobytes()
            for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
                words = list({raw[x:y] for x, y in zip(start[a:b].tolist(), end[a:b].tolist(), strict=True)})
                if words:
                    ids = pa.concat_arrays([batch.column(0).slice(i, 1)] * len(words))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(words, pa.binary())], names=["item_id", "term"])

    schema = T.StructType([source.schema["item_id"], T.StructField("term", T.BinaryType())])
    pairs = written(source.mapInArrow(run, schema).distinct(), "search-terms")
    blocks = max(1, -(-pairs.count() // BLOCK_TERMS))
    return pairs.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))


def _document_counts(shards: DataFrame, terms, hashes) -> dict[int, int]:
    """How many documents hold each of a block's terms (one number per term reaches the driver)."""
    spark = shards.sparkSession
    sent = spark.sparkContext.broadcast((hashes, terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, terms = sent.value
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard({**dict.fromkeys(_ARRAYS, b""), **row})
                at = shard.find(hashes, terms)
                total[at >= 0] += shard.df[at[at >= 0]]
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["term", "df"])

    counts = shards.select("hashes", "term_at", "term_bytes", "df").mapInArrow(run, "term long, df long")
    with settings(spark, ONE_BY_ONE):
        found = {r["term"]: r["df"] for r in counts.groupBy("term").agg(F.sum("df").alias("df")).collect()}
    sent.destroy()
    return found


def _search_block(shards: DataFrame, pairs: DataFrame, n_docs: int, total: int, k: int) -> DataFrame:
    """Best documents of one block of items, from every task's heap; written, so the block can be released."""
    spark = shards.sparkSession
    id_field = pairs.schema["item_id"]
    rows = pairs.select("item_id", "term").collect()  # one bounded block
    words = sorted({bytes(r["term"]) for r in rows})
    number = {w: i for i, w in enumerate(words)}
    flat = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    hashes = K.word_hashes(flat, ends - np.array([len(w) for w in words]), ends)
    df = _document_counts(shards, words, hashes)
    items: dict = {}
    for r in rows:
        t = number[bytes(r["term"])]
        if t in df:
            items.setdefault(r["item_id"], []).append((t, weight(n_docs, df[t])))
    sent = spark.sparkContext.broadcast((hashes, words, items))
    arrow_id = to_arrow_type(id_field.dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, words, items = sent.value
        impact = impacts(n_docs, total)
        heaps = {i: Best(k) for i in items}
        for batch in batches:
            for n in range(batch.num_rows):
                shard = Shard(batch.slice(n, 1).to_pylist()[0])
                at = shard.find(hashes, words)
                for i, terms in items.items():
                    here = [(int(at[t]), w) for t, w in terms if at[t] >= 0 and w > 0]
                    if here:
                        search_shard(shard, here, impact, heaps[i])
        out = [(i, h) for i, h in heaps.items() if len(h.score)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, h in out for _ in h.score], arrow_id),
                pa.array(np.concatenate([h.id for _, h in out]) if out else [], pa.int64(),
                         mask=np.concatenate([h.null for _, h in out]) if out else None),
                pa.array(np.concatenate([h.score for _, h in out]) if out else [], pa.int64()),
            ],
            names=["item_id", "doc_id", "score"],
        )

    schema = T.StructType([id_field, T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    with settings(spark, ONE_BY_ONE):
        heaps = written(shards.mapInArrow(run, schema), "search-heaps")
    sent.destroy()
    return heaps


def search(shards: DataFrame, items: DataFrame, k: int = 10, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item with a score above 0."""
    pairs = item_terms(items, item_id, text)
    size = shards.agg(F.coalesce(F.sum("documents"), F.lit(0)).alias("n"), F.coalesce(F.sum("total"), F.lit(0)).alias("l")).first()
    heaps = None
    blocks = pairs.agg(F.max("block")).first()[0]
    for block in range(0 if blocks is None or not size["l"] else blocks + 1):
        found = _search_block(shards, pairs.where(F.col("block") == block), size["n"], size["l"], k)
        heaps = found if heaps is None else heaps.unionByName(found)
    if heaps is None:
        schema = T.StructType([pairs.schema["item_id"], *T._parse_datatype_string("doc_id long, score long").fields])
        heaps = shards.sparkSession.createDataFrame([], schema)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return heaps.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
