"""Benchmark decontamination: an FM-index per training shard.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased.
A test phrase is ``window`` consecutive words of a benchmark item (an item of
fewer words, but not none, is one phrase). Each task cuts its rows into shards
of about ``SHARD`` bytes (whole documents), builds an FM-index over the shard's
words, searches every phrase backwards, locates the occurrences and merges them
into removal spans.

The index alphabet is the benchmark's vocabulary: a word that no item has ends
a run, and runs too short for any phrase cannot hold one, so leaving them out of
the index loses nothing.

Phrases are built by tasks over the benchmark, in blocks of about ``BLOCK`` bytes
of item text, and written to the shared folder. A pass over the documents
searches at most ``HELD`` blocks, which are all that the driver or a worker holds
at a time; a larger benchmark takes several passes, each of which hands on what
the passes before it found.

Defined cases: null or empty text: no words, no hits. Null item text: no
phrases. Items without an id are searched under the empty id; items that
repeat an id count once. Rows are judged alone, repeated rows alike. An empty
benchmark marks nothing.
"""

from __future__ import annotations

import pickle
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortcraft.llm import kernels as K
from cohortcraft.llm.fm_index import FMIndex
from cohortcraft.llm.storage import written
from cohortcraft.llm.workers import ship_package

SHARD = 8 << 20
BLOCK = 4 << 20
HELD = 8
"""Blocks of phrases that one pass searches."""


class Phrases:
    """Distinct phrases of some items, as rows of codes into ``vocabulary``, grouped by length."""

    def __init__(self, item_ids: list[str], texts: list[str | None], window: int) -> None:
        data, offsets = K.buffer(pa.array(texts, pa.string()))
        data = K.lower(data)
        start, end, first = K.words(data, offsets, K.ALNUM_BREAK)
        hashes = K.word_hashes(data, start, end)
        self.window = window
        self.vocabulary, codes = np.unique(hashes, return_inverse=True)
        codes = codes + 1
        by_length: dict[int, list[tuple[np.ndarray, int]]] = defaultdict(list)
        for item, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
            if b > a:
                m = min(window, b - a)
                by_length[m].append((np.lib.stride_tricks.sliding_window_view(codes[a:b], m), item))
        self.groups = []
        for m, parts in sorted(by_length.items()):
            rows = np.concatenate([p for p, _ in parts])
            owners = np.repeat([i for _, i in parts], [len(p) for p, _ in parts])
            distinct, which = np.unique(rows, axis=0, return_inverse=True)
            pairs = np.unique(np.stack([which.reshape(-1), owners], 1), axis=0)
            owner_first = np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1))
            self.groups.append((distinct.astype(np.int64), pairs[:, 1], owner_first))
        self.item_ids = item_ids
        short = [d for d, _, _ in self.groups if d.shape[1] < window]
        self.short_codes = np.unique(np.concatenate([d.reshape(-1) for d in short])) if short else np.zeros(0, np.int64)
        self.shortest = min((d.shape[1] for d, _, _ in self.groups), default=window)

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """Code of each word, 0 for a word that no item has."""
        if len(self.vocabulary) == 0:
            return np.zeros(len(hashes), np.int64)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def _runs(codes: np.ndarray, first: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(codes of the runs that can hold a phrase, each ended by 0; word position of each code)."""
    known = codes > 0
    opens, closes = known.copy(), known.copy()
    cut = np.zeros(len(codes) + 1, bool)
    cut[first] = True
    opens[1:] &= ~known[:-1] | cut[1:-1]
    closes[:-1] &= ~known[1:] | cut[1:-1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    keep = end - start >= phrases.window
    if len(phrases.short_codes):
        may = np.isin(codes, phrases.short_codes)
        has_short = np.concatenate([[0], np.cumsum(may)])
        keep |= (end - start >= phrases.shortest) & (has_short[end] > has_short[start])
    start, end = start[keep], end[keep]
    sizes = end - start + 1
    begin = np.concatenate([[0], np.cumsum(sizes)])
    where = np.arange(begin[-1]) - np.repeat(begin[:-1], sizes) + np.repeat(start, sizes)
    out = np.zeros(begin[-1], np.int64)
    inside = where < np.repeat(end, sizes)
    out[inside] = codes[where[inside]]
    return out, where


def find(codes: np.ndarray, first: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(mark, pairs): change of cover per word position (+1 / -1), distinct (document, item) pairs."""
    mark = np.zeros(len(codes) + 1, np.int64)
    text, where = _runs(codes, first, phrases)
    pairs = [np.zeros((0, 2), np.int64)]
    if len(text):
        index = FMIndex(text, len(phrases.vocabulary))
        for rows, owners, owner_first in phrases.groups:
            low, high = index.search(rows)
            sizes = np.maximum(high - low, 0)
            hit = np.flatnonzero(sizes)
            if len(hit) == 0:
                continue
            sizes = sizes[hit]
            begin = np.concatenate([[0], np.cumsum(sizes)])
            places = np.arange(begin[-1]) - np.repeat(begin[:-1] - low[hit], sizes)
            at = where[index.locate(places)]
            np.add.at(mark, at, 1)
            np.add.at(mark, at + rows.shape[1], -1)
            doc = np.searchsorted(first, at, "right") - 1
            seen = np.unique(np.stack([doc, np.repeat(hit, sizes)], 1), axis=0)
            n_owners = owner_first[seen[:, 1] + 1] - owner_first[seen[:, 1]]
            o_begin = np.concatenate([[0], np.cumsum(n_owners)])
            which = np.arange(o_begin[-1]) - np.repeat(o_begin[:-1] - owner_first[seen[:, 1]], n_owners)
            pairs.append(np.stack([np.repeat(seen[:, 0], n_owners), owners[which]], 1))
    return mark, np.unique(np.concatenate(pairs), axis=0)


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_OUT = "n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:bigint,end:bigint>>"
_COVER, _FOUND = "_cover", "_found"
_PASSED = f"{_COVER} array<bigint>, {_FOUND} array<string>"


def _marker(blocks: list, text_name: str, rest: list[str], later: bool, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One pass. ``later``: rows carry what earlier passes found; ``last``: the result's columns, else what the next pass needs.

    Between passes a row carries the word ranges it has covered (start, end in
    turns) and the items it holds.
    """

    def shard(part: pa.RecordBatch) -> list[pa.Array]:
        column = part.column(text_name)
        data, offsets = K.buffer(column)
        lowered = K.lower(data)
        start, end, first = K.words(lowered, offsets, K.ALNUM_BREAK)
        hashes = K.word_hashes(lowered, start, end)
        mark = np.zeros(len(start) + 1, np.int64)
        items: list[set[str]] = [set() for _ in range(len(offsets) - 1)]
        if later:
            for d, (cover, found) in enumerate(zip(part.column(_COVER).to_pylist(), part.column(_FOUND).to_pylist(), strict=True)):
                np.add.at(mark, np.array(cover, np.int64) + first[d], np.resize([1, -1], len(cover)))
                items[d].update(found)
        for block in _phrases(blocks):
            found, pairs = find(block.codes(hashes), first, block)
            mark += found
            for d, i in pairs:
                items[d].add(block.item_ids[i])
        hit = np.cumsum(mark[:-1]) > 0
        total = np.concatenate([[0], np.cumsum(hit)])
        opens, closes = hit.copy(), hit.copy()
        cut = np.zeros(len(hit) + 1, bool)
        cut[first] = True
        opens[1:] &= ~hit[:-1] | cut[1:-1]
        closes[:-1] &= ~hit[1:] | cut[1:-1]
        a, b = np.flatnonzero(opens), np.flatnonzero(closes)
        span_first = np.searchsorted(a, first)
        doc = np.searchsorted(first, a, "right") - 1
        names = pa.array([sorted(x) for x in items], pa.list_(pa.string()))
        if not last:
            ranges = np.stack([a - first[doc], b + 1 - first[doc]], axis=1).reshape(-1)
            return [pa.ListArray.from_arrays(pa.array((2 * span_first).astype(np.int32)), pa.array(ranges, pa.int64())), names]
        if len(a):  # characters before each byte
            chars = np.zeros(len(data) + 1, np.int32 if len(data) < 1 << 31 else np.int64)
            np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
        base = chars[offsets[doc]] if len(a) else a
        spans = pa.StructArray.from_arrays(
            [pa.array((chars[start[a]] - base) if len(a) else a, pa.int64()), pa.array((chars[end[b]] - base) if len(a) else b, pa.int64())],
            names=["start", "end"],
        )
        return [
            pa.array(np.diff(first), pa.int64()),
            pa.array(np.diff(total[first]), pa.int64()),
            names,
            pa.ListArray.from_arrays(pa.array(span_first.astype(np.int32)), spans),
        ]

    added = ["n_words", "n_hit", "items", "spans"] if last else [_COVER, _FOUND]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(text_name)
            for i, j in K.slices(K.buffer(text)[1], SHARD):
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), *shard(part)], names=[*rest, *added])

    return run


_HELD: dict[str, list[Phrases]] = {}


def _phrases(blocks: list) -> list[Phrases]:
    """The phrases of a pass's broadcast, unpacked once per worker; those of the pass before are let go."""
    if not blocks:
        return []
    (shared,) = blocks
    if shared[0] not in _HELD:
        _HELD.clear()
        _HELD[shared[0]] = [pickle.loads(b) for b in shared[1].value]
    return _HELD[shared[0]]


def phrase_blocks(benchmark: DataFrame, id_col: str, text: str, window: int) -> DataFrame:
    """(block, phrases): written blocks of phrases, built by tasks. Items are dealt by a hash, so blocks are about equal."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t")).where("t IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("i", "t"), F.lit(blocks)).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, texts = None, [], []
        row = lambda: pa.RecordBatch.from_arrays([pa.array([held], pa.int32()), pa.array([pickle.dumps(Phrases(ids, texts, window))], pa.binary())], names=["block", "phrases"])
        for batch in batches:
            for block, i, t in zip(*(batch.column(c).to_pylist() for c in ("block", "i", "t")), strict=True):
                if block != held:
                    if ids:
                        yield row()
                    held, ids, texts = block, [], []
                ids.append(i)
                texts.append(t)
        if ids:
            yield row()

    return written(dealt.repartition("block").sortWithinPartitions("block").mapInArrow(run, "block int, phrases binary"), "phrases")


ADDED = ("n_words", "n_hit", "items", "spans", "contaminated")


def mark_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, keep_text: bool = False
) -> DataFrame:
    """Columns of ``docs`` (``text`` only if ``keep_text``), then n_words, n_hit, items, spans (characters), ``contaminated``.

    Contaminated: some word lies in a phrase and those words are at least 5
    percent of all words. Columns of ``docs`` named like an added one are replaced.
    """
    ship_package(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    table = phrase_blocks(benchmark, item_id, item_text, window)
    numbers = sorted(r["block"] for r in table.select("block").collect())  # small integers, one per ``BLOCK`` bytes
    groups = [numbers[k : k + HELD] for k in range(0, len(numbers), HELD)] or [[]]
    rest = [c for c in docs.columns if c not in ADDED and (keep_text or c != text)]
    rows = docs.select(*dict.fromkeys([*rest, text]))
    kinds = lambda names: [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema]
    for k, group in enumerate(groups):
        last = k == len(groups) - 1
        held = [bytes(r["phrases"]) for r in table.where(F.col("block").isin(group)).collect()] if group else []  # at most HELD blocks
        shared = context.broadcast(held)
        blocks = [(uuid.uuid4().hex, shared)] if held else []
        keep = rest if last else rows.columns if k == 0 else [c for c in rows.columns if c not in (_COVER, _FOUND)]
        found = rows.mapInArrow(_marker(blocks, text, keep, k > 0, last), ", ".join([*kinds(keep), _OUT if last else _PASSED]))
        if not last:
            rows = written(found, "marked")
            shared.destroy()
    marked = found
    return marked.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    plain = docs.select(*(F.col(c).alias(f"c{k}") for k, c in enumerate(docs.columns)))
    marked = mark_contaminated(plain, benchmark, f"c{docs.columns.index(text)}", item_id, item_text, window, keep_text=True)
    return marked.where(~F.col("contaminated")).select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)))


def without_spans(text: str | None, spans: list) -> str | None:
    """The text with its removal spans cut out."""
    if text is None:
        return None
    out, at = [], 0
    for s in spans or []:
        out.append(text[at : s["start"]])
        at = s["end"]
    return "".join([*out, text[at:]])


def items_digest(items: list[str]) -> str:
    return sha256(",".join(sorted(items)).encode()).hexdigest()
