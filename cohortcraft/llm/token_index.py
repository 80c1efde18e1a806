"""Token-id output: raw id payloads with a minimal perfect hash index.

``write_shards(docs)`` encodes every whole text, ends it with ``end_id`` and
writes shards in ascending key order to a folder. A shard is one binary image:

    magic "TOKIDX01" | header (little-endian int64 counts) | bit levels of the
    hash | fingerprint u32 per slot | document ordinal u32 per slot | offset u64
    per document (and the end) | raw ids, u32 little-endian

The hash maps the shard's ``n`` distinct keys to slots 0..n-1 (a cascade of bit
levels: keys alone in a bit stay, the others go to the next level; the slot is
the rank of the bit). A slot keeps a fingerprint, so an unknown key is told apart
but for one in 2^32, and the first document of its key: a look-up reads a
constant number of words whatever the shard's size. The images travel as a
Parquet column, so Spark's commit protocol guards them: a task that is run again
leaves one copy.

Defined cases: null or empty text: the end id alone. Rows that repeat a key
stand next to each other and are all returned. A null key sorts first and is
stored under a reserved key. No rows: no shards. A text is never cut; a shard
holds at least one document and ends once it has ``SHARD_IDS`` ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortcraft.llm import kernels as K
from cohortcraft.llm.storage import written
from cohortcraft.llm.subwords import encoder

SHARD_IDS = 1 << 20
SLICE = 2 << 20
MAGIC = b"TOKIDX01"
NULL_KEY = np.uint64(0x6E756C6C6B657921)
_GAMMA = 2  # bits per key and level

_SHARD = "part int, seq int, n_ids bigint, n_docs bigint, keys array<bigint>, image binary"


def _hash(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return K.mix(keys + K.U64((seed * 0x9E3779B97F4A7C15) % 2**64))


class PerfectHash:
    """Minimal perfect hash of distinct uint64 keys."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        self.ranks, total = [], 0
        for bits in levels:
            self.ranks.append(total + np.concatenate([[0], np.cumsum(bits)]))
            total = int(self.ranks[-1][-1])
        self.size = total

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, rest = [], keys
        while len(rest):
            m = max(8, _GAMMA * len(rest))
            at = (_hash(rest, len(levels) + 1) % K.U64(m)).astype(np.int64)
            bits = np.bincount(at, minlength=m) == 1
            levels.append(bits)
            rest = rest[~bits[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for some keys that are not in the set."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = (_hash(keys[open_], level + 1) % K.U64(len(bits))).astype(np.int64)
            here = bits[at]
            out[open_[here]] = ranks[at[here]]
            open_ = open_[~here]
        return out


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_hash(keys, 0) >> K.U64(32)).astype(np.uint32)


def _plain_keys(keys: pa.Array) -> np.ndarray:
    filled = np.asarray(keys.fill_null(0)).astype(np.int64).view(K.U64)
    return np.where(np.asarray(keys.is_null()), NULL_KEY, filled)


def build_image(keys: np.ndarray, ids: np.ndarray, offsets: np.ndarray) -> bytes:
    """keys (uint64, equal ones adjacent), ids (uint32) and document offsets -> shard image."""
    distinct, ordinal = np.unique(keys, return_index=True)
    table = PerfectHash.build(distinct)
    slot = table.slots(distinct)
    fingerprints, ordinals = np.empty(len(distinct), np.uint32), np.empty(len(distinct), np.uint32)
    fingerprints[slot], ordinals[slot] = _fingerprints(distinct), ordinal
    sizes = [len(b) for b in table.levels]
    header = np.array([len(keys), len(distinct), len(ids), len(sizes), *sizes], "<i8").tobytes()
    bits = b"".join(np.packbits(b).tobytes() for b in table.levels)
    body = [fingerprints.astype("<u4").tobytes(), ordinals.astype("<u4").tobytes(), offsets.astype("<u8").tobytes(), ids.astype("<u4").tobytes()]
    return b"".join([MAGIC, header, bits, *body])


class Shard:
    """Keyed access to one image."""

    def __init__(self, image: bytes) -> None:
        if image[:8] != MAGIC:
            raise ValueError("not a token-id shard")
        self.n_docs, n_keys, self.n_ids, n_levels = np.frombuffer(image, "<i8", 4, 8).tolist()
        sizes = np.frombuffer(image, "<i8", n_levels, 40).tolist()
        at, levels = 40 + 8 * n_levels, []
        for size in sizes:
            packed = np.frombuffer(image, np.uint8, (size + 7) // 8, at)
            levels.append(np.unpackbits(packed, count=size).astype(bool))
            at += len(packed)
        self.hash = PerfectHash(levels)
        self.fingerprints = np.frombuffer(image, "<u4", n_keys, at)
        self.ordinals = np.frombuffer(image, "<u4", n_keys, at + 4 * n_keys)
        self.offsets = np.frombuffer(image, "<u8", self.n_docs + 1, at + 8 * n_keys).astype(np.int64)
        self.ids = np.frombuffer(image, "<u4", self.n_ids, at + 8 * n_keys + 8 * (self.n_docs + 1))

    def first_documents(self, keys: np.ndarray) -> np.ndarray:
        """Ordinal of the first document of each key; -1 where the shard has no such key."""
        slot = self.hash.slots(keys)
        if len(self.fingerprints) == 0:
            return slot
        known = (slot >= 0) & (self.fingerprints[slot] == _fingerprints(keys))
        return np.where(known, self.ordinals[slot].astype(np.int64), -1)

    def document(self, ordinal: int) -> np.ndarray:
        return self.ids[self.offsets[ordinal] : self.offsets[ordinal + 1]]


def _packer(path: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(path), TaskContext.get().partitionId()
        keys: list[pa.Array] = []
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        held = seq = 0

        def shard() -> pa.RecordBatch:
            nonlocal keys, ids, sizes, held, seq
            key = pa.concat_arrays(keys)
            flat, size = np.concatenate(ids), np.concatenate(sizes)
            image = build_image(_plain_keys(key), flat, np.concatenate([[0], np.cumsum(size)]))
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([seq], pa.int32()),
                    pa.array([len(flat)], pa.int64()),
                    pa.array([len(size)], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(key)], pa.int32()), key),
                    pa.array([image], pa.binary()),
                ],
                names=["part", "seq", "n_ids", "n_docs", "keys", "image"],
            )
            keys, ids, sizes, held, seq = [], [], [], 0, seq + 1
            return row

        for batch in batches:
            column = batch.column("text")
            for i, j in K.slices(K.buffer(column)[1], SLICE):
                flat, first = enc.encode(column.slice(i, j - i))
                ended = np.insert(flat, first[1:], end_id).astype(np.uint32)
                keys.append(batch.column("key").slice(i, j - i))
                ids.append(ended)
                sizes.append(np.diff(first) + 1)
                held += len(ended)
                if held >= SHARD_IDS:
                    yield shard()
        if keys:
            yield shard()

    return run


def write_shards(docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 2) -> None:
    """Encode ``docs`` and write shards in ascending ``key`` order to ``folder``."""
    plain = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    ordered = plain.repartitionByRange(F.col("key").asc_nulls_first()).sortWithinPartitions(F.col("key").asc_nulls_first())
    ordered.mapInArrow(_packer(tokenizer, end_id), _SHARD).write.parquet(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_SHARD).parquet(folder)


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, seq, shard_start): ids in all shards before. Reads sizes only, no image."""
    sizes = shards.select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per written partition
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_b", F.coalesce(F.sum("n_ids").over(within), F.lit(0))).join(parts, "part")
    return starts.select("part", "seq", (F.col("part_start") + F.col("_b")).alias("shard_start"))


def _documents_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["part", "seq", "doc_id", "offset", "n_tokens", "ids_crc32"]
    for batch in batches:
        for r in range(batch.num_rows):
            shard = Shard(batch.column("image")[r].as_py())
            key = batch.column("keys")[r].values
            plain = _plain_keys(key)
            again = np.arange(len(plain))
            new = np.ones(len(plain), bool)
            new[1:] = plain[1:] != plain[:-1]
            nth = again - np.maximum.accumulate(np.where(new, again, 0))
            ordinal = shard.first_documents(plain) + nth
            a, b = shard.offsets[ordinal], shard.offsets[ordinal + 1]
            raw = memoryview(shard.ids.tobytes())
            crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
            part, seq = (pa.array(np.full(len(a), batch.column(c)[r].as_py(), np.int32)) for c in ("part", "seq"))
            yield pa.RecordBatch.from_arrays([part, seq, key, pa.array(a, pa.int64()), pa.array(b - a, pa.int64()), pa.array(crc, pa.int64())], names=names)


def documents_of(shards: DataFrame) -> DataFrame:
    """Every document of the shards, found by its key: (doc_id, start, n_tokens, ids_crc32)."""
    rows = shards.select("part", "seq", "keys", "image")
    found = rows.mapInArrow(_documents_of, "part int, seq int, doc_id bigint, offset bigint, n_tokens bigint, ids_crc32 bigint")
    placed = found.join(shard_starts(shards), ["part", "seq"])
    return placed.select("doc_id", (F.col("shard_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("key", pa.int64()), ("ids", pa.list_(pa.int64()))])
    for batch in batches:
        for r in range(batch.num_rows):
            shard = Shard(batch.column("image")[r].as_py())
            wanted = batch.column("wanted")[r].values
            found = shard.first_documents(_plain_keys(wanted))
            ids = [shard.document(o).astype(np.int64) for o in found[found >= 0]]
            at = [pa.array(np.full(len(ids), batch.column(c)[r].as_py(), np.int32)) for c in ("part", "seq")]
            yield pa.RecordBatch.from_arrays([*at, wanted.filter(pa.array(found >= 0)), pa.array(ids, pa.list_(pa.int64()))], schema=schema)


MAX_PARTS = 1_000_000
"""Written partitions whose key ranges are sent to the tasks (24 bytes each); more raise."""


def look_up(shards: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """(key, ids) of the first document of each wanted key; unknown and null keys have no row.

    Shards are key ranges, so a key is sent to the one or two written partitions
    whose range holds it, meets there the shards whose range does, and is found
    by a single probe of a perfect hash; no other key is touched.
    """
    low, high = F.array_min("keys"), F.array_max("keys")
    ranges = written(shards.select("part", "seq", low.alias("low"), high.alias("high")).where("high IS NOT NULL"), "key-ranges")
    parts = ranges.groupBy("part").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("low", "high").limit(MAX_PARTS + 1).collect()
    if len(parts) > MAX_PARTS:
        raise ValueError(f"over {MAX_PARTS} written partitions; write larger ones")
    sent = shards.sparkSession.sparkContext.broadcast(tuple(np.array([r[c] for r in parts], np.int64) for c in ("part", "low", "high")))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, low, high = sent.value
        for batch in batches:
            k = batch.column(0).to_numpy()
            # ranges follow each other and touch in repeated keys at most
            a, b = np.searchsorted(high, k, "left"), np.searchsorted(low, k, "right")
            n = np.maximum(b - a, 0)
            which = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(k, n)), pa.array(part[which].astype(np.int32))], names=["key", "part"])

    wanted = keys.select(F.col(key).cast("bigint").alias("key")).where("key IS NOT NULL").distinct().mapInArrow(dealt, "key bigint, part int")
    inside = wanted.join(ranges, "part").where((F.col("low") <= F.col("key")) & (F.col("key") <= F.col("high")))
    asked = inside.groupBy("part", "seq").agg(F.collect_list("key").alias("wanted"))  # bounded by a shard's key range
    images = shards.select("part", "seq", "image").join(asked, ["part", "seq"]).select("part", "seq", "wanted", "image")
    found = images.mapInArrow(_look_up, "part int, seq int, key bigint, ids array<bigint>")
    return found.groupBy("key").agg(F.min(F.struct("part", "seq", "ids")).alias("_f")).select("key", F.col("_f.ids").alias("ids"))
