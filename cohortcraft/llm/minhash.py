"""MinHash linking: universal-hash minima, banding, verification on full sets, components.

Shared by document near-dedup (``near_dup``) and paragraph dedup. The steps:

1. Items with equal shingle sets (equal 128-bit digest) are one node, so copies
   cost one row each, whatever their number.
2. ``rows`` minima make a band; nodes that share a band value collide. Colliding
   nodes are joined to the smallest node of the band value (a star, never all
   pairs), and components of these stars are the *candidate groups*: two
   colliding nodes are always in the same group.
3. Inside a candidate group full sets are compared exactly, in blocks of
   bounded size: a group is cut into blocks of about ``BLOCK`` shingles by a
   hash of the node, every pair of blocks is one unit of work, and each
   unit returns a spanning forest of its links (at most one row per node), not
   the pairs. Links found there connect exactly the nodes that all pairs would.
4. Components of these links by alternating large-star and small-star.

Recall comes from the banding alone: a pair with similarity s collides with
probability 1 - (1 - s^rows)^bands.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortcraft.llm import kernels as K
from cohortcraft.llm.components import connected_components
from cohortcraft.llm.storage import written

BLOCK = 500_000
"""Shingles of a candidate group that stand in one block (two blocks meet in a task)."""

SLICE = 1 << 20
"""Bytes of text that are hashed at a time."""

DENSE = 20_000
"""Shingles of a unit of work up to which every set is held against every other."""


@dataclass(frozen=True)
class Banding:
    bands: int
    rows: int

    def recall(self, similarity: float) -> float:
        return 1 - (1 - similarity**self.rows) ** self.bands


def tune(similarity: float, miss: float, rows: int) -> Banding:
    """Fewest bands of ``rows`` minima that miss a pair of that similarity with at most ``miss``."""
    return Banding(int(np.ceil(np.log(miss) / np.log1p(-(similarity**rows)))), rows)


def coefficients(n: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**31, n, dtype=np.uint32) * 2 + 1, rng.integers(0, 2**32, n, dtype=np.uint32)


def band_values(values: np.ndarray, first: np.ndarray, banding: Banding) -> np.ndarray:
    """(items, bands) int64: one value per band from minima of ``a*x + b`` over each item's shingles.

    Items without shingles must not be passed.
    """
    x = (values >> K.U64(32)).astype(np.uint32)
    a, b = coefficients(banding.bands * banding.rows)
    out = np.zeros((banding.bands, len(first) - 1), K.U64)
    starts = first[:-1]
    buf = np.empty_like(x)
    with np.errstate(over="ignore"):
        for band in range(banding.bands):
            acc = np.full(len(starts), band + 1, K.U64)
            for row in range(banding.rows):
                k = band * banding.rows + row
                np.multiply(x, a[k], out=buf)
                np.add(buf, b[k], out=buf)
                acc = acc * K.U64(0x9E3779B97F4A7C15) + np.minimum.reduceat(buf, starts)
            out[band] = K.mix(acc)
    return out.T.view(np.int64)


def digests(values: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    raw = values.tobytes()
    return [blake2b(raw[8 * a : 8 * b], digest_size=16).digest() if b > a else None for a, b in zip(first[:-1], first[1:], strict=True)]


def sketch_columns(values: np.ndarray, first: np.ndarray, banding: Banding) -> list[pa.Array]:
    """n_shingles, digest, bands of items given by their sorted distinct shingles."""
    sizes = np.diff(first)
    full = np.flatnonzero(sizes)
    counts = np.where(sizes > 0, banding.bands, 0)
    flat = band_values(values, np.concatenate([first[full], first[-1:]]), banding).reshape(-1) if len(full) else np.zeros(0, np.int64)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return [
        pa.array(sizes.astype(np.int64)),
        pa.array(digests(values, first), pa.binary()),
        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
    ]


def text_shingles(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(row from, row to, sorted distinct shingles, first) of a text column, slice by slice."""
    data, offsets = K.buffer(column)
    for i, j in K.slices(offsets, SLICE):
        chunk = K.lower(data[offsets[i] : offsets[j]])
        start, end, first = K.words(chunk, offsets[i : j + 1] - offsets[i])
        shingles, sfirst = K.shingle_hashes(K.word_hashes(chunk, start, end), first, k)
        yield i, j, *K.distinct_per_row(shingles, sfirst)


# --- candidate groups ---------------------------------------------------


def representatives(base: DataFrame) -> DataFrame:
    """base (id, digest, ...) + ``rep``: the smallest id with an equal set (null without a set)."""
    shared = written(
        base.where("digest IS NOT NULL").groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("n")).where("n > 1").drop("n"),
        "equal-sets",
    )
    return base.join(shared, "digest", "left").withColumn("rep", F.when(F.col("digest").isNotNull(), F.coalesce("rep", "id")))


def candidate_groups(nodes: DataFrame) -> DataFrame:
    """nodes (id, n_shingles, bands) -> (node, grp, blocks) of nodes that collide with another."""
    rows = nodes.select("id", F.explode("bands").alias("v"))
    shared = written(rows.groupBy("v").agg(F.min("id").alias("m"), F.max("id").alias("x")).where("m < x").drop("x"), "bands")
    stars = rows.join(shared, "v").where("id <> m").select(F.col("id").alias("a"), F.col("m").alias("b"))
    groups = connected_components(stars)
    sized = groups.join(nodes.select(F.col("id").alias("node"), "n_shingles"), "node").withColumnRenamed("component", "grp")
    sized = written(sized, "groups")
    blocks = sized.groupBy("grp").agg(F.ceil(F.sum("n_shingles") / F.lit(float(BLOCK))).cast("int").alias("blocks"))
    many = written(blocks.where("blocks > 1"), "large-groups")
    return sized.join(many, "grp", "left").select("node", "grp", F.coalesce("blocks", F.lit(1)).alias("blocks"))


# --- exact verification ---------------------------------------------------


class _Forest:
    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)
        self.parts = n

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def roots(self, rows: np.ndarray) -> np.ndarray:
        at = self.parent[rows]
        while (up := self.parent[at]).tobytes() != at.tobytes():
            at = up
        self.parent[rows] = at
        return at

    def join(self, i: int, j: int) -> bool:
        a, b = self.find(i), self.find(j)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        self.parts -= 1
        return True


def spanning_links(sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the pairs with 100*|A&B| >= percent*|A|B|.

    ``side``: 0 or 1; when both occur only pairs across sides count.
    """
    n = len(sets)
    across = side.any() and not side.all()
    forest, links = _Forest(n), []
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if 100 * both >= percent * (len(sets[0]) + len(sets[1]) - both) else []
    sizes = np.array([len(s) for s in sets])
    first = np.concatenate([[0], np.cumsum(sizes)])
    _, codes, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    seen = np.zeros(len(counts), np.int32)
    central = np.add.reduceat(counts[codes], first[:-1]) / sizes  # most links first: later nodes find theirs made
    met = _Meeting(codes, first, counts, percent) if len(codes) > DENSE else None
    everyone = np.arange(n)
    for i in np.argsort(-central, kind="stable"):
        if forest.parts == 1:
            break
        others = everyone if met is None else met.of(i)
        if met is not None:
            others = others[forest.roots(others) != forest.find(i)]
            if not len(others):
                continue
        own = codes[first[i] : first[i + 1]]
        seen[own] = 1
        both = np.add.reduceat(seen[codes], first[:-1]) if met is None else _sums(seen, codes, first[others], sizes[others])
        seen[own] = 0
        near = 100 * both >= percent * (sizes[others] + sizes[i] - both)
        if across:
            near &= side[others] != side[i]
        near &= others != i
        links += [(int(i), int(j)) for j in others[near] if forest.join(int(i), int(j))]
    return links


def _spots(first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions of the ranges first .. first + sizes, one after the other, where each begins among them)."""
    begin = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(first - begin, sizes), begin


def _sums(seen: np.ndarray, codes: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many codes of each range are seen."""
    spots, begin = _spots(first, sizes)
    return np.add.reduceat(seen[codes[spots]], begin)


class _Meeting:
    """Which sets may be near a set: those that share one of its rarest codes.

    Near sets have at least ``percent`` of either in common, so that the
    rarest ``size - ceil(percent * size / 100) + 1`` codes of both (in one order
    of all codes) have one in common; no near pair is left out.
    """

    def __init__(self, codes: np.ndarray, first: np.ndarray, counts: np.ndarray, percent: int) -> None:
        sizes = np.diff(first)
        rank = np.empty(len(counts), np.int64)
        rank[np.argsort(counts, kind="stable")] = np.arange(len(counts))
        row = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((rank[codes], row))
        lead = sizes + (-percent * sizes // 100) + 1
        spots, _ = _spots(first[:-1], lead)
        self.codes, self.first = codes[order[spots]], np.concatenate([[0], np.cumsum(lead)])
        self.rows = np.repeat(np.arange(len(sizes)), lead)[np.argsort(self.codes, kind="stable")]
        self.ends = np.cumsum(np.bincount(self.codes, minlength=len(counts)))

    def of(self, i: int) -> np.ndarray:
        own = self.codes[self.first[i] : self.first[i + 1]]
        low = np.where(own > 0, self.ends[own - 1], 0)
        return np.unique(self.rows[_spots(low, self.ends[own] - low)[0]])


def _verifier(percent: int, dtype: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (grp, p, q, own, node, shingles) sorted by (grp, p, q) -> links (a, b)."""

    def links_of(rows: list[tuple]) -> list[tuple[int, int]]:
        if len(rows) < 2:
            return []
        nodes = [r[0] for r in rows]
        found = spanning_links([np.frombuffer(r[2], dtype) for r in rows], np.array([r[1] for r in rows]), percent)
        return [(nodes[i], nodes[j]) for i, j in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, [], []
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        pack = lambda: pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], schema=schema)
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("grp", "p", "q", "own", "node", "shingles")]
            for g, p, q, own, node, shingles in zip(*cols, strict=True):
                if (g, p, q) != key:
                    out += links_of(held)
                    key, held = (g, p, q), []
                held.append((node, int(own != p), shingles))
            yield pack()
            out = []
        out += links_of(held)
        yield pack()

    return run


def verified_links(sets: DataFrame, percent: int, dtype: str = "<u8") -> DataFrame:
    """sets (node, grp, blocks, shingles binary) -> links (a, b) that connect all near pairs of each group."""
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    units = (
        sets.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("grp", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "node", "shingles")
    )
    dealt = units.repartition("grp", "p", "q").sortWithinPartitions("grp", "p", "q", "node")
    return dealt.mapInArrow(_verifier(percent, dtype), "a bigint, b bigint")


def linked(base: DataFrame, fetch: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """base (id, n_shingles, digest, bands) + ``rep`` and ``component`` (null without shingles).

    ``fetch`` turns the plan (node, grp, blocks) into (node, grp, blocks, shingles).
    """
    known = written(representatives(base.where("id IS NOT NULL")), "nodes")
    nodes = known.where("id = rep").dropDuplicates(["id", "digest"])
    groups = written(candidate_groups(nodes), "candidates")
    links = verified_links(fetch(groups), percent)
    parts = written(connected_components(links), "components")
    return known.join(parts, known["rep"] == parts["node"], "left").withColumn("component", F.coalesce("component", "rep")).drop("node", "bands")
