"""K-d tree sharding: split at weighted medians along the widest metadata dimension.

The tree is grown level by level. For every open node one pass finds the widest
dimension (range of the node over the range of the table) and a few passes find
the weighted quantile on it: bytes are summed per (node, bin), a running sum
finds the bin that holds the quantile, and the next pass bins that bin. Sums
are combined on the map side; one row per node reaches the driver, never a
document. The finished tree is a nested CASE over the coordinates.

A coordinate is the dimension's value on a fixed grid, followed by bits of a
hash of the row, so equal values (a source with a third of all rows, copies)
can be split anywhere. Built-in functions only.

Defined cases: null text has no bytes (size 8); null metadata stands at the lower
end; null ids hash like any value. Rows equal in id and text cannot be told
apart, so they share a shard unless the tree cuts elsewhere. An empty table
has no rows. Fewer rows than shards leave shards empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortcraft.llm.storage import written

DIMENSIONS = ("n_chars", "lang", "source")
GRID_BITS = 30
TIE_BITS = 32
BINS = 1 << 15
SLOT_BLOCK = 50_000
"""Rows of a shard, on average, that one task numbers."""


@dataclass
class Node:
    leaves: int
    first: int  # shard of its first leaf
    dim: int | None = None
    at: int | None = None  # rows with a coordinate <= at go left
    left: Node | None = None
    right: Node | None = None


def _raw(docs: DataFrame, dims: tuple[str, ...], id_col: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    kinds = dict(docs.dtypes)
    grid = [
        (F.coalesce(F.col(d).cast("double"), F.lit(0.0)) if kinds[d] != "string" else F.when(F.col(d).isNull(), 0.0).otherwise(1 + F.pmod(F.xxhash64(d), F.lit(1 << 20)).cast("double")))
        for d in dims
    ]
    return docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(body) + 8).cast("bigint").alias("size"),
        F.crc32(body).alias("crc"),
        *(g.alias(f"v{k}") for k, g in enumerate(grid)),
    )


def _coordinates(points: DataFrame, n_dims: int) -> DataFrame:
    lo_hi = points.agg(*(f(f"v{k}").alias(f"{n}{k}") for k in range(n_dims) for n, f in (("lo", F.min), ("hi", F.max)))).first()
    tie = F.xxhash64(F.col("id").cast("string"), F.col("crc")).bitwiseAND(F.lit((1 << TIE_BITS) - 1))
    out = points
    for k in range(n_dims):
        lo, hi = float(lo_hi[f"lo{k}"] or 0.0), float(lo_hi[f"hi{k}"] or 0.0)
        scale = ((1 << GRID_BITS) - 1) / (hi - lo) if hi > lo else 0.0
        cell = F.floor((F.col(f"v{k}") - F.lit(lo)) * F.lit(scale)).cast("bigint")
        out = out.withColumn(f"c{k}", F.shiftleft(cell, TIE_BITS).bitwiseOR(tie))
    return out.select("id", "size", "crc", *(f"c{k}" for k in range(n_dims)))


def _shard(node: Node) -> Column:
    if node.left is None:
        return F.lit(node.first)
    return F.when(F.col(f"c{node.dim}") <= F.lit(node.at), _shard(node.left)).otherwise(_shard(node.right))


def _values(points: DataFrame, columns: str, rows: list[tuple]) -> DataFrame:
    """A literal table of one row per open node (at most as many as shards)."""
    body = ", ".join("(" + ", ".join(f"{v}D" if isinstance(v, float) else f"{v}L" for v in r) + ")" for r in rows)
    return points.sparkSession.sql(f"SELECT * FROM VALUES {body} AS t({columns})")


def _split(points: DataFrame, root: Node, open_: list[Node], n_dims: int, tolerance: float) -> None:
    """Set dimension and threshold of every open node."""
    rows = points.withColumn("node", _shard(root).cast("bigint"))
    wanted = _values(points, "node", [(n.first,) for n in open_])
    measures = [F.sum("size").alias("bytes"), *(f(f"c{k}").alias(f"{n}{k}") for k in range(n_dims) for n, f in (("lo", F.min), ("hi", F.max)))]
    stats = {r["node"]: r for r in rows.join(F.broadcast(wanted), "node").groupBy("node").agg(*measures).collect()}  # one row per node
    search: dict[int, dict] = {}
    for n in open_:
        s = stats.get(n.first)
        if s is None:  # a node without rows
            n.dim, n.at = 0, 0
            continue
        widths = [(s[f"hi{k}"] >> TIE_BITS) - (s[f"lo{k}"] >> TIE_BITS) for k in range(n_dims)]
        n.dim = widths.index(max(widths))
        want = s["bytes"] * (n.leaves // 2) / n.leaves
        search[n.first] = {"lo": s[f"lo{n.dim}"], "hi": s[f"hi{n.dim}"], "before": 0, "want": want, "leaf": s["bytes"] / n.leaves, "node": n}
    coordinate = F.element_at(F.array(*(f"c{k}" for k in range(n_dims))), F.col("dim").cast("int"))
    while search:
        for s in search.values():
            s["step"] = (s["hi"] - s["lo"]) // BINS + 1
        parameters = _values(
            points, "node, dim, lo, hi, step, want",
            [(f, s["node"].dim + 1, s["lo"], s["hi"], s["step"], float(s["want"] - s["before"])) for f, s in search.items()],
        )
        inside = rows.join(F.broadcast(parameters), "node").withColumn("c", coordinate).where("c BETWEEN lo AND hi")
        bins = inside.groupBy("node", "want", F.expr("(c - lo) div step").alias("bin")).agg(F.sum("size").alias("w"), F.count("*").alias("n"))
        running = Window.partitionBy("node").orderBy("bin")  # at most BINS rows a node
        crossing = bins.withColumn("run", F.sum("w").over(running)).where("run >= want")
        crossing = crossing.groupBy("node").agg(F.min(F.struct("bin", "w", "n", "run")).alias("x"))
        found = {r["node"]: r["x"] for r in crossing.collect()}  # one row per node
        for f in list(search):
            s, x = search[f], found.get(f)
            if x is None:  # rounding at the upper end: everything goes left
                s["node"].at = s["hi"]
                del search[f]
                continue
            b_lo = s["lo"] + x["bin"] * s["step"]
            b_hi = min(s["hi"], b_lo + s["step"] - 1)
            below = s["before"] + x["run"] - x["w"]
            if b_lo == b_hi or x["n"] == 1 or x["w"] <= tolerance * s["leaf"]:
                nearer_low = s["want"] - below < below + x["w"] - s["want"]
                s["node"].at = b_lo - 1 if nearer_low else b_hi
                del search[f]
            else:
                s.update(lo=b_lo, hi=b_hi, before=below)


def kd_tree(points: DataFrame, shards: int, n_dims: int, tolerance: float = 1e-3) -> Node:
    root = Node(shards, 0)
    open_ = [root]
    while open_ := [n for n in open_ if n.leaves > 1]:
        _split(points, root, open_, n_dims, tolerance)
        for n in open_:
            half = n.leaves // 2
            n.left, n.right = Node(half, n.first), Node(n.leaves - half, n.first + half)
        open_ = [c for n in open_ for c in (n.left, n.right)]
    return root


def shard(
    docs: DataFrame,
    shards: int | None = 24,
    target_bytes: int | None = None,
    dims: tuple[str, ...] = DIMENSIONS,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(id, size, crc, shard, slot) of every row: near-equal bytes per shard, slots gapless from 0.

    ``target_bytes`` sets the number of leaves from the table's bytes; else ``shards`` does.
    """
    raw = written(_raw(docs, dims, id_col, text), "kd-points")
    total, rows = (int(x or 0) for x in raw.agg(F.sum("size"), F.count("*")).first())
    if target_bytes is not None:
        shards = max(1, -(-total // target_bytes))
    points = _coordinates(raw, len(dims))
    placed = points.withColumn("shard", _shard(kd_tree(points, shards, len(dims))).cast("int"))
    blocks = max(1, -(-rows // (shards * SLOT_BLOCK)))
    placed = placed.withColumn("block", F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(blocks)))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "block").agg(F.count("*").alias("n")).select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "block").orderBy("id", "crc")
    numbered = placed.withColumn("nth", F.row_number().over(within) - 1).join(starts, ["shard", "block"])
    return numbered.select("id", "size", "crc", "shard", (F.col("start") + F.col("nth")).cast("bigint").alias("slot"))
