"""Connected components by alternating large-star and small-star.

Every round is two groupings (combined on the map side) and two joins on the
node; neighbour lists are never gathered, so a node with many links costs rows,
not memory, and adaptive execution can split its join partition. Each round's
links are written to the shared folder and the next round reads them; the links
before them are then dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortcraft.llm.storage import drop, written


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _least(links: DataFrame) -> DataFrame:
    """links (a > b) -> (a, m): the smallest of a node and its neighbours."""
    return _both(links).groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def _large_star(links: DataFrame, least: DataFrame) -> DataFrame:
    """links (a > b): connect every larger neighbour of a node to the node's smallest neighbour."""
    return _both(links).where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """links (a > b): connect a node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], int(row["s"] or 0)


def connected_components(pairs: DataFrame, rounds: int = 60) -> DataFrame:
    """(a, b) pairs of bigint nodes -> (node, component), component = smallest node reachable.

    Pairs may repeat, point either way or join a node with itself (such a node
    without another link is left out); pairs with a null are ignored. No pairs:
    no rows. Raises when ``rounds`` do not suffice (each round at least halves
    the depth, so 60 cover any input).
    """
    links = written(
        pairs.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    state = _state(links)
    for _ in range(rounds):
        if state[0] == 0:
            break
        least = written(_least(links), "least")  # a stored side lets the join split a hub's rows over tasks
        after = written(_small_star(_large_star(links, least)), "links")
        drop(links, least)
        links, before, state = after, state, _state(after)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
