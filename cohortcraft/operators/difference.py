"""Keyed difference of two versions of a table.

Both versions are cut into buckets of the key's hash. One pass per version gives
every bucket a fingerprint (row count, sum and xor of 64-bit row hashes, of two
hash functions); rows travel only for buckets whose fingerprints differ. There,
keys are matched and every differing column of a changed row is reported.

The bucket list is bounded by ``buckets``. A version that is mostly equal is read
twice and shuffled almost not at all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_bucket")


def fingerprints(df: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, rows, total, mixed, other): what the rows of a bucket add up to, in any order."""
    columns = sorted(df.columns)
    row = F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])
    other = F.hash(*reversed(columns)).cast("bigint")
    marked = df.select(_bucket(keys, buckets), row.alias("_row"), other.alias("_other"))
    return marked.groupBy("_bucket").agg(
        F.count("*").alias("rows"), F.sum(F.col("_row").cast("decimal(38,0)")).alias("total"),
        F.bit_xor("_row").alias("mixed"), F.sum(F.col("_other").cast("decimal(38,0)")).alias("other"),
    )


def differing_buckets(old: DataFrame, new: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Buckets that differ (at most ``buckets`` rows)."""
    a, b = fingerprints(old, keys, buckets).alias("a"), fingerprints(new, keys, buckets).alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("rows", "total", "mixed", "other")])
    both = a.join(b, F.col("a._bucket") == F.col("b._bucket"), "full").where(~same)
    return both.select(F.coalesce("a._bucket", "b._bucket").alias("_bucket"))


def difference(old: DataFrame, new: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(keys, change, column, old_value, new_value): what turns ``old`` into ``new``.

    ``change`` is ``added`` or ``dropped`` (one row per key, no column) or
    ``changed`` (one row per column that differs, values as text). NULL equals
    NULL, in keys too. A key that occurs more than once on a side where the rows
    differ gives one row ``repeated``. Columns must be the same on both sides.
    """
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError(f"columns differ: {sorted(set(old.columns) ^ set(new.columns))}")
    values = [c for c in old.columns if c not in keys]
    where = F.broadcast(differing_buckets(old, new, keys, buckets))  # at most ``buckets`` rows
    content = F.xxhash64(*values, *[F.col(c).isNull() for c in values]) if values else F.lit(0).cast("bigint")

    def side(df: DataFrame, name: str) -> DataFrame:
        rows = df.withColumn("_bucket", _bucket(keys, buckets)).join(where, "_bucket", "left_semi")
        # one row per key: its values where it occurs once
        return rows.groupBy(*keys).agg(
            F.count("*").alias("n"), F.sum(content.cast("decimal(38,0)")).alias("content"),
            F.first(F.struct(*[F.col(c).cast("string").alias(c) for c in values], F.lit(1).alias("_"))).alias("row"),
        ).alias(name)

    match = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    both = side(old, "a").join(side(new, "b"), match, "full")
    differs = [
        F.when(~F.col(f"a.row.{c}").eqNullSafe(F.col(f"b.row.{c}")),
               F.struct(F.lit(c).alias("column"), F.col(f"a.row.{c}").alias("old_value"), F.col(f"b.row.{c}").alias("new_value")))
        for c in values
    ]
    empty = F.array(F.struct(*[F.lit(None).cast("string").alias(x) for x in ("column", "old_value", "new_value")]))
    change = (
        F.when((F.coalesce("a.n", F.lit(0)) > 1) | (F.coalesce("b.n", F.lit(0)) > 1),
               F.when(~(F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.content").eqNullSafe(F.col("b.content"))), "repeated"))
        .when(F.col("b.n").isNull(), "dropped").when(F.col("a.n").isNull(), "added").otherwise("changed")
    )
    details = F.when(change == "changed", F.array_compact(F.array(*differs))).otherwise(empty) if values else empty
    key_of = [F.when(F.col("a.n").isNotNull(), F.col(f"a.{k}")).otherwise(F.col(f"b.{k}")).alias(k) for k in keys]
    listed = both.select(*key_of, change.alias("change"), details.alias("_details")).where(F.col("change").isNotNull())
    return listed.select(*keys, "change", F.explode("_details").alias("_d")).select(*keys, "change", "_d.*")
