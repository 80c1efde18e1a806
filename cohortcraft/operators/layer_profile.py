"""Profiles that cost no second scan: counters taken while a layer is written, and mergeable ones per partition.

``write_profiled`` observes the rows on their way into the files. The counters
stand behind the last exchange, in the tasks that write, so a repeated map task
cannot count twice.

``partition_profiles`` keeps one row per partition value with additive counters
and an HLL sketch of the ids; ``merged_profile`` adds rows up and unites sketches.
A layer that grows is profiled by its arrivals alone. The distinct count of
merged sketches is off by about ``STANDARD_ERROR`` of itself (one standard
error); ``quality.typed_profile`` is the exact form.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cohortcraft.functions.metrics import n_rows, n_where
from cohortcraft.operators.quality import rule_counts, typed_rules

SKETCH_BITS = 14
STANDARD_ERROR = 1.04 / math.sqrt(2**SKETCH_BITS)
_SKETCH = "loan_id_sketch"


def counters(typed: DataFrame, id_col: str = "loan_id", date_col: str = "issue_date") -> list[Column]:
    """The additive counters of the typed layer's quality profile."""
    return [
        n_rows().alias("row_count"),
        n_where(F.col(id_col).isNull()).alias("missing_loan_ids"),
        F.min(date_col).alias("first_issue_date"),
        F.max(date_col).alias("last_issue_date"),
        *rule_counts(typed, typed_rules()),
    ]


def sketch(id_col: str = "loan_id") -> Column:
    return F.hll_sketch_agg(F.col(id_col).cast("string"), SKETCH_BITS).alias(_SKETCH)


def write_profiled(df: DataFrame, path: str, measures: list[Column], partition_by: list[str] | None = None) -> dict:
    """Write ``df`` and return ``measures`` of the written rows, from the same pass.

    Rows of a partition value are gathered before they are observed, so the
    writer adds no exchange behind the counters.
    """
    seen = Observation("written")
    dealt = df.hint("rebalance", *partition_by) if partition_by else df
    observed = dealt.observe(seen, *measures)
    writer = observed.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return seen.get


def partition_profiles(df: DataFrame, by: list[str], measures: list[Column] | None = None, id_col: str = "loan_id") -> DataFrame:
    """One row per value of ``by``: counters and the id sketch. One pass, combined on the map side."""
    return df.groupBy(*by).agg(*(measures or counters(df, id_col)), sketch(id_col))


def merged_profile(profiles: DataFrame, by: list[str]) -> DataFrame:
    """One-row profile of all partitions; counters add up, dates take their extremes, sketches unite."""
    parts = []
    for name, kind in profiles.dtypes:
        if name in by or name == _SKETCH:
            continue
        fold = F.min if name.startswith("first_") else F.max if name.startswith("last_") else F.sum
        parts.append(fold(name).alias(name))
    return profiles.agg(*parts, F.hll_sketch_estimate(F.hll_union_agg(_SKETCH)).alias("estimated_distinct_loan_ids"))


def store_profiles(profiles: DataFrame, path: str) -> None:
    """Append profiles of arrived partitions to the stored ones."""
    profiles.write.mode("append").parquet(path)
