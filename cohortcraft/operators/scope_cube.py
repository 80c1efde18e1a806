"""Scope metrics from one fine aggregate.

The scopes' predicates read a few columns only (``DIMENSIONS``). Rows are added up
once per combination of these; the predicates then run over the combinations, a
few ten thousand at most, instead of over rows, and each scope adds up the
combinations it holds. Any number of overlapping scopes costs one exchange of
partial sums, and no row is copied per scope.

The combinations are bounded by months x terms x outcomes x sub-grades, however
many contracts there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortcraft.functions.classify import MID_GRADES
from cohortcraft.operators.claims import SEGMENT_PURPOSE
from cohortcraft.operators.cohort import Scope, tag_scopes

DIMENSIONS = ("issue_date", "term_months", "is_resolved", "default_flag", "grade", "sub_grade")

_COUNTS = ("n", "unresolved", "current", "known", "defaults", "seg_n", "seg_known", "seg_defaults", "seg_bc")
_MEANS = ("loan_amount", "annual_income", "interest_rate_pct")


def cells(typed: DataFrame, segment: str = SEGMENT_PURPOSE, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """Counts and sums per combination of the dimensions (combined on the map side)."""
    seg = F.col("purpose") == segment
    flag = F.col("default_flag")

    def n(cond: Column) -> Column:
        return F.count_if(cond)

    sums = []
    for c in _MEANS:
        sums += [F.sum(F.when(seg, F.col(c))).alias(f"sum_{c}"), F.count(F.when(seg, F.col(c))).alias(f"n_{c}")]
    return typed.groupBy(*dimensions).agg(
        F.count("*").alias("n"), n(~F.col("is_resolved")).alias("unresolved"), n(F.col("is_current")).alias("current"),
        n(flag.isNotNull()).alias("known"), n(flag == 1).alias("defaults"), n(seg).alias("seg_n"),
        n(seg & flag.isNotNull()).alias("seg_known"), n(seg & (flag == 1)).alias("seg_defaults"),
        n(seg & F.col("grade").isin(*MID_GRADES)).alias("seg_bc"), *sums,
    )


def scope_aggregates(fine: DataFrame, scopes: tuple[Scope, ...]) -> DataFrame:
    """The columns of ``claims.scope_aggregates``, one row per scope that holds a contract."""
    columns = [*_COUNTS, *[f"{p}_{c}" for c in _MEANS for p in ("sum", "n")]]
    total = tag_scopes(fine, scopes, columns).groupBy("scope_id").agg(*[F.sum(c).alias(c) for c in columns])
    mean = lambda part, whole: F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))
    return total.select(
        "scope_id",
        F.col("n").alias("total_loans"),
        F.col("unresolved").alias("unresolved_loans"),
        F.col("current").alias("current_loans"),
        F.col("known").alias("known_outcome_loans"),
        mean("defaults", "known").alias("overall_default_rate"),
        F.col("seg_n").alias("segment_loans"),
        F.col("seg_known").alias("segment_known_outcome_loans"),
        mean("seg_defaults", "seg_known").alias("segment_default_rate"),
        mean("sum_loan_amount", "n_loan_amount").alias("avg_amount"),
        mean("sum_annual_income", "n_annual_income").alias("avg_income"),
        mean("seg_bc", "seg_n").alias("bc_share"),
        mean("sum_interest_rate_pct", "n_interest_rate_pct").alias("avg_rate"),
    )
