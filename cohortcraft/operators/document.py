"""Governed metric documents (overall portfolio + one segment).

One conditional aggregate over the cohort gives both the overall and the
segment figures; the two segment medians come from the distributed
exact-median operator. ``governed_metrics`` is the flat one-row table,
``governed_document`` nests it as the document layout.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortcraft.functions.classify import MID_GRADES
from cohortcraft.functions.metrics import n_rows, n_where
from cohortcraft.operators.claims import SEGMENT_PURPOSE
from cohortcraft.operators.median import with_medians
from cohortcraft.functions.metrics import round_to

# Scope description and metric definitions of the document.
METRIC_SCOPE = {
    "origination_period": "2014-01-01 to 2015-12-31",
    "term_months": 36,
    "population": "loans with a known final outcome",
    "unit_of_analysis": "loan contract",
    "currency": "USD",
}
DEFINITIONS = {
    "default_rate": "Defaulted loans divided by loans with a known final outcome.",
    "portfolio_share": "Segment loan contracts divided by all contracts in the analytical cohort.",
    "average_ticket": "Arithmetic mean of the original requested loan amount.",
}

SEGMENT_FIELDS = (
    ("total_loans", None), ("portfolio_share_pct", 4), ("defaulted_loans", None), ("default_rate_pct", 4),
    ("average_loan_amount_usd", 2), ("median_loan_amount_usd", 2), ("grade_bc_share_pct", 4),
    ("average_interest_rate_pct", 4), ("average_annual_income_usd", 2), ("median_annual_income_usd", 2),
    ("average_dti", 4), ("average_fico_score", 2),
)
OVERALL_FIELDS = (
    ("total_loans", None), ("defaulted_loans", None), ("default_rate_pct", 4), ("average_loan_amount_usd", 2),
    ("average_interest_rate_pct", 4),
)


def governed_metrics(
    cohort: DataFrame, segment: str = SEGMENT_PURPOSE, medians: bool = True, rounding: Callable[[Column, int], Column] = round_to
) -> DataFrame:
    """Flat one-row governed metrics: ``overall_*`` and ``segment_*`` columns.

    ``rounding`` is the rule of the printed digits: that of SQL, or
    ``metrics.half_even`` for documents.

    ``medians=False`` leaves the two median columns NULL and skips their
    stages (for reconciliations that do not compare them).
    """
    seg = F.col("purpose") == segment
    flag = F.col("default_flag")

    def s(c):
        return F.when(seg, c)

    agg = cohort.agg(
        n_rows().alias("o_n"),
        F.sum(flag).cast("long").alias("o_d"),
        F.avg(flag).alias("o_rate"),
        F.avg("loan_amount").alias("o_amount"),
        F.avg("interest_rate_pct").alias("o_int"),
        n_where(seg).alias("s_n"),
        F.sum(s(flag)).cast("long").alias("s_d"),
        F.avg(s(flag)).alias("s_rate"),
        F.avg(s(F.col("loan_amount"))).alias("s_amount"),
        F.avg(s(F.when(F.col("grade").isin(*MID_GRADES), 1.0).otherwise(0.0))).alias("s_bc"),
        F.avg(s(F.col("interest_rate_pct"))).alias("s_int"),
        F.avg(s(F.col("annual_income"))).alias("s_income"),
        F.avg(s(F.col("debt_to_income_ratio"))).alias("s_dti"),
        F.avg(s(F.col("fico_score_avg"))).alias("s_fico"),
    )
    if medians:
        full = with_medians(agg, cohort.where(seg), [], ["loan_amount", "annual_income"])
    else:
        full = agg.withColumns({"median_loan_amount": F.lit(None).cast("double"),
                                "median_annual_income": F.lit(None).cast("double")})
    c = F.col
    return full.select(
        c("o_n").alias("overall_total_loans"),
        c("o_d").alias("overall_defaulted_loans"),
        rounding(100.0 * c("o_rate"), 4).alias("overall_default_rate_pct"),
        rounding(c("o_amount"), 2).alias("overall_average_loan_amount_usd"),
        rounding(c("o_int"), 4).alias("overall_average_interest_rate_pct"),
        c("s_n").alias("segment_total_loans"),
        rounding(F.try_divide(100.0 * c("s_n"), c("o_n")), 4).alias("segment_portfolio_share_pct"),
        c("s_d").alias("segment_defaulted_loans"),
        rounding(100.0 * c("s_rate"), 4).alias("segment_default_rate_pct"),
        rounding(c("s_amount"), 2).alias("segment_average_loan_amount_usd"),
        rounding(c("median_loan_amount"), 2).alias("segment_median_loan_amount_usd"),
        rounding(100.0 * c("s_bc"), 4).alias("segment_grade_bc_share_pct"),
        rounding(c("s_int"), 4).alias("segment_average_interest_rate_pct"),
        rounding(c("s_income"), 2).alias("segment_average_annual_income_usd"),
        rounding(c("median_annual_income"), 2).alias("segment_median_annual_income_usd"),
        rounding(c("s_dti"), 4).alias("segment_average_dti"),
        rounding(c("s_fico"), 2).alias("segment_average_fico_score"),
    )


def governed_document(flat: DataFrame, segment_name: str = SEGMENT_PURPOSE) -> DataFrame:
    """Nest the flat row as (metric_scope, definitions, overall_portfolio, <segment>)."""
    lit_struct = lambda d: F.struct(*[F.lit(v).alias(k) for k, v in d.items()])
    return flat.select(
        lit_struct(METRIC_SCOPE).alias("metric_scope"),
        lit_struct(DEFINITIONS).alias("definitions"),
        F.struct(*[F.col(f"overall_{k}").alias(k) for k, _ in OVERALL_FIELDS]).alias("overall_portfolio"),
        F.struct(*[F.col(f"segment_{k}").alias(k) for k, _ in SEGMENT_FIELDS]).alias(segment_name),
    )
