"""Governed rollups of the cohort: by quarter, by grade, by purpose.

Each rollup is scan -> partial aggregate -> exchange by key -> final
aggregate. Shares of the total use a window over the *aggregated* rows
(one row per group), never over contract rows. Medians come from the
distributed exact-median operator and are joined back by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortcraft.functions.classify import MID_GRADES
from cohortcraft.functions.metrics import indicator, mean, n_rows, pct, rounded, total
from cohortcraft.operators.median import with_medians
from cohortcraft.functions.metrics import round_to


def share_of_total(count_col: str = "total_loans", digits: int = 2) -> Column:
    """``100.0 * n / SUM(n) OVER ()`` over already-aggregated rows."""
    return round_to(F.lit(100.0) * F.col(count_col) / F.sum(count_col).over(Window.partitionBy()), digits)


def _med(name: str, alias: str) -> Column:
    return round_to(F.col(f"median_{name}"), 2).alias(alias)


def _maybe_medians(agg: DataFrame, cohort: DataFrame, keys: list[str], values: list[str], medians: bool) -> DataFrame:
    """Attach exact medians, or NULL median columns when only counts are needed
    (reconciliation), which skips the median stages entirely."""
    if medians:
        return with_medians(agg, cohort, keys, values)
    return agg.withColumns({f"median_{v}": F.lit(None).cast("double") for v in values})


def quarterly_rollup(cohort: DataFrame, medians: bool = True) -> DataFrame:
    """13 columns per origination quarter."""
    de = F.col("is_grade_de")
    flag = F.col("default_flag")
    agg = cohort.groupBy("issue_quarter").agg(
        n_rows().alias("total_loans"),
        total(flag).alias("defaulted_loans"),
        rounded(pct(flag)).alias("default_rate_pct"),
        total(indicator(de)).alias("grade_de_loans"),
        rounded(pct(indicator(de))).alias("grade_de_share_pct"),
        rounded(pct(flag, where=de)).alias("grade_de_default_rate_pct"),
        rounded(pct(flag, where=~de)).alias("other_grades_default_rate_pct"),
        rounded(mean("loan_amount")).alias("average_loan_amount_usd"),
        rounded(mean("interest_rate_pct")).alias("average_interest_rate_pct"),
        rounded(mean("annual_income")).alias("average_annual_income_usd"),
        rounded(mean("fico_score_avg")).alias("average_fico_score"),
    )
    out = _maybe_medians(agg, cohort, ["issue_quarter"], ["loan_amount"], medians)
    return out.select(
        "issue_quarter", "total_loans", "defaulted_loans", "default_rate_pct", "grade_de_loans",
        "grade_de_share_pct", "grade_de_default_rate_pct", "other_grades_default_rate_pct",
        "average_loan_amount_usd", _med("loan_amount", "median_loan_amount_usd"),
        "average_interest_rate_pct", "average_annual_income_usd", "average_fico_score",
    ).orderBy(F.asc_nulls_last("issue_quarter"))


def grade_rollup(cohort: DataFrame, key: str = "grade", medians: bool = True) -> DataFrame:
    """11 columns per grade, with the share of all contracts."""
    flag = F.col("default_flag")
    agg = cohort.groupBy(key).agg(
        n_rows().alias("total_loans"),
        total(flag).alias("defaulted_loans"),
        rounded(pct(flag)).alias("default_rate_pct"),
        rounded(mean("loan_amount")).alias("average_loan_amount_usd"),
        rounded(mean("interest_rate_pct")).alias("average_interest_rate_pct"),
        rounded(mean("annual_income")).alias("average_annual_income_usd"),
        rounded(mean("debt_to_income_ratio")).alias("average_dti"),
        rounded(mean("fico_score_avg")).alias("average_fico_score"),
    )
    out = _maybe_medians(agg, cohort, [key], ["loan_amount"], medians)
    return out.select(
        key, "total_loans", share_of_total().alias("portfolio_share_pct"), "defaulted_loans",
        "default_rate_pct", "average_loan_amount_usd", _med("loan_amount", "median_loan_amount_usd"),
        "average_interest_rate_pct", "average_annual_income_usd", "average_dti", "average_fico_score",
    ).orderBy(F.asc_nulls_last(key))


def purpose_rollup(cohort: DataFrame, medians: bool = True) -> DataFrame:
    """13 columns per purpose, largest first (ties broken by the key)."""
    flag = F.col("default_flag")
    agg = cohort.groupBy("purpose").agg(
        n_rows().alias("total_loans"),
        total(flag).alias("defaulted_loans"),
        rounded(pct(flag)).alias("default_rate_pct"),
        rounded(mean("loan_amount")).alias("average_loan_amount_usd"),
        rounded(pct(indicator(F.col("grade").isin(*MID_GRADES)))).alias("grade_bc_share_pct"),
        rounded(mean("interest_rate_pct")).alias("average_interest_rate_pct"),
        rounded(mean("annual_income")).alias("average_annual_income_usd"),
        rounded(mean("debt_to_income_ratio")).alias("average_dti"),
        rounded(mean("fico_score_avg")).alias("average_fico_score"),
    )
    out = _maybe_medians(agg, cohort, ["purpose"], ["loan_amount", "annual_income"], medians)
    return out.select(
        "purpose", "total_loans", share_of_total().alias("portfolio_share_pct"), "defaulted_loans",
        "default_rate_pct", "average_loan_amount_usd", _med("loan_amount", "median_loan_amount_usd"),
        "grade_bc_share_pct", "average_interest_rate_pct", "average_annual_income_usd",
        _med("annual_income", "median_annual_income_usd"), "average_dti", "average_fico_score",
    ).orderBy(F.desc("total_loans"), F.asc_nulls_last("purpose"))


def rollup_reconcile(cohort: DataFrame, rollups: dict[str, DataFrame]) -> DataFrame:
    """Σ total_loans of each rollup against the cohort row count (long form).

    Rows: (rollup_table, rows, cohort_rows, difference); every difference is 0 when
    the rollups partition the cohort.
    """
    cohort_rows = cohort.agg(n_rows().alias("rows")).withColumn("rollup_table", F.lit("cohort"))
    parts = [cohort_rows.select("rollup_table", "rows")]
    for name, df in rollups.items():
        parts.append(df.agg(F.sum("total_loans").cast("long").alias("rows")).select(F.lit(name).alias("rollup_table"), "rows"))
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    ref = F.max(F.when(F.col("rollup_table") == "cohort", F.col("rows"))).over(Window.partitionBy())
    return stacked.withColumn("cohort_rows", ref).withColumn("difference", F.col("rows") - F.col("cohort_rows"))
