"""Scopes (named contract populations) and the analytical cohort."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortcraft.functions.classify import (
    amount_band,
    dti_band,
    income_band,
    two_way,
)


@dataclass(frozen=True)
class Scope:
    """A population: id, label, Spark SQL predicate, and how to read it."""

    scope_id: str
    label: str
    predicate: str
    resolved_only: bool
    interpretation: str
    years: tuple[int, int] | None = None  # inclusive issue_year bounds implied by the predicate

    def column(self) -> Column:
        return F.expr(self.predicate)

    def prune(self) -> Column | None:
        """The year bounds as a predicate on the partition column (implied, so
        results are unchanged; it lets a year-partitioned layer skip files)."""
        if self.years is None:
            return None
        lo, hi = self.years
        return (F.col("issue_year") >= lo) & (F.col("issue_year") <= hi)


# The reference's four scopes (ids, labels, predicates, notes).
PRIMARY_SCOPE = Scope(
    "primary_gold",
    "2014–2015 originations, 36-month term, resolved loans only",
    "issue_date >= DATE '2014-01-01' AND issue_date < DATE '2016-01-01' "
    "AND term_months = 36 AND is_resolved = TRUE AND default_flag IS NOT NULL",
    True,
    "Official analytical cohort aligned with Gold. Default rates are final observed outcomes.",
    (2014, 2015),
)
SCOPES = (
    PRIMARY_SCOPE,
    Scope(
        "mature_36m_2007_2015",
        "2007–2015 originations, 36-month term, resolved loans only",
        "issue_date >= DATE '2007-01-01' AND issue_date < DATE '2016-01-01' "
        "AND term_months = 36 AND is_resolved = TRUE AND default_flag IS NOT NULL",
        True,
        "Broader mature 36-month window. Default rates are final observed outcomes.",
        (2007, 2015),
    ),
    Scope(
        "mature_60m_2007_2013",
        "2007–2013 originations, 60-month term, resolved loans only",
        "issue_date >= DATE '2007-01-01' AND issue_date < DATE '2014-01-01' "
        "AND term_months = 60 AND is_resolved = TRUE AND default_flag IS NOT NULL",
        True,
        "Mature 60-month window restricted to earlier originations so outcomes are largely known. "
        "Default rates are final observed outcomes.",
        (2007, 2013),
    ),
    Scope(
        "full_snapshot_descriptive",
        "Full Silver snapshot, all terms and statuses (descriptive only)",
        "TRUE",
        False,
        "DESCRIPTIVE ONLY. Includes unresolved/current loans. Reported default percentages are the "
        "default rate among contracts with a known final outcome inside the full snapshot and must "
        "NOT be interpreted as final credit risk over all 2.26M contracts.",
    ),
)

# Cohort projection (34 columns) and the dashboard extract (21 columns).
COHORT_COLUMNS = (
    "loan_id", "record_hash", "issue_date", "issue_year", "issue_quarter", "loan_amount",
    "funded_amount", "term_months", "interest_rate_pct", "installment", "grade", "sub_grade",
    "is_grade_de", "grade_group", "annual_income", "income_band", "debt_to_income_ratio",
    "dti_band", "loan_amount_band", "purpose", "state", "home_ownership", "verification_status",
    "employment_length_years_lower_bound", "fico_score_avg", "credit_history_years",
    "revolving_utilization_pct", "delinquencies_2y", "open_accounts", "total_accounts",
    "mortgage_accounts", "public_record_bankruptcies", "default_flag", "outcome",
)
EXTRACT_COLUMNS = (
    "loan_id", "issue_date", "issue_year", "issue_quarter", "loan_amount", "loan_amount_band",
    "interest_rate_pct", "grade", "sub_grade", "grade_group", "annual_income", "income_band",
    "debt_to_income_ratio", "dti_band", "purpose", "state", "home_ownership",
    "verification_status", "fico_score_avg", "default_flag", "outcome",
)


def apply_scope(typed: DataFrame, scope: Scope = PRIMARY_SCOPE) -> DataFrame:
    """Rows of one scope. Date and term bounds reach the Parquet scan, and the
    implied year bounds prune a year-partitioned layer."""
    prune = scope.prune()
    if prune is not None and "issue_year" in typed.columns:
        typed = typed.where(prune)
    return typed.where(scope.column())


def with_labels(df: DataFrame) -> DataFrame:
    """Grade group, the three bands and the outcome label."""
    return df.withColumns(
        {
            "grade_group": two_way(F.col("is_grade_de"), "Grades D/E", "Other grades"),
            "income_band": income_band("annual_income"),
            "dti_band": dti_band("debt_to_income_ratio"),
            "loan_amount_band": amount_band("loan_amount"),
            "outcome": two_way(F.col("default_flag") == 1, "Defaulted", "Fully paid"),
        }
    )


def analysis_cohort(typed: DataFrame, scope: Scope = PRIMARY_SCOPE) -> DataFrame:
    """The mature cohort with its labels, in the 34-column layout."""
    return with_labels(apply_scope(typed, scope)).select(*COHORT_COLUMNS)


def dashboard_extract(cohort: DataFrame) -> DataFrame:
    """21-column extract, globally ordered by issue date then id text."""
    return cohort.select(*EXTRACT_COLUMNS).orderBy("issue_date", F.col("loan_id").cast("string"))


def tag_scopes(typed: DataFrame, scopes: tuple[Scope, ...], columns: list[str]) -> DataFrame:
    """One row per (contract, matching scope) in a single scan.

    Scopes overlap, so each row carries the array of scope ids whose
    predicate holds and is exploded; only ``columns`` ride along.
    """
    ids = F.array(*[F.when(s.column(), F.lit(s.scope_id)) for s in scopes])
    return typed.select(*columns, F.explode(F.filter(ids, lambda x: x.isNotNull())).alias("scope_id"))


def scope_spine(spark, scopes: tuple[Scope, ...] = SCOPES) -> DataFrame:
    """The scope definitions as a small literal table (bounded by the scope list)."""
    rows = [(i, s.scope_id, s.label, s.resolved_only, s.interpretation) for i, s in enumerate(scopes)]
    return spark.createDataFrame(
        rows, "scope_order int, scope_id string, scope_label string, resolved_only boolean, interpretation string"
    )


# Documented sensitivity checks: the claims re-run on neighbouring windows
# (2013 included; the 60-month book of the cohort years).
SENSITIVITY_SCOPES = (
    Scope(
        "mature_36m_2013_2015",
        "2013–2015 originations, 36-month term, resolved loans only",
        "issue_date >= DATE '2013-01-01' AND issue_date < DATE '2016-01-01' "
        "AND term_months = 36 AND is_resolved = TRUE AND default_flag IS NOT NULL",
        True,
        "Sensitivity: the primary window extended by one earlier vintage.",
        (2013, 2015),
    ),
    Scope(
        "resolved_60m_2014_2015",
        "2014–2015 originations, 60-month term, resolved loans only",
        "issue_date >= DATE '2014-01-01' AND issue_date < DATE '2016-01-01' "
        "AND term_months = 60 AND is_resolved = TRUE AND default_flag IS NOT NULL",
        True,
        "Sensitivity: the other term over the primary window; outcomes may be immature.",
        (2014, 2015),
    ),
)


def segment_scopes(column: str, values: tuple[str, ...]) -> tuple[Scope, ...]:
    """The primary scope restricted to each value of a column (documented sensitivity check)."""
    return tuple(
        Scope(
            f"primary_{column}_{v.lower()}", f"{PRIMARY_SCOPE.label}, {column} {v}", f"{PRIMARY_SCOPE.predicate} AND {column} = '{v}'",
            True, f"Sensitivity: the primary scope within one {column}.", PRIMARY_SCOPE.years,
        )
        for v in values
    )


GRADE_SCOPES = segment_scopes("grade", tuple("ABCDEFG"))
SUBGRADE_SCOPES = segment_scopes("sub_grade", tuple(f"{g}{k}" for g in "ABCDEFG" for k in range(1, 6)))
