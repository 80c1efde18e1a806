"""Claims held as data: a table of any size checked against the metrics of the scopes.

Metrics are unpivoted to one row per (scope, metric), which the scope and metric
definitions bound; claims join them by metric and scope and each row picks its
rule by ``kind``:

* ``percentage``: absolute tolerance (0.25 points unless the claim has its own);
* ``currency``: relative tolerance (1 % unless its own), a zero only equals zero;
* ``direction``: the text must be equal.

A claim without a scope is checked in every scope. A claim whose metric, scope
or kind is unknown stays, with status ``UNKNOWN``; an unusable scope fails its
claims.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortcraft.functions.metrics import round_to
from cohortcraft.operators.claims import (
    CURRENCY_RELATIVE_TOLERANCE, PERCENTAGE_TOLERANCE_PP, SEGMENT_PURPOSE, direction, scope_aggregates,
)
from cohortcraft.operators.cohort import SCOPES, Scope, scope_spine

def _metrics() -> dict[str, Column]:
    """Metric -> value over the scope aggregates."""
    c = F.col
    return {
        "portfolio_share_pct": 100.0 * c("segment_loans") / c("total_loans"),
        "segment_default_rate_pct": 100.0 * c("segment_default_rate"),
        "overall_default_rate_pct": 100.0 * c("overall_default_rate"),
        "average_loan_amount_usd": c("avg_amount"),
        "average_annual_income_usd": c("avg_income"),
        "grade_bc_share_pct": 100.0 * c("bc_share"),
        "average_interest_rate_pct": c("avg_rate"),
    }


def metric_values(typed: DataFrame, scopes: tuple[Scope, ...] = SCOPES, segment: str = SEGMENT_PURPOSE) -> DataFrame:
    """(scope_id, scope_ok, metric, actual_value, actual_text): unrounded metrics, one row per scope and metric."""
    rows = scope_spine(typed.sparkSession, scopes).select("scope_id").join(scope_aggregates(typed, scopes, segment), "scope_id", "left")
    ok = F.coalesce(
        (F.col("total_loans") > 0) & (F.col("segment_loans") > 0) & (F.col("segment_known_outcome_loans") > 0), F.lit(False)
    )
    metrics = _metrics()
    gap = metrics["segment_default_rate_pct"] - metrics["overall_default_rate_pct"]
    nothing = F.lit(None).cast("string")
    entries = [F.struct(F.lit(m).alias("metric"), v.alias("actual_value"), nothing.alias("actual_text")) for m, v in metrics.items()]
    entries.append(
        F.struct(F.lit("segment_vs_overall_direction").alias("metric"), F.lit(None).cast("double").alias("actual_value"),
                 direction(gap).alias("actual_text"))
    )
    return rows.select("scope_id", ok.alias("scope_ok"), F.explode(F.array(*entries)).alias("m")).select("scope_id", "scope_ok", "m.*")


def holds(kind: Column, claimed: Column, actual: Column, tolerance: Column, claimed_text: Column, actual_text: Column) -> Column:
    """Whether a claim holds, by the rule of its kind; NULL for an unknown kind."""
    absolute = F.abs(claimed - actual) <= F.coalesce(tolerance, F.lit(PERCENTAGE_TOLERANCE_PP))
    relative = F.when(actual == 0, claimed == 0).otherwise(
        F.abs(actual - claimed) / F.abs(actual) <= F.coalesce(tolerance, F.lit(CURRENCY_RELATIVE_TOLERANCE))
    )
    checked = (
        F.when(kind == "percentage", absolute).when(kind == "currency", relative).when(kind == "direction", claimed_text == actual_text)
    )
    return F.when(kind.isin("percentage", "currency", "direction"), F.coalesce(checked, F.lit(False)))


def check_claims(claims: DataFrame, values: DataFrame, digits: int = 4) -> DataFrame:
    """One row per claim and scope it applies to: the claim's columns, the actual value and the status.

    ``claims``: claim_id, scope_id (null: every scope), metric, kind,
    claimed_value, claimed_text, tolerance (null: the kind's).
    """
    c, v = claims.alias("c"), values.alias("v")
    applies = (F.col("c.metric") == F.col("v.metric")) & (F.col("c.scope_id").isNull() | (F.col("c.scope_id") == F.col("v.scope_id")))
    kept = holds(
        F.col("c.kind"), F.col("c.claimed_value"), F.col("v.actual_value"), F.col("c.tolerance"), F.col("c.claimed_text"), F.col("v.actual_text")
    )
    status = (
        F.when(F.col("v.metric").isNull() | kept.isNull(), "UNKNOWN").when(F.col("v.scope_ok") & kept, "PASS").otherwise("FAIL")
    )
    return c.join(v, applies, "left").select(
        "c.claim_id", F.coalesce("v.scope_id", "c.scope_id").alias("scope_id"), "c.metric", "c.kind", "c.claimed_value", "c.claimed_text",
        round_to("v.actual_value", digits).alias("actual_value"), "v.actual_text", status.alias("status"),
    )
