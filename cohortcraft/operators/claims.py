"""Multi-scope metrics and the validation of claims against them.

Scope metrics come from **one scan**: each contract row is tagged with every
scope whose predicate holds (scopes overlap), exploded, and aggregated by
scope with the segment metrics as conditional aggregates. The aggregate has
one group per scope, so partial aggregation leaves each map task with at
most #scopes rows: no hot key reaches the shuffle. A scope spine keeps a
row for scopes without contracts.

Claims are a small literal table (metric, kind, claimed value/text). Each
claim is compared with its metric: absolute tolerance for percentages,
relative tolerance (with a zero rule) for currency, equality for the
direction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortcraft.functions.classify import MID_GRADES
from cohortcraft.functions.metrics import n_rows, n_where
from cohortcraft.operators.cohort import SCOPES, Scope, scope_spine, tag_scopes
from cohortcraft.functions.metrics import round_to

# Tolerances and the claim set under validation.
PERCENTAGE_TOLERANCE_PP = 0.25
CURRENCY_RELATIVE_TOLERANCE = 0.01
RECONCILE_ABS_TOLERANCE = 1e-6
GOLD_RECONCILE_ABS_PP = 0.01
GOLD_RECONCILE_ABS_USD = 0.05
SEGMENT_PURPOSE = "debt_consolidation"
CLAIMS = (
    ("portfolio_share_pct", "percentage", 48.0, None),
    ("segment_default_rate_pct", "percentage", 12.3, None),
    ("overall_default_rate_pct", "percentage", 14.1, None),
    ("segment_vs_overall_direction", "direction", None, "below"),
    ("average_loan_amount_usd", "currency", 15200.0, None),
    ("average_annual_income_usd", "currency", 72000.0, None),
    ("grade_bc_share_pct", "percentage", 62.0, None),
    ("average_interest_rate_pct", "percentage", 13.8, None),
)
# Claims whose failure blocks an answer (risk direction and default rates).
CRITICAL_CLAIMS = ("segment_vs_overall_direction", "segment_default_rate_pct", "overall_default_rate_pct")
# Column names of the wide output, per claim: (claimed column, status column).
CLAIM_COLUMNS = {
    "portfolio_share_pct": ("claimed_portfolio_share_pct", "claim_portfolio_share_status"),
    "segment_default_rate_pct": ("claimed_segment_default_rate_pct", "claim_segment_default_status"),
    "overall_default_rate_pct": ("claimed_overall_default_rate_pct", "claim_overall_default_status"),
    "segment_vs_overall_direction": ("claimed_segment_vs_overall_direction", "claim_direction_status"),
    "average_loan_amount_usd": ("claimed_average_loan_amount_usd", "claim_ticket_status"),
    "average_annual_income_usd": ("claimed_average_annual_income_usd", "claim_income_status"),
    "grade_bc_share_pct": ("claimed_grade_bc_share_pct", "claim_grade_bc_status"),
    "average_interest_rate_pct": ("claimed_average_interest_rate_pct", "claim_interest_rate_status"),
}
SCOPE_INPUT_COLUMNS = [
    "loan_id", "purpose", "grade", "loan_amount", "annual_income", "interest_rate_pct",
    "default_flag", "is_resolved", "is_current",
]


def within_absolute(claimed: Column, actual: Column, tol: float = PERCENTAGE_TOLERANCE_PP) -> Column:
    return F.abs(claimed - actual) <= F.lit(tol)


def within_relative(claimed: Column, actual: Column, tol: float = CURRENCY_RELATIVE_TOLERANCE) -> Column:
    """|a - c| / |a| <= tol; when the actual is 0 the claim must be 0."""
    return F.when(actual == 0, claimed == 0).otherwise(F.abs(actual - claimed) / F.abs(actual) <= F.lit(tol))


def status(ok: Column) -> Column:
    return F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL"))


def direction(gap: Column) -> Column:
    """below / above / equal; NULL when the gap is unknown."""
    return F.when(gap < 0, "below").when(gap > 0, "above").when(gap == 0, "equal")


def scope_aggregates(typed: DataFrame, scopes: tuple[Scope, ...] = SCOPES, segment: str = SEGMENT_PURPOSE) -> DataFrame:
    """Raw per-scope counts and means from a single scan (unrounded)."""
    tagged = tag_scopes(typed, scopes, SCOPE_INPUT_COLUMNS)
    seg = F.col("purpose") == segment
    flag = F.col("default_flag")

    def seg_avg(c: Column) -> Column:
        return F.avg(F.when(seg, c))

    return tagged.groupBy("scope_id").agg(
        n_rows().alias("total_loans"),
        n_where(~F.col("is_resolved")).alias("unresolved_loans"),
        n_where(F.col("is_current")).alias("current_loans"),
        n_where(flag.isNotNull()).alias("known_outcome_loans"),
        F.avg(flag).alias("overall_default_rate"),
        n_where(seg).alias("segment_loans"),
        n_where(seg & flag.isNotNull()).alias("segment_known_outcome_loans"),
        seg_avg(flag).alias("segment_default_rate"),
        seg_avg(F.col("loan_amount")).alias("avg_amount"),
        seg_avg(F.col("annual_income")).alias("avg_income"),
        seg_avg(F.when(F.col("grade").isin(*MID_GRADES), F.lit(1.0)).otherwise(F.lit(0.0))).alias("bc_share"),
        seg_avg(F.col("interest_rate_pct")).alias("avg_rate"),
    )


Claim = tuple[str, str, float | None, str | None]  # (metric, kind, claimed value, claimed text)


def claim_columns(metric: str) -> tuple[str, str]:
    """(claimed column, status column) of a claim in the wide output."""
    return CLAIM_COLUMNS.get(metric, (f"claimed_{metric}", f"claim_{metric}_status"))


def scope_metrics(typed: DataFrame, scopes: tuple[Scope, ...] = SCOPES, segment: str = SEGMENT_PURPOSE,
                  claims: tuple[Claim, ...] = CLAIMS, aggregates: DataFrame | None = None) -> DataFrame:
    """One row per scope: identity, counts, rounded metrics, claims and statuses.

    ``aggregates`` are the scopes' raw counts and means where they are known
    already (``scope_cube``); otherwise one scan of ``typed`` gives them.

    ``scope_status`` is ``ok``, ``empty_scope``, ``empty_segment``,
    ``no_known_outcome`` or ``no_known_segment_outcome``; metrics of a non-ok
    scope are NULL and its claims FAIL. Use :func:`assert_scopes_ok` to turn a bad status into an error.
    """
    spark = typed.sparkSession
    agg = scope_aggregates(typed, scopes, segment) if aggregates is None else aggregates
    j = scope_spine(spark, scopes).join(agg, "scope_id", "left")
    col = F.col
    total = F.coalesce(col("total_loans"), F.lit(0))
    seg_n = F.coalesce(col("segment_loans"), F.lit(0))
    known = F.coalesce(col("known_outcome_loans"), F.lit(0))
    seg_known = F.coalesce(col("segment_known_outcome_loans"), F.lit(0))
    scope_status = (
        F.when(total == 0, "empty_scope").when(seg_n == 0, "empty_segment").when(known == 0, "no_known_outcome")
        .when(seg_known == 0, "no_known_segment_outcome")
        .otherwise("ok")
    )
    ok = scope_status == "ok"
    share = 100.0 * seg_n / total
    overall_pct = 100.0 * col("overall_default_rate")
    seg_pct = 100.0 * col("segment_default_rate")
    gap = seg_pct - overall_pct
    metrics = {
        "portfolio_share_pct": share,
        "segment_default_rate_pct": seg_pct,
        "overall_default_rate_pct": overall_pct,
        "average_loan_amount_usd": col("avg_amount"),
        "average_annual_income_usd": col("avg_income"),
        "grade_bc_share_pct": 100.0 * col("bc_share"),
        "average_interest_rate_pct": col("avg_rate"),
    }
    digits = {"average_loan_amount_usd": 2, "average_annual_income_usd": 2}
    out = [
        "scope_order", "scope_id", "scope_label", "resolved_only", "interpretation",
        F.lit("known_final_outcome_only").alias("default_rate_basis"),
        scope_status.alias("scope_status"),
        total.alias("total_loans"),
        seg_n.alias("debt_consolidation_loans"),
        known.alias("known_outcome_loans"),
        F.coalesce(col("unresolved_loans"), F.lit(0)).alias("unresolved_loans"),
        F.coalesce(col("current_loans"), F.lit(0)).alias("current_loans"),
    ]
    for name in ("portfolio_share_pct", "segment_default_rate_pct", "overall_default_rate_pct"):
        out.append(F.when(ok, round_to(metrics[name], 4)).alias(name))
    out.append(F.when(ok, round_to(gap, 4)).alias("segment_minus_overall_pp"))
    for name in ("average_loan_amount_usd", "average_annual_income_usd", "grade_bc_share_pct",
                 "average_interest_rate_pct"):
        out.append(F.when(ok, round_to(metrics[name], digits.get(name, 4))).alias(name))
    out += [
        F.when(ok, round_to(100.0 * F.coalesce(col("unresolved_loans"), F.lit(0)) / total, 4)).alias("unresolved_share_pct"),
        F.when(ok, round_to(100.0 * F.coalesce(col("current_loans"), F.lit(0)) / total, 4)).alias("current_share_pct"),
    ]
    actual_direction = F.when(ok, direction(gap))
    out.append(actual_direction.alias("actual_segment_vs_overall_direction"))
    for metric, kind, value, text in claims:
        claimed_col, status_col = claim_columns(metric)
        if kind == "direction":
            if metric != "segment_vs_overall_direction":
                raise ValueError(f"unknown directional claim {metric!r}")
            out.append(F.lit(text).alias(claimed_col))
            out.append(status(ok & F.coalesce(actual_direction == F.lit(text), F.lit(False))).alias(status_col))
            continue
        if metric not in metrics:
            raise ValueError(f"unknown metric {metric!r}; known: {sorted(metrics)}")
        if kind not in ("percentage", "currency"):
            raise ValueError(f"unknown claim kind {kind!r}")
        claimed = F.lit(float(value))
        check = within_absolute if kind == "percentage" else within_relative
        out.append(claimed.alias(claimed_col))
        out.append(status(ok & F.coalesce(check(claimed, metrics[metric]), F.lit(False))).alias(status_col))
    return j.select(*out).orderBy("scope_order")


def assert_scopes_ok(metrics: DataFrame) -> None:
    """Raise when any scope is empty (collects one small row per bad scope)."""
    bad = metrics.where(F.col("scope_status") != "ok").select("scope_id", "scope_status").collect()
    if bad:
        raise RuntimeError("; ".join(f"{r.scope_id}: {r.scope_status}" for r in bad))


def claims_table(spark: SparkSession, claims: tuple[Claim, ...] = CLAIMS,
                 critical: tuple[str, ...] = CRITICAL_CLAIMS) -> DataFrame:
    """The claim set as a literal table (bounded: one row per claim)."""
    rows = [(i, m, k, None if v is None else float(v), t, m in critical) for i, (m, k, v, t) in enumerate(claims)]
    return spark.createDataFrame(
        rows, "claim_order int, metric string, kind string, claimed_value double, claimed_text string, critical boolean"
    )


def claim_status(metrics: DataFrame, claims: tuple[Claim, ...] = CLAIMS,
                 critical: tuple[str, ...] = CRITICAL_CLAIMS) -> DataFrame:
    """Long form: one row per (scope, claim) with the actual value and the status.

    The unrounded inputs are recomputed from the rounded scope row only for
    display; statuses are taken from the scope row, which decided them on
    unrounded values.
    """
    spark = metrics.sparkSession
    value_cols = [m for m, k, _, _ in claims if k != "direction"]
    stacked = metrics.select(
        "scope_order", "scope_id", "scope_status",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(m).alias("metric"),
                        (F.col(m) if m in value_cols else F.lit(None).cast("double")).alias("actual_value"),
                        (F.col("actual_segment_vs_overall_direction") if m not in value_cols
                         else F.lit(None).cast("string")).alias("actual_text"),
                        F.col(claim_columns(m)[1]).alias("status"),
                    )
                    for m, _, _, _ in claims
                ]
            )
        ).alias("c"),
    ).select("scope_order", "scope_id", "scope_status", "c.*")
    table = F.broadcast(claims_table(spark, claims, critical))  # bounded by the claim list
    return stacked.join(table, "metric", "inner").select(
        "scope_order", "scope_id", "scope_status", "claim_order", "metric", "kind", "critical", "claimed_value",
        "claimed_text", "actual_value", "actual_text", "status",
    )


def claim_verdict(statuses: DataFrame) -> DataFrame:
    """Verdict per scope: BLOCK / REVIEW / PASS.

    BLOCK when the scope is missing or empty, or a critical claim (risk
    direction, default rates) fails; REVIEW when only non-critical claims
    fail; PASS otherwise.
    """
    failed = F.col("status") == "FAIL"
    g = statuses.groupBy("scope_id").agg(
        F.count(F.lit(1)).alias("claims"),
        n_where(failed).alias("failed_claims"),
        n_where(failed & F.col("critical")).alias("failed_critical_claims"),
        F.bool_or(F.col("scope_status") != "ok").alias("scope_missing"),
    )
    verdict = (
        F.when(F.col("scope_missing") | (F.col("failed_critical_claims") > 0), "BLOCK")
        .when(F.col("failed_claims") > 0, "REVIEW")
        .otherwise("PASS")
    )
    return g.withColumn("verdict", verdict)


def scope_reconcile(metrics: DataFrame, governed: DataFrame | None = None, primary: str = "primary_gold") -> DataFrame:
    """Internal-consistency rules per scope, and primary scope vs governed metrics.

    Long form (scope_id, check, passed). ``governed`` is the flat governed
    metrics row; when given, nine primary-scope checks are added.
    """
    col = F.col
    ok = col("scope_status") == "ok"
    checks = {
        "segment_within_total": col("debt_consolidation_loans") <= col("total_loans"),
        "share_reconciles": F.abs(100.0 * col("debt_consolidation_loans") / col("total_loans")
                                  - col("portfolio_share_pct")) <= 0.01,
        "gap_reconciles": F.abs(col("segment_default_rate_pct") - col("overall_default_rate_pct")
                                - col("segment_minus_overall_pp")) <= RECONCILE_ABS_TOLERANCE + 0.0001,
        "shares_in_range": F.greatest(*[col(c) for c in _SHARE_COLS]) <= 100.0,
        "shares_non_negative": F.least(*[col(c) for c in _SHARE_COLS]) >= 0.0,
        "resolved_scope_has_no_unresolved": ~col("resolved_only") | (col("unresolved_share_pct") <= 0.0),
        "snapshot_has_unresolved": col("resolved_only") | (col("unresolved_share_pct") > 0.0),
        "direction_matches_gap": F.when(col("actual_segment_vs_overall_direction") == "above", col("segment_minus_overall_pp") > 0)
        .when(col("actual_segment_vs_overall_direction") == "below", col("segment_minus_overall_pp") < 0)
        .otherwise(F.abs(col("segment_minus_overall_pp")) < 1e-9),
    }
    rows = metrics.select(
        "scope_id",
        F.explode(F.array(*[F.struct(F.lit(k).alias("check"), F.coalesce(ok & v, F.lit(False)).alias("passed"))
                            for k, v in checks.items()])).alias("c"),
    ).select("scope_id", "c.*")
    if governed is None:
        return rows
    pairs = (
        ("total_loans", "overall_total_loans", 0.0),
        ("debt_consolidation_loans", "segment_total_loans", 0.0),
        ("portfolio_share_pct", "segment_portfolio_share_pct", GOLD_RECONCILE_ABS_PP),
        ("segment_default_rate_pct", "segment_default_rate_pct", GOLD_RECONCILE_ABS_PP),
        ("overall_default_rate_pct", "overall_default_rate_pct", GOLD_RECONCILE_ABS_PP),
        ("average_loan_amount_usd", "segment_average_loan_amount_usd", GOLD_RECONCILE_ABS_USD),
        ("average_annual_income_usd", "segment_average_annual_income_usd", GOLD_RECONCILE_ABS_USD),
        ("grade_bc_share_pct", "segment_grade_bc_share_pct", GOLD_RECONCILE_ABS_PP),
        ("average_interest_rate_pct", "segment_average_interest_rate_pct", GOLD_RECONCILE_ABS_PP),
    )
    prim = metrics.where(col("scope_id") == primary).select(
        "scope_id", *[col(a).cast("double").alias(f"_s_{a}") for a, _, _ in pairs]
    )
    gov = governed.select(*[col(b).cast("double").alias(f"_g_{b}") for _, b, _ in pairs]).withColumn("scope_id", F.lit(primary))
    both = prim.join(gov, "scope_id", "inner")  # one row each, keyed by the scope id
    gold = both.select(
        "scope_id",
        F.explode(F.array(*[
            F.struct(F.lit(f"gold_{a}").alias("check"),
                     F.coalesce(F.abs(col(f"_s_{a}") - col(f"_g_{b}")) <= tol, F.lit(False)).alias("passed"))
            for a, b, tol in pairs
        ])).alias("c"),
    ).select("scope_id", "c.*")
    return rows.unionByName(gold)


_SHARE_COLS = (
    "portfolio_share_pct", "segment_default_rate_pct", "overall_default_rate_pct", "grade_bc_share_pct",
    "unresolved_share_pct", "current_share_pct",
)
