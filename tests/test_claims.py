"""Claim rules (tolerances, zero rule, direction), scopes in one pass, verdicts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortcraft.operators import claims as CL
from cohortcraft.operators.cohort import SCOPES, Scope, apply_scope


def test_tolerance_rules(spark):
    df = spark.createDataFrame(
        [(48.25, 48.0, 0.0, 0.0), (48.26, 48.0, 1.0, 0.0), (48.0, 48.0, 101.0, 100.0), (12.3, 12.0, 102.0, 100.0)],
        "c double, a double, cc double, ca double",
    )
    out = df.select(
        CL.status(CL.within_absolute(F.col("c"), F.col("a"))).alias("pct"),
        CL.status(CL.within_relative(F.col("cc"), F.col("ca"))).alias("usd"),
    ).collect()
    assert [r.pct for r in out] == ["PASS", "FAIL", "PASS", "FAIL"]
    assert [r.usd for r in out] == ["PASS", "FAIL", "PASS", "FAIL"]


def test_direction(spark):
    df = spark.createDataFrame([(-0.1,), (0.0,), (0.2,)], "g double")
    assert [r.d for r in df.select(CL.direction(F.col("g")).alias("d")).collect()] == ["below", "equal", "above"]


@pytest.fixture(scope="module")
def typed(spark):
    rows = []
    statuses = ["Fully Paid", "Charged Off", "Current", "Late (16-30 days)"]
    for i in range(400):
        year = 2007 + i % 10
        rows.append((
            str(i), dt.date(year, 1 + i % 12, 1), 36 if i % 4 else 60, statuses[i % 4],
            "debt_consolidation" if i % 3 == 0 else "car", "ABCDE"[i % 5], 1000.0 + i, 50000.0 + 10 * i, 10.0 + i % 7,
        ))
    df = spark.createDataFrame(
        rows, "loan_id string, issue_date date, term_months int, loan_status string, purpose string, grade string, "
        "loan_amount double, annual_income double, interest_rate_pct double")
    from cohortcraft.functions.classify import TAXONOMY
    return df.withColumns(TAXONOMY.columns(F.col("loan_status"))).cache()


def test_single_pass_equals_per_scope_loop(typed):
    one_pass = {r.scope_id: r for r in CL.scope_aggregates(typed).collect()}
    for s in SCOPES:
        sub = apply_scope(typed, s)
        seg = sub.where(F.col("purpose") == "debt_consolidation")
        assert one_pass[s.scope_id].total_loans == sub.count()
        assert one_pass[s.scope_id].segment_loans == seg.count()
        exp = seg.agg(F.avg("loan_amount")).first()[0]
        assert one_pass[s.scope_id].avg_amount == pytest.approx(exp)


def test_scope_metrics_statuses_and_empty_scope(typed):
    empty = Scope("nothing", "no rows", "issue_date < DATE '1900-01-01'", True, "empty on purpose")
    m = {r.scope_id: r for r in CL.scope_metrics(typed, SCOPES + (empty,)).collect()}
    assert m["nothing"].scope_status == "empty_scope" and m["nothing"].total_loans == 0
    assert m["nothing"].claim_direction_status == "FAIL"
    full = m["full_snapshot_descriptive"]
    assert full.scope_status == "ok" and full.unresolved_share_pct > 0
    assert m["primary_gold"].unresolved_share_pct == 0.0
    with pytest.raises(RuntimeError):
        CL.assert_scopes_ok(CL.scope_metrics(typed, SCOPES + (empty,)))


def test_claim_status_verdict_and_reconcile(typed):
    metrics = CL.scope_metrics(typed)
    statuses = CL.claim_status(metrics)
    assert statuses.count() == len(SCOPES) * len(CL.CLAIMS)
    v = {r.scope_id: r for r in CL.claim_verdict(statuses).collect()}
    for r in v.values():
        expected = "BLOCK" if r.failed_critical_claims else ("REVIEW" if r.failed_claims else "PASS")
        assert r.verdict == expected
    checks = CL.scope_reconcile(metrics).where(~F.col("passed")).collect()
    assert checks == []


def test_segment_without_known_outcomes_is_not_ok(spark):
    rows = [("1", dt.date(2012, 1, 1), 36, "Fully Paid", "car", "A", 1.0, 1.0, 10.0),
            ("2", dt.date(2012, 1, 1), 36, "Current", "debt_consolidation", "B", 1.0, 1.0, 10.0)]
    df = spark.createDataFrame(
        rows, "loan_id string, issue_date date, term_months int, loan_status string, purpose string, grade string, "
        "loan_amount double, annual_income double, interest_rate_pct double")
    from cohortcraft.functions.classify import TAXONOMY
    df = df.withColumns(TAXONOMY.columns(F.col("loan_status")))
    full = {r.scope_id: r for r in CL.scope_metrics(df).collect()}["full_snapshot_descriptive"]
    assert full.scope_status == "no_known_segment_outcome"
    assert full.actual_segment_vs_overall_direction is None and full.claim_direction_status == "FAIL"


def test_custom_claim_set(typed):
    mine = (
        ("overall_default_rate_pct", "percentage", 0.0, None),
        ("average_loan_amount_usd", "currency", 1.0, None),
        ("segment_vs_overall_direction", "direction", None, "above"),
    )
    m = CL.scope_metrics(typed, claims=mine)
    assert "claimed_overall_default_rate_pct" in m.columns and "claim_ticket_status" in m.columns
    assert "claim_portfolio_share_status" not in m.columns
    st = CL.claim_status(m, claims=mine, critical=("overall_default_rate_pct",))
    assert st.count() == len(SCOPES) * 3
    assert st.where(F.col("metric") == "average_loan_amount_usd").where(F.col("status") == "PASS").count() == 0
    with pytest.raises(ValueError):
        CL.scope_metrics(typed, claims=(("no_such_metric", "percentage", 1.0, None),))
