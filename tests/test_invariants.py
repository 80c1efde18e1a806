"""Property tests on random contract frames (hypothesis).

Invariants: rollup totals equal the cohort rows; shares sum to 100; the
decomposition parts sum to the total change; the direction agrees with the
sign of the gap; band counts equal the rows; the single-pass scope
aggregate equals a per-scope loop.
"""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortcraft.functions.classify import TAXONOMY
from cohortcraft.operators import claims, rollup, stats
from cohortcraft.operators.cohort import SCOPES, apply_scope, with_labels

STATUSES = ["Fully Paid", "Charged Off", "Current", "In Grace Period", "Default", "Foo"]
row = st.tuples(
    st.integers(2006, 2016),                      # year
    st.integers(1, 12),                           # month
    st.sampled_from([36, 60]),                    # term
    st.sampled_from(STATUSES),
    st.sampled_from(["debt_consolidation", "car", None]),
    st.sampled_from(["A", "B", "C", "D", "E", None]),
    st.one_of(st.none(), st.integers(500, 40000)),  # amount
    st.one_of(st.none(), st.integers(0, 200000)),   # income
    st.one_of(st.none(), st.integers(0, 45)),       # dti
)
SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, rows):
    data = [
        (str(i), dt.date(y, m, 1), t, s, p, g, None if a is None else float(a), None if inc is None else float(inc),
         None if d is None else float(d), 10.0 + i % 5, 700.0)
        for i, (y, m, t, s, p, g, a, inc, d) in enumerate(rows)
    ]
    df = spark.createDataFrame(
        data,
        "loan_id string, issue_date date, term_months int, loan_status string, purpose string, grade string, "
        "loan_amount double, annual_income double, debt_to_income_ratio double, interest_rate_pct double, "
        "fico_score_avg double",
    )
    return df.withColumns(
        {
            **TAXONOMY.columns(F.col("loan_status")),
            "issue_year": F.year("issue_date"),
            "issue_quarter": F.concat(F.year("issue_date").cast("string"), F.lit("-Q"), F.quarter("issue_date").cast("string")),
            "is_grade_de": F.coalesce(F.col("grade").isin("D", "E"), F.lit(False)),
        }
    )


@SETTINGS
@given(st.lists(row, min_size=1, max_size=40))
def test_rollup_totals_and_shares(spark, rows):
    df = with_labels(frame(spark, rows))
    n = len(rows)
    for r in (rollup.grade_rollup(df), rollup.purpose_rollup(df), rollup.quarterly_rollup(df)):
        got = r.collect()
        assert sum(x.total_loans for x in got) == n
        if "portfolio_share_pct" in r.columns:
            assert sum(x.portfolio_share_pct for x in got) == pytest.approx(100.0, abs=0.01 * len(got))
    bands = df.groupBy("income_band", "dti_band", "loan_amount_band").count().agg(F.sum("count")).first()[0]
    assert bands == n


@SETTINGS
@given(st.lists(row, min_size=1, max_size=40))
def test_decomposition_adds_up_and_direction_sign(spark, rows):
    df = frame(spark, rows).where(F.col("default_flag").isNotNull())
    pp = {r.component: r.pp for r in stats.mix_rate_decomposition(df).collect()}
    if all(v is not None for v in pp.values()):
        assert pp["sum_of_effects"] == pytest.approx(pp["total_change"], abs=1e-5)
    for m in claims.scope_metrics(frame(spark, rows)).collect():
        if m.scope_status == "ok":
            gap = m.segment_minus_overall_pp
            assert gap is not None
            d = m.actual_segment_vs_overall_direction
            assert (d == "above") == (gap > 0) or abs(gap) < 1e-4
            assert (d == "below") == (gap < 0) or abs(gap) < 1e-4


@SETTINGS
@given(st.lists(row, min_size=1, max_size=40))
def test_single_pass_scopes_equal_loop(spark, rows):
    df = frame(spark, rows)
    one = {r.scope_id: r for r in claims.scope_aggregates(df).collect()}
    for s in SCOPES:
        sub = apply_scope(df, s)
        n = sub.count()
        if n == 0:
            assert s.scope_id not in one
            continue
        assert one[s.scope_id].total_loans == n
        assert one[s.scope_id].known_outcome_loans == sub.where(F.col("default_flag").isNotNull()).count()
