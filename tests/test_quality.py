"""Profiles and cross-layer reconciliation on the smallest driver tables."""


from cohortcraft.operators import quality as Q
from cohortcraft.operators import rollup
from cohortcraft.operators.cohort import analysis_cohort
from cohortcraft.operators.typed import TYPED_COLUMNS, typed_contracts
from cohortcraft.sources.contract import contract_raw

SMOKE = "/root/testdata/sf0.001"


def test_layers_reconcile(spark):
    raw = contract_raw(spark, SMOKE)
    typed = typed_contracts(raw)
    assert tuple(typed.columns) == TYPED_COLUMNS
    rec = {r.measure: r.rows for r in Q.layer_reconcile(raw, typed).collect()}
    assert rec["unexplained"] == 0
    assert rec["raw"] == rec["typed"] + sum(v for k, v in rec.items() if k.startswith("rejected_"))
    dist = Q.distribution_reconcile(raw, typed).collect()
    assert sum(r.raw_loans for r in dist) == rec["raw"]
    assert sum(r.typed_loans for r in dist) == rec["typed"]


def test_profiles_and_rules(spark):
    typed = typed_contracts(contract_raw(spark, SMOKE))
    prof = Q.typed_profile(typed).first()
    assert prof.distinct_non_null_loan_ids == prof.row_count and prof.missing_loan_ids == 0
    cohort = analysis_cohort(typed)
    report = Q.rule_report(Q.cohort_profile(cohort), Q.cohort_rules()).collect()
    assert report and all(r.passed for r in report)
    recon = rollup.rollup_reconcile(cohort, {"grade": rollup.grade_rollup(cohort)}).collect()
    assert all(r.difference == 0 for r in recon)


def test_raw_profile_sums(spark):
    raw = contract_raw(spark, SMOKE)
    rows = Q.raw_profile(raw).collect()
    assert sum(r.loans for r in rows) == rows[0].row_count == raw.count()
    assert rows[0].distinct_loan_statuses == len(rows)


def test_distribution_map_and_schema_rows(spark):
    typed = typed_contracts(contract_raw(spark, SMOKE))
    m = Q.distribution_map(Q.status_distribution(typed), "status_group").first().distribution
    assert sum(m.values()) == typed.count()
    assert ("term_months", "smallint", True) in Q.schema_rows(typed)


def test_compare_metrics_tolerances(spark):
    a = spark.createDataFrame([(100, 14.4631, 13189.82, 1.0)], "n long, rate double, amount double, only_a double")
    b = spark.createDataFrame([(100, 14.4632, 13189.90, 2.0)], "n long, rate double, amount double, only_b double")
    got = {r.metric: r.passed for r in Q.compare_metrics(a, b, {"rate": 1e-4 + 1e-12, "amount": 0.05}).collect()}
    assert got == {"n": True, "rate": True, "amount": False, "only_a": False, "only_b": False}
