"""Logistic vintage model: Spark GLM against closed form and a NumPy Newton fit."""

import math

import numpy as np
import pytest

from cohortcraft.operators.model import SeparationError, binary_logit, cells, fit_logit, odds_ratio_row


def newton_logit(X, y, iters=50):
    beta = np.zeros(X.shape[1])
    for _ in range(iters):
        p = 1 / (1 + np.exp(-X @ beta))
        W = p * (1 - p)
        H = X.T @ (X * W[:, None])
        beta = beta + np.linalg.solve(H, X.T @ (y - p))
    p = 1 / (1 + np.exp(-X @ beta))
    cov = np.linalg.inv(X.T @ (X * (p * (1 - p))[:, None]))
    return beta, np.sqrt(np.diag(cov))


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(11)
    n = 4000
    late = rng.integers(0, 2, n).astype(float)
    grade = rng.choice(list("ABCD"), n)
    dti = rng.uniform(0, 40, n)
    logit = -2.0 + 0.3 * late + np.array([{"A": 0, "B": 0.4, "C": 0.9, "D": 1.5}[g] for g in grade]) + 0.02 * dti
    y = (rng.uniform(size=n) < 1 / (1 + np.exp(-logit))).astype(float)
    rows = [(float(a), float(b), str(c), float(d)) for a, b, c, d in zip(y, late, grade, dti)]
    pdf = spark.createDataFrame(rows, "default_flag double, late double, grade string, debt_to_income_ratio double")
    return pdf, (y, late, grade, dti)


def test_single_predictor_closed_form(frame):
    df, (y, late, _, _) = frame
    fit = fit_logit(df, ("late",))
    row = odds_ratio_row(fit, "late_only")
    a = np.sum((late == 1) & (y == 1)); b = np.sum((late == 1) & (y == 0))
    c = np.sum((late == 0) & (y == 1)); d = np.sum((late == 0) & (y == 0))
    assert row["odds_ratio"] == pytest.approx(a * d / (b * c), rel=1e-8)
    assert row["std_error"] == pytest.approx(math.sqrt(1 / a + 1 / b + 1 / c + 1 / d), rel=1e-6)
    assert row["n_obs"] == len(y)


def test_grade_dummies_reference_level_and_newton(frame):
    df, (y, late, grade, dti) = frame
    fit = fit_logit(df, ("late", "grade", "debt_to_income_ratio"))
    assert not any(n.endswith("_A") for n in fit["names"])  # 'A' is the dropped reference level
    cols = [np.ones_like(y), late] + [(grade == g).astype(float) for g in "BCD"] + [dti]
    beta, se = newton_logit(np.column_stack(cols), y)
    i_late = fit["names"].index("late")
    assert fit["coefficients"][i_late] == pytest.approx(beta[1], rel=1e-6)
    assert fit["std_errors"][i_late] == pytest.approx(se[1], rel=1e-5)
    assert fit["intercept"] == pytest.approx(beta[0], rel=1e-6)
    row = odds_ratio_row(fit, "m")
    assert 0.0 < row["pseudo_r2"] < 1.0 and row["or_ci95_low"] < row["odds_ratio"] < row["or_ci95_high"]


# Outcome shares per (late, grade): the base rate and what grade and period add.
def grouped(base, trials, interaction=0.2):
    rng = np.random.default_rng(5)
    rows = []
    for late in (0.0, 1.0):
        for k, grade in enumerate("ABCDEFG"):
            n = int(trials * (1 + 3 * rng.uniform()) / (1 + k))
            eta = math.log(base / (1 - base)) + 0.25 * late + 0.3 * k + interaction * late * (k == 3)
            rows.append((late, grade, float(max(1, round(n / (1 + math.exp(-eta))))), float(n)))
    return rows


def newton_cells(rows):
    """Newton on the binomial likelihood of the cells: equal to the row-level likelihood."""
    levels = sorted({g for _, g, _, _ in rows})[1:]
    X = np.array([[1.0, late, *(float(g == x) for x in levels)] for late, g, _, _ in rows])
    s, n = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    beta = np.zeros(X.shape[1])
    beta[0] = math.log(s.sum() / (n.sum() - s.sum()))
    for _ in range(100):
        p = 1 / (1 + np.exp(-X @ beta))
        beta = beta + np.linalg.solve(X.T @ (X * (n * p * (1 - p))[:, None]), X.T @ (s - n * p))
    p = 1 / (1 + np.exp(-X @ beta))
    ll = (s * np.log(p) + (n - s) * np.log1p(-p)).sum()
    r = s.sum() / n.sum()
    null = s.sum() * math.log(r) + (n.sum() - s.sum()) * math.log1p(-r)
    return beta, np.sqrt(np.diag(np.linalg.inv(X.T @ (X * (n * p * (1 - p))[:, None])))), 1 - ll / null


@pytest.mark.parametrize("base", [0.01, 0.14, 0.5])
@pytest.mark.parametrize("trials", [2_000, 1_000_000_000])
def test_cells_against_newton(spark, base, trials):
    rows = grouped(base, trials)
    table = spark.createDataFrame(rows, "late double, grade string, successes double, trials double")
    table = table.selectExpr("*", "successes / trials AS default_flag")
    fit = fit_logit(table, ("late", "grade"), weight="trials")
    beta, errors, r2 = newton_cells(rows)
    row = odds_ratio_row(fit, "m")
    assert fit["intercept"] == pytest.approx(beta[0], abs=1e-6)
    assert row["coefficient"] == pytest.approx(beta[1], abs=1e-6)
    assert row["std_error"] == pytest.approx(errors[1], rel=1e-5)
    assert row["pseudo_r2"] == pytest.approx(r2, abs=1e-6)
    assert row["n_obs"] == sum(int(r[3]) for r in rows)


@pytest.mark.parametrize("base", [0.01, 0.14, 0.5])
def test_cells_equal_rows(spark, base):
    rng = np.random.default_rng(3)
    n = 6000
    late, k = rng.integers(0, 2, n), rng.integers(0, 3, n)
    p = 1 / (1 + np.exp(-(math.log(base / (1 - base)) + 0.5 * late + 0.3 * k)))
    y = (rng.uniform(size=n) < p).astype(float)
    frame = spark.createDataFrame(
        [(float(a), float(b), "ABC"[c]) for a, b, c in zip(y, late, k, strict=True)], "default_flag double, late double, grade string"
    )
    whole, grouped_ = fit_logit(frame, ("late", "grade")), fit_logit(cells(frame, ("late", "grade")), ("late", "grade"), weight="trials")
    assert grouped_["names"] == whole["names"]
    assert grouped_["coefficients"] == pytest.approx(whole["coefficients"], abs=1e-6)
    assert grouped_["std_errors"] == pytest.approx(whole["std_errors"], rel=1e-5)
    assert grouped_["deviance"] == pytest.approx(whole["deviance"], rel=1e-9)
    assert grouped_["null_deviance"] == pytest.approx(whole["null_deviance"], rel=1e-9)


def test_unbalanced_two_by_two(spark):
    counts = {(1, 1): 80, (1, 0): 600, (0, 1): 120, (0, 0): 700}
    df = spark.createDataFrame([(q, t) for (q, t), n in counts.items() for _ in range(n)], "quality int, toxic int")
    row = binary_logit(df, "toxic", "quality", "m").first()
    assert row["odds_ratio"] == round(80 * 700 / (600 * 120), 4)
    assert row["std_error"] == round(math.sqrt(sum(1 / n for n in counts.values())), 4)


def test_separated_outcomes_are_reported(spark):
    rows = [(0.0, "A", 0.0, 50.0), (0.0, "B", 10.0, 50.0), (1.0, "A", 0.0, 40.0), (1.0, "B", 12.0, 40.0)]
    table = spark.createDataFrame(rows, "late double, grade string, successes double, trials double")
    with pytest.raises(SeparationError, match="grade=A"):
        fit_logit(table.selectExpr("*", "successes / trials AS default_flag"), ("late", "grade"), weight="trials")
    # no single level is degenerate, but together the terms split the outcomes
    rows = [(0.0, "A", 5.0, 50.0), (0.0, "B", 50.0, 50.0), (1.0, "A", 0.0, 40.0), (1.0, "B", 12.0, 40.0)]
    table = spark.createDataFrame(rows, "late double, grade string, successes double, trials double")
    with pytest.raises((SeparationError, RuntimeError)):
        fit_logit(table.selectExpr("*", "successes / trials AS default_flag"), ("late", "grade"), weight="trials")
