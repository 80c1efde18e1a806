"""Logistic vintage model (later period vs earlier) with Spark ML.

``default_flag ~ late + C(grade) [+ controls]`` is fitted by
``GeneralizedLinearRegression(family='binomial', link='logit')`` (IRLS:
each iteration is one distributed pass that builds the small normal
equations). Categorical grades use treatment coding with 'A' as the
reference level (``stringIndexerOrderType='alphabetDesc'`` makes RFormula
drop 'A'). The summary's standard errors list the intercept last.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.ml.feature import RFormula
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortcraft.operators.stats import LATE, p_value, with_period
from cohortcraft.functions.metrics import round_to

# Notebook model specifications and the Wald multiplier.
BASIC_TERMS = ("late", "grade")
FULL_TERMS = ("late", "grade", "debt_to_income_ratio", "fico_score_avg", "log_income", "interest_rate_pct")
COMPLETE_CASES = ("default_flag", "debt_to_income_ratio", "fico_score_avg", "annual_income", "interest_rate_pct", "grade")
WALD_Z = 1.96


def model_frame(cohort: DataFrame) -> DataFrame:
    """Complete cases, the ``late`` indicator and log income."""
    p = with_period(cohort).na.drop(subset=list(COMPLETE_CASES))
    return p.select(
        F.col("default_flag").cast("double").alias("default_flag"),
        (F.col("period") == LATE).cast("double").alias("late"),
        "grade", "debt_to_income_ratio", "fico_score_avg", "interest_rate_pct",
        F.log1p("annual_income").alias("log_income"),
    )


TOLERANCE, MAX_ITERATIONS = 1e-8, 50
MAX_STD_ERROR = 30.0
"""Wald errors of categorical terms beyond this mean that the likelihood has no maximum.

Every level has an event of each outcome, which alone keeps its error near 1;
collinear continuous terms may have larger ones, so they are not judged by it.
"""


class SeparationError(ValueError):
    """The terms split the outcomes perfectly, so an odds ratio would be infinite."""


def cells(frame: DataFrame, terms: tuple[str, ...], label: str = "default_flag") -> DataFrame:
    """One row per combination of categorical terms: share of successes and number of trials.

    The likelihood of a model without continuous terms depends on these
    counts alone, so the fit runs over a handful of rows. The share is the
    response and the trials are its weight; 0/1 rows weighted by their counts
    would start the iteration at fitted values of 0 and 1.
    """
    grouped = frame.groupBy(*terms).agg(F.sum(label).alias("successes"), F.count("*").cast("double").alias("trials"))
    return grouped.withColumn(label, F.col("successes") / F.col("trials"))


def _degenerate_levels(cells_: DataFrame, terms: tuple[str, ...]) -> list[str]:
    """``term=level`` whose outcomes are all equal, over the cells (each term's levels are few)."""
    out = []
    for t in terms:
        rows = cells_.groupBy(t).agg(F.sum("successes").alias("s"), F.sum("trials").alias("n"))
        out += [f"{t}={r[t]}" for r in rows.where("s <= 0 or s >= n").collect()]
    return out


def _cell_deviances(cells_: DataFrame, fit: dict) -> tuple[float, float]:
    """-2 log-likelihood of the 0/1 outcomes behind the cells: fitted model and constant model."""
    p, s, n = fitted_probability(fit), F.col("successes"), F.col("trials")
    # xlogy: a cell without successes (or failures) adds nothing for them
    part = lambda count, chance: F.when(count > 0, count * F.log(chance)).otherwise(0.0)
    row = cells_.agg(
        F.sum(part(s, p) + part(n - s, 1.0 - p)).alias("ll"), F.sum(s).alias("s"), F.sum(n).alias("n")
    ).first()
    rate = row["s"] / row["n"]
    null = row["s"] * math.log(rate) + (row["n"] - row["s"]) * math.log1p(-rate)
    return -2.0 * row["ll"], -2.0 * null


def fit_logit(frame: DataFrame, terms: tuple[str, ...], label: str = "default_flag", weight: str | None = None) -> dict:
    """Fit the GLM; returns coefficients (in the terms' own units) and fit stats.

    ``frame`` holds 0/1 outcomes, or, with ``weight="trials"``, the table of
    ``cells``. Continuous terms are standardised first, which lets the
    iteration reach ``TOLERANCE`` in few passes. Raises ``SeparationError``
    where the likelihood has no maximum and ``RuntimeError`` where the
    iteration does not converge. Deviances are those of the 0/1 outcomes in
    both forms.
    """
    kinds = dict(frame.dtypes)
    if weight:
        degenerate = _degenerate_levels(frame, terms)
        if degenerate:
            raise SeparationError(f"all outcomes are equal for {', '.join(degenerate)}")
    numeric = [t for t in terms if kinds[t] == "double"]
    moments = frame.agg(
        *(F.avg(t).alias(f"m_{t}") for t in numeric), *(F.stddev_pop(t).alias(f"s_{t}") for t in numeric),
        (F.sum(weight) if weight else F.count("*")).alias("n"),
    ).first()
    wide = [t for t in numeric if t not in BASIC_TERMS and moments[f"s_{t}"]] if weight is None else []
    scaled = frame.withColumns({t: (F.col(t) - moments[f"m_{t}"]) / moments[f"s_{t}"] for t in wide})
    formula = RFormula(
        formula=f"{label} ~ " + " + ".join(terms),
        featuresCol="features",
        labelCol="label",
        stringIndexerOrderType="alphabetDesc",
    )
    features = formula.fit(scaled).transform(scaled).select("features", "label", *([weight] if weight else []))
    features = features.persist(StorageLevel.MEMORY_AND_DISK)  # every iteration reads it
    try:
        glm = GeneralizedLinearRegression(
            family="binomial", link="logit", regParam=0.0, maxIter=MAX_ITERATIONS, tol=TOLERANCE, featuresCol="features",
            labelCol="label",
        )
        model = (glm.setWeightCol(weight) if weight else glm).fit(features)
        summary = model.summary
        if summary.numIterations >= MAX_ITERATIONS:
            raise RuntimeError(f"the fit of {terms} did not converge in {MAX_ITERATIONS} iterations")
        names = [a["name"] for a in sorted(_attrs(features.schema["features"].metadata), key=lambda a: a["idx"])]
        raw = dict(zip(names, model.coefficients, strict=True))
        errors = list(summary.coefficientStandardErrors)
        if weight and not all(e < MAX_STD_ERROR for e in errors):
            raise SeparationError(f"the outcomes are separated by {terms}: standard errors {errors}")
        unit = {t: moments[f"s_{t}"] for t in wide}
        fit = {
            "coefficients": [raw[n] / unit.get(n, 1.0) for n in names],
            "intercept": model.intercept - sum(raw[t] * moments[f"m_{t}"] / unit[t] for t in wide),
            "std_errors": [e / unit.get(n, 1.0) for n, e in zip(names, errors, strict=False)] + errors[len(names):],
            "n_obs": int(round(moments["n"])),
            "names": names,
        }
        fit["deviance"], fit["null_deviance"] = (
            _cell_deviances(frame, fit) if weight else (summary.deviance, summary.nullDeviance)
        )
        return fit
    finally:
        features.unpersist()


def fitted_probability(fit: dict) -> Column:
    """The model's probability for a row of its frame."""
    margin = F.lit(float(fit["intercept"]))
    for name, c in zip(fit["names"], fit["coefficients"], strict=True):
        if name.startswith("grade_"):
            margin = margin + F.when(F.col("grade") == name.removeprefix("grade_"), float(c)).otherwise(0.0)
        else:
            margin = margin + float(c) * F.col(name)
    return 1.0 / (1.0 + F.exp(-margin))


def _attrs(meta: dict) -> list[dict]:
    groups = meta.get("ml_attr", {}).get("attrs", {})
    return [a for kind in groups.values() for a in kind]


def odds_ratio_row(fit: dict, model_label: str, term: str = "late") -> dict:
    """Odds ratio of ``term`` with its Wald 95 % interval, p-value and fit stats."""
    idx = fit["names"].index(term)
    coef = float(fit["coefficients"][idx])
    se = float(fit["std_errors"][idx])
    z = coef / se
    p = p_value(z, "two-sided")
    return {
        "model": model_label,
        "coefficient": coef,
        "std_error": se,
        "odds_ratio": math.exp(coef),
        "or_ci95_low": math.exp(coef - WALD_Z * se),
        "or_ci95_high": math.exp(coef + WALD_Z * se),
        "z_stat": z,
        "p_value": p,
        "p_value_display": f"{p:.2e}",
        "pseudo_r2": float(1.0 - fit["deviance"] / fit["null_deviance"]),
        "n_obs": int(fit["n_obs"]),
    }


RESULT_SCHEMA = (
    "model string, coefficient double, std_error double, odds_ratio double, or_ci95_low double, "
    "or_ci95_high double, z_stat double, p_value double, p_value_display string, pseudo_r2 double, n_obs long"
)


def _fits(frame: DataFrame, models: dict[str, tuple[str, ...]]) -> dict[str, dict]:
    """Each model fitted: over cells when it has no continuous term, else over the rows."""
    out = {}
    for name, terms in models.items():
        if set(terms) <= set(BASIC_TERMS):
            few = cells(frame, terms).coalesce(1).persist()  # a row per cell, read by every pass of the fit
            try:
                out[name] = fit_logit(few, terms, weight="trials")
            finally:
                few.unpersist()
        else:
            out[name] = fit_logit(frame, terms)
    return out


MODELS = {"grade_only": BASIC_TERMS, "grade_and_controls": FULL_TERMS}


def vintage_logit(cohort: DataFrame, models: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """One row per model: the vintage odds ratio and fit statistics.

    Runs the fits (actions) and returns a result-sized DataFrame.
    """
    frame = model_frame(cohort)
    rows = [odds_ratio_row(fit, label) for label, fit in _fits(frame, models or MODELS).items()]
    return cohort.sparkSession.createDataFrame(
        [tuple(r[k] for k in ("model", "coefficient", "std_error", "odds_ratio", "or_ci95_low", "or_ci95_high",
                              "z_stat", "p_value", "p_value_display", "pseudo_r2", "n_obs")) for r in rows],
        RESULT_SCHEMA,
    )


def fitted_totals(cohort: DataFrame, models: dict[str, tuple[str, ...]] | None = None, digits: int = 2) -> DataFrame:
    """(model, term, level, total): fitted defaults per period and grade, and fitted covariate sums.

    At the maximum of the likelihood these equal the observed totals, term by
    term, so a wrong fit of any coefficient shows here.
    """
    frame = model_frame(cohort)
    out = None
    for name, terms in _fits_terms(frame, models or MODELS):
        fit, used = terms
        rows = frame.withColumn("_p", fitted_probability(fit))
        continuous = [t for t in used if t not in BASIC_TERMS]
        sums = rows.groupBy("late", "grade").agg(F.sum("_p").alias("_p"), *(F.sum(F.col("_p") * F.col(t)).alias(t) for t in continuous))
        parts = [
            sums.groupBy(F.lit("late").alias("term"), F.col("late").cast("int").cast("string").alias("level")).agg(F.sum("_p").alias("total")),
            sums.groupBy(F.lit("grade").alias("term"), F.col("grade").alias("level")).agg(F.sum("_p").alias("total")),
            *(sums.groupBy(F.lit(t).alias("term"), F.lit("all").alias("level")).agg(F.sum(t).alias("total")) for t in continuous),
        ]
        for part in parts:
            row = part.select(F.lit(name).alias("model"), "term", "level", round_to("total", digits).alias("total"))
            out = row if out is None else out.unionByName(row)
    return out


def _fits_terms(frame: DataFrame, models: dict[str, tuple[str, ...]]):
    fits = _fits(frame, models)
    return [(name, (fits[name], terms)) for name, terms in models.items()]


def rounded_single_predictor(cohort: DataFrame, digits: int = 4) -> DataFrame:
    """``default_flag ~ late`` fitted by the GLM, rounded for comparison."""
    df = vintage_logit(cohort, {"late_only": ("late",)})
    return df.select(
        "model",
        round_to("odds_ratio", digits).alias("odds_ratio"),
        round_to("or_ci95_low", digits).alias("or_ci95_low"),
        round_to("or_ci95_high", digits).alias("or_ci95_high"),
        round_to("std_error", digits).alias("std_error"),
        round_to("pseudo_r2", 6).alias("pseudo_r2"),
        "n_obs",
    )


def binary_logit(df: DataFrame, label: str, predictor: str, model_label: str, digits: int = 4) -> DataFrame:
    """``label ~ predictor`` for a 0/1 predictor on any table: odds ratio, Wald CI, SE, fit."""
    frame = df.where(F.col(label).isNotNull() & F.col(predictor).isNotNull()).select(
        F.col(label).cast("double").alias(label), F.col(predictor).cast("double").alias(predictor)
    )
    fit = fit_logit(cells(frame, (predictor,), label), (predictor,), label=label, weight="trials")
    row = odds_ratio_row(fit, model_label, term=predictor)
    out = df.sparkSession.createDataFrame([tuple(row[k] for k in ("model", "coefficient", "std_error", "odds_ratio",
        "or_ci95_low", "or_ci95_high", "z_stat", "p_value", "p_value_display", "pseudo_r2", "n_obs"))], RESULT_SCHEMA)
    return out.select(
        "model",
        round_to("odds_ratio", digits).alias("odds_ratio"),
        round_to("or_ci95_low", digits).alias("or_ci95_low"),
        round_to("or_ci95_high", digits).alias("or_ci95_high"),
        round_to("std_error", digits).alias("std_error"),
        round_to("pseudo_r2", 6).alias("pseudo_r2"),
        "n_obs",
    )
