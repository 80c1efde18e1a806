"""Vintage statistics: z-tests, mix/rate decomposition, comparison tables, logit.

All counting happens in one conditional aggregate over the cohort (partial
aggregation on the map side; the output is a single row). Tests and
decompositions are column arithmetic on that row. The logistic model is a
Spark ML GLM: each IRLS iteration is one distributed pass over the cached
feature frame. P-values use ``math.erfc`` on the handful of result rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortcraft.functions.classify import GRADE_DOMAIN, dti_band, period_label
from cohortcraft.functions.metrics import n_rows, n_where
from cohortcraft.functions.metrics import round_to

EARLY, LATE = "2014", "2015"
# Two-sided/one-sided 5 % critical values of the normal law.
Z_CRIT_ONE_SIDED = 1.6448536269514722
Z_CRIT_TWO_SIDED = 1.959963984540054


def with_period(cohort: DataFrame, year_col: str = "issue_year") -> DataFrame:
    return cohort.withColumn("period", period_label(year_col))


def period_counts(cohort: DataFrame) -> DataFrame:
    """One row: contracts, defaults, D/E contracts and D/E defaults per period."""
    p = with_period(cohort)
    late = F.col("period") == LATE
    de = F.col("is_grade_de")
    flag = F.col("default_flag") == 1
    cols = []
    for name, cond in (("late", late), ("early", ~late)):
        cols += [
            n_where(cond).alias(f"n_{name}"),
            n_where(cond & flag).alias(f"d_{name}"),
            n_where(cond & de).alias(f"de_{name}"),
            n_where(cond & de & flag).alias(f"de_d_{name}"),
        ]
    return p.agg(*cols)


def two_proportion(success_a: Column, n_a: Column, success_b: Column, n_b: Column) -> dict[str, Column]:
    """Pooled two-sample z-test for proportions (A is the later period)."""
    sa, na, sb, nb = (c.cast("double") for c in (success_a, n_a, success_b, n_b))
    pa, pb = F.try_divide(sa, na), F.try_divide(sb, nb)
    pooled = F.try_divide(sa + sb, na + nb)
    se = F.sqrt(pooled * (1.0 - pooled) * (F.try_divide(F.lit(1.0), na) + F.try_divide(F.lit(1.0), nb)))
    # empty groups or a degenerate pooled rate give NULL, not a division error
    return {"rate_a": pa, "rate_b": pb, "delta_pp": 100.0 * (pa - pb), "z_stat": F.try_divide(pa - pb, se)}


# The four hypotheses (id, description, alternative).
HYPOTHESES = (
    ("H1", "overall default rate increased", "larger"),
    ("H2", "grade D/E share changed", "two-sided"),
    ("H3", "default rate within grades D/E increased", "larger"),
    ("H4", "default rate within other grades increased", "larger"),
)


def hypothesis_battery(cohort: DataFrame, digits: int = 6) -> DataFrame:
    """H1-H4 as four rows, decided by the 5 % critical value of z."""
    c = period_counts(cohort)
    inputs = {
        "H1": ("d_late", "n_late", "d_early", "n_early"),
        "H2": ("de_late", "n_late", "de_early", "n_early"),
        "H3": ("de_d_late", "de_late", "de_d_early", "de_early"),
        "H4": (None, None, None, None),
    }
    col = F.col
    rows = []
    for hid, text, alt in HYPOTHESES:
        if hid == "H4":
            sa, na = col("d_late") - col("de_d_late"), col("n_late") - col("de_late")
            sb, nb = col("d_early") - col("de_d_early"), col("n_early") - col("de_early")
        else:
            sa, na, sb, nb = (col(x) for x in inputs[hid])
        rows.append(
            F.struct(
                F.lit(hid).alias("hypothesis"), F.lit(text).alias("description"), F.lit(alt).alias("alternative"),
                sa.cast("long").alias("success_a"), na.cast("long").alias("n_a"),
                sb.cast("long").alias("success_b"), nb.cast("long").alias("n_b"),
            )
        )
    stacked = c.select(F.explode(F.array(*rows)).alias("h")).select("h.*")
    t = two_proportion(col("success_a"), col("n_a"), col("success_b"), col("n_b"))
    z = t["z_stat"]
    reject = F.when(col("alternative") == "two-sided", F.abs(z) > Z_CRIT_TWO_SIDED).otherwise(z > Z_CRIT_ONE_SIDED)
    return stacked.select(
        "hypothesis", "description", "alternative", "success_a", "n_a", "success_b", "n_b",
        round_to(t["rate_a"], digits).alias("rate_a"),
        round_to(t["rate_b"], digits).alias("rate_b"),
        round_to(t["delta_pp"], digits).alias("delta_pp"),
        round_to(z, digits).alias("z_stat"),
        reject.alias("reject_h0"),
    )


def group_proportion_test(df: DataFrame, group_col: str, success_col: str, group_a, group_b,
                          alternative: str = "two-sided", digits: int = 6) -> DataFrame:
    """Two-proportion z-test of ``success_col`` (0/1) between two groups of any table.

    One conditional aggregate (partial on the map side) gives the four counts.
    """
    g, y = F.col(group_col), F.col(success_col) == 1
    c = df.agg(
        n_where(y & (g == group_a)).alias("success_a"), n_where(g == group_a).alias("n_a"),
        n_where(y & (g == group_b)).alias("success_b"), n_where(g == group_b).alias("n_b"),
    )
    t = two_proportion(F.col("success_a"), F.col("n_a"), F.col("success_b"), F.col("n_b"))
    z = t["z_stat"]
    crit = Z_CRIT_TWO_SIDED if alternative == "two-sided" else Z_CRIT_ONE_SIDED
    decision = F.abs(z) > crit if alternative == "two-sided" else (z > crit if alternative == "larger" else z < -crit)
    return c.select(
        F.lit(alternative).alias("alternative"), "success_a", "n_a", "success_b", "n_b",
        round_to(t["rate_a"], digits).alias("rate_a"), round_to(t["rate_b"], digits).alias("rate_b"),
        round_to(t["delta_pp"], digits).alias("delta_pp"), round_to(z, digits).alias("z_stat"),
        decision.alias("reject_h0"),
    )


def p_value(z: float, alternative: str) -> float:
    """Normal tail probability without cancellation (``erfc``, not ``1 - cdf``)."""
    if alternative == "two-sided":
        return math.erfc(abs(z) / math.sqrt(2.0))
    if alternative == "smaller":
        return 0.5 * math.erfc(-z / math.sqrt(2.0))
    return 0.5 * math.erfc(z / math.sqrt(2.0))


SERIES_BELOW = 2.5
SERIES_TERMS, FRACTION_TERMS = 60, 200


def upper_tail(z: Column) -> Column:
    """P(Z > z) for z >= 0 in column arithmetic.

    Below ``SERIES_BELOW`` one half minus the power series of the centre part;
    above it the continued fraction of the tail, which loses no digits however
    small the tail is. Both run backwards over a fixed number of terms.
    """
    density = F.exp(-z * z / 2.0) / math.sqrt(2.0 * math.pi)
    terms = lambda n: F.sequence(F.lit(n), F.lit(1), F.lit(-1))
    series = F.aggregate(terms(SERIES_TERMS), F.lit(1.0), lambda s, k: 1.0 + z * z / (2.0 * k + 1.0) * s)
    fraction = F.aggregate(terms(FRACTION_TERMS), z, lambda t, k: z + k / t)
    return F.when(z < SERIES_BELOW, 0.5 - density * z * series).otherwise(density / fraction)


def tail_probability(z: Column, alternative: Column) -> Column:
    """p-value of ``z`` for ``larger``, ``smaller`` or ``two-sided``; NULL for a NULL z."""
    far = upper_tail(F.abs(z))
    above = F.when(z >= 0, far).otherwise(1.0 - far)
    return F.when(alternative == "two-sided", F.least(F.lit(1.0), 2.0 * far)).when(alternative == "smaller", F.when(z <= 0, far).otherwise(1.0 - far)).otherwise(above)


def with_p_values(tests: DataFrame, z_col: str = "z_stat", alt_col: str = "alternative") -> DataFrame:
    """Add ``p_value`` (ten significant digits) and its ``.2e`` display."""
    p = tail_probability(F.col(z_col), F.col(alt_col))
    return tests.withColumn("p_value", F.format_string("%.9e", p).cast("double")).withColumn(
        "p_value_display", F.format_string("%.2e", F.col("p_value"))
    )


def mix_rate_decomposition(cohort: DataFrame, digits: int = 6) -> DataFrame:
    """Sequential decomposition of the change in the default rate (pp).

    composition = (s1 - s0)(pD0 - pO0); rate_D = s1 (pD1 - pD0);
    rate_O = (1 - s1)(pO1 - pO0); their sum equals the total change.
    """
    c = period_counts(cohort)
    col = F.col

    def ratio(a, b):
        return F.try_divide(col(a).cast("double"), col(b).cast("double"))

    s0, s1 = ratio("de_early", "n_early"), ratio("de_late", "n_late")
    pd0, pd1 = ratio("de_d_early", "de_early"), ratio("de_d_late", "de_late")
    po0 = F.try_divide((col("d_early") - col("de_d_early")).cast("double"), (col("n_early") - col("de_early")).cast("double"))
    po1 = F.try_divide((col("d_late") - col("de_d_late")).cast("double"), (col("n_late") - col("de_late")).cast("double"))
    r0, r1 = ratio("d_early", "n_early"), ratio("d_late", "n_late")
    composition = (s1 - s0) * (pd0 - po0)
    rate_de = s1 * (pd1 - pd0)
    rate_other = (1.0 - s1) * (po1 - po0)
    parts = [
        (0, "total_change", 100.0 * (r1 - r0)),
        (1, "composition_effect", 100.0 * composition),
        (2, "rate_effect_grade_de", 100.0 * rate_de),
        (3, "rate_effect_other_grades", 100.0 * rate_other),
        (4, "sum_of_effects", 100.0 * (composition + rate_de + rate_other)),
    ]
    arr = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(n).alias("component"), round_to(v, digits).alias("pp"))
                    for i, n, v in parts])
    return c.select(F.explode(arr).alias("x")).select("x.*")


def grade_domain(spark, grades: tuple[str, ...] = GRADE_DOMAIN) -> DataFrame:
    """The fixed grade spine (position, grade); bounded by the domain."""
    return spark.createDataFrame(list(enumerate(grades)), "position int, grade string")


def grade_period_comparison(cohort: DataFrame, digits: int = 4) -> DataFrame:
    """Share, default rate, mean rate and ratio per grade for both periods.

    Shares divide by all contracts of the period (NULL grades included);
    the fixed A..G spine then keeps its own order and drops other grades.
    """
    p = with_period(cohort)
    col = F.col
    aggs = []
    for per in (EARLY, LATE):
        inp = col("period") == per
        aggs += [
            n_where(inp).alias(f"n_{per}"),
            F.avg(F.when(inp, col("default_flag"))).alias(f"default_{per}"),
            F.avg(F.when(inp, col("interest_rate_pct"))).alias(f"rate_{per}"),
            F.avg(F.when(inp, col("debt_to_income_ratio"))).alias(f"dti_{per}"),
        ]
    by_grade = p.groupBy("grade").agg(*aggs)
    everything = Window.partitionBy()
    shares = by_grade.select(
        "grade",
        *[F.try_divide(100.0 * col(f"n_{per}"), F.sum(f"n_{per}").over(everything)).alias(f"share_{per}_pct")
          for per in (EARLY, LATE)],
        *[(100.0 * col(f"default_{per}")).alias(f"default_{per}_pct") for per in (EARLY, LATE)],
        *[col(f"rate_{per}").alias(f"rate_{per}_pct") for per in (EARLY, LATE)],
        *[col(f"dti_{per}").alias(f"dti_{per}") for per in (EARLY, LATE)],
    )
    # An absent period has no rows: pandas gives NaN shares there, we give NULL.
    shares = shares.select(
        "grade",
        *[F.when(col(f"share_{per}_pct") > 0, col(f"share_{per}_pct")).alias(f"share_{per}_pct") for per in (EARLY, LATE)],
        *[c for c in shares.columns if not c.startswith("share_") and c != "grade"],
    )
    spine = grade_domain(cohort.sparkSession)
    joined = spine.join(shares, "grade", "left")
    metric_cols = [
        "share_2014_pct", "share_2015_pct", "default_2014_pct", "default_2015_pct",
        "rate_2014_pct", "rate_2015_pct", "dti_2014", "dti_2015",
    ]
    out = joined.select(
        "position", "grade", *[round_to(col(c), digits).alias(c) for c in metric_cols],
        round_to(col("default_2015_pct") - col("default_2014_pct"), digits).alias("delta_default_pp"),
        round_to(col("rate_2015_pct") - col("rate_2014_pct"), digits).alias("delta_rate_pp"),
    )
    return out.orderBy("position")


def price_vs_risk(comparison: DataFrame, digits: int = 4) -> DataFrame:
    """Per grade: change in default, in mean rate, in ratio; attention quadrant.

    The quadrant flag marks grades whose rate fell while defaults rose.
    """
    col = F.col
    return comparison.select(
        "position", "grade", "delta_default_pp", "delta_rate_pp", "dti_2014", "dti_2015",
        round_to(col("dti_2015") - col("dti_2014"), digits).alias("delta_dti"),
        ((col("delta_rate_pp") < 0) & (col("delta_default_pp") > 0)).alias("attention_quadrant"),
    ).orderBy("position")


def band_shift(cohort: DataFrame, band_col: str = "dti_band", drop_label: str = "Unknown", digits: int = 4) -> DataFrame:
    """Share and default rate of each band per period.

    The period total includes the dropped band: the filter comes after the
    share is computed (window over the aggregated rows).
    """
    p = with_period(cohort)
    if band_col not in p.columns:
        p = p.withColumn(band_col, dti_band("debt_to_income_ratio"))
    g = p.groupBy("period", band_col).agg(n_rows().alias("loans"), F.avg("default_flag").alias("_rate"))
    per_period = Window.partitionBy("period")
    return g.select(
        "period", band_col, "loans",
        round_to(F.try_divide(100.0 * F.col("loans"), F.sum("loans").over(per_period)), digits).alias("portfolio_share_pct"),
        round_to(100.0 * F.col("_rate"), digits).alias("default_rate_pct"),
    ).where(F.col(band_col) != drop_label)


def quarter_trend(cohort: DataFrame, digits: int = 4) -> DataFrame:
    """Quarterly rate, D/E share and the rate within each grade group.

    One scan: a pivot on ``is_grade_de`` gathers, per quarter and side, the
    contracts, the defaults and the known outcomes; every rate is then
    integer counts divided once, so the totals need no second pass or join.
    """
    base = cohort.where(F.col("issue_quarter").isNotNull()).withColumn(
        "_de", F.coalesce(F.col("is_grade_de"), F.lit(False))
    )
    p = (
        base.groupBy("issue_quarter")
        .pivot("_de", [False, True])
        .agg(n_rows().alias("n"), F.sum("default_flag").alias("d"), F.count("default_flag").alias("k"))
    )
    col = F.col

    def z(c: str) -> Column:
        return F.coalesce(col(c), F.lit(0)).cast("double")

    total = z("false_n") + z("true_n")
    return p.select(
        "issue_quarter",
        (z("false_n") + z("true_n")).cast("long").alias("total_loans"),
        round_to(100.0 * F.try_divide(z("false_d") + z("true_d"), z("false_k") + z("true_k")), digits).alias("default_rate_pct"),
        round_to(100.0 * F.try_divide(z("true_n"), total), digits).alias("grade_de_share_pct"),
        round_to(100.0 * F.try_divide(col("true_d").cast("double"), col("true_k").cast("double")), digits).alias("de_default_rate_pct"),
        round_to(100.0 * F.try_divide(col("false_d").cast("double"), col("false_k").cast("double")), digits).alias("other_default_rate_pct"),
    ).orderBy("issue_quarter")
