"""Vintage statistics against golden values derived from the published tables.

The cohort fixture reproduces the published period counts (2014: 162,570
contracts, 22,315 defaults, 27,576 D/E, 6,458 D/E defaults; 2015: 283,026 /
42,132 / 42,154 / 11,678), so tests, decomposition and p-values can be
checked without the loan file.
"""

import pytest
from pyspark.sql import functions as F

from cohortcraft.operators import stats

COUNTS = {2014: (162_570, 22_315, 27_576, 6_458), 2015: (283_026, 42_132, 42_154, 11_678)}


@pytest.fixture(scope="module")
def cohort(spark):
    parts = []
    for year, (n, d, de, de_d) in COUNTS.items():
        i = F.col("id")
        # rows [0, de) are D/E; defaults: first de_d of D/E, then d - de_d of the others
        is_de = i < de
        flag = F.when(is_de, (i < de_d).cast("int")).otherwise(((i - de) < (d - de_d)).cast("int"))
        parts.append(
            spark.range(n).select(
                F.lit(year).alias("issue_year"),
                is_de.alias("is_grade_de"),
                flag.alias("default_flag"),
                F.when(is_de, "D").otherwise("B").alias("grade"),
                F.concat(F.lit(str(year)), F.lit("-Q"), ((i % 4) + 1).cast("string")).alias("issue_quarter"),
                F.lit(12.0).alias("interest_rate_pct"),
                F.lit(15.0).alias("debt_to_income_ratio"),
            )
        )
    return parts[0].unionByName(parts[1]).cache()


def test_hypothesis_battery_golden(cohort):
    rows = {r.hypothesis: r for r in stats.with_p_values(stats.hypothesis_battery(cohort)).collect()}
    golden = {
        "H1": (1.159870, 10.596553, 1.5458e-26),
        "H2": (-2.068501, -18.295043, 9.0629e-75),
        "H3": (4.284269, 12.609597, 9.3474e-37),
        "H4": (0.896782, 8.025047, 5.0744e-16),
    }
    for h, (delta, z, p) in golden.items():
        r = rows[h]
        assert r.delta_pp == pytest.approx(delta, abs=2e-6)
        assert r.z_stat == pytest.approx(z, abs=2e-6)
        assert r.p_value == pytest.approx(p, rel=1e-3)
        assert r.reject_h0 is True
    assert rows["H1"].n_a == 283_026 and rows["H1"].n_b == 162_570


def test_decomposition_golden_and_additive(cohort):
    pp = {r.component: r.pp for r in stats.mix_rate_decomposition(cohort).collect()}
    assert pp["composition_effect"] == pytest.approx(-0.241445, abs=2e-6)
    assert pp["rate_effect_grade_de"] == pytest.approx(0.638101, abs=2e-6)
    assert pp["rate_effect_other_grades"] == pytest.approx(0.763215, abs=2e-6)
    assert pp["total_change"] == pytest.approx(1.159870, abs=2e-6)
    assert pp["sum_of_effects"] == pytest.approx(pp["total_change"], abs=2e-6)


def test_grade_period_comparison_spine(cohort):
    rows = stats.grade_period_comparison(cohort).collect()
    assert [r.grade for r in rows] == list("ABCDEFG")
    b = rows[1]
    assert b.share_2014_pct + rows[3].share_2014_pct == pytest.approx(100.0, abs=1e-3)
    assert rows[0].share_2014_pct is None and rows[6].default_2015_pct is None


def test_band_shift_total_includes_dropped_band(spark):
    df = spark.createDataFrame(
        [(2014, 5.0, 1), (2014, None, 0), (2014, 35.0, 0), (2014, 35.0, 1)],
        "issue_year int, debt_to_income_ratio double, default_flag int",
    )
    rows = {r.dti_band: r for r in stats.band_shift(df).collect()}
    assert "Unknown" not in rows
    assert rows["30+"].portfolio_share_pct == 50.0 and rows["< 10"].portfolio_share_pct == 25.0


def test_tail_column_equals_erfc(spark):
    zs = [0.0, 1e-3, 0.5, 1.0, 1.959963984540054, 2.4999, 2.5, 3.3, 6.0, 12.0, 25.0, 37.0]
    zs += [-z for z in zs]
    for alternative in ("two-sided", "larger", "smaller"):
        rows = spark.createDataFrame([(z, alternative) for z in zs], "z double, a string")
        for r in rows.select("z", stats.tail_probability(F.col("z"), F.col("a")).alias("p")).collect():
            assert r.p == pytest.approx(stats.p_value(r.z, alternative), rel=1e-10)


def test_p_value_tails():
    assert stats.p_value(0.0, "two-sided") == pytest.approx(1.0)
    assert stats.p_value(1.959963984540054, "two-sided") == pytest.approx(0.05, rel=1e-9)
    assert stats.p_value(12.0, "larger") > 0.0  # no 1 - cdf underflow


def test_empty_period_gives_nulls_not_errors(spark):
    only_2014 = spark.createDataFrame(
        [(2014, True, 1, "D", "2014-Q1", 10.0, 5.0), (2014, False, 0, "B", "2014-Q1", 10.0, 5.0)],
        "issue_year int, is_grade_de boolean, default_flag int, grade string, issue_quarter string, "
        "interest_rate_pct double, debt_to_income_ratio double",
    )
    h = {r.hypothesis: r for r in stats.hypothesis_battery(only_2014).collect()}
    assert h["H1"].n_a == 0 and h["H1"].rate_a is None and h["H1"].z_stat is None
    pp = {r.component: r.pp for r in stats.mix_rate_decomposition(only_2014).collect()}
    assert pp["total_change"] is None
    assert stats.quarter_trend(only_2014).first().de_default_rate_pct == 100.0
