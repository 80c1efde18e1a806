"""Status taxonomy, bands (edges go up, NULL handling), two-way labels."""

from pyspark.sql import functions as F

from cohortcraft.functions import classify as K


def test_taxonomy_all_statuses(spark):
    rows = [
        ("Fully Paid", "resolved_paid", 0, True),
        ("Does not meet the credit policy. Status:Fully Paid", "resolved_paid", 0, True),
        ("Charged Off", "resolved_default", 1, True),
        ("Default", "resolved_default", 1, True),
        ("Does not meet the credit policy. Status:Charged Off", "resolved_default", 1, True),
        ("Current", "active_current", None, False),
        ("Late (16-30 days)", "active_delinquent", None, False),
        ("Late (31-120 days)", "active_delinquent", None, False),
        ("In Grace Period", "active_delinquent", None, False),
        ("Foo", "unknown", None, False),
    ]
    df = spark.createDataFrame([(r[0],) for r in rows], "s string").select("s", *[
        c.alias(n) for n, c in K.TAXONOMY.columns(F.col("s")).items()])
    got = {r.s: (r.status_group, r.default_flag, r.is_resolved) for r in df.collect()}
    for status, group, flag, resolved in rows:
        assert got[status] == (group, flag, resolved), status
    cur = df.where(F.col("s") == "Current").first()
    assert cur.is_current and not cur.is_delinquent


def test_band_edges_go_up_and_nulls(spark):
    df = spark.createDataFrame(
        [(39999.99, 9.99, 4999.0), (40000.0, 10.0, 5000.0), (60000.0, 20.0, 10000.0), (80000.0, 30.0, 20000.0),
         (120000.0, 30.0, 30000.0), (None, None, None)],
        "inc double, dti double, amt double",
    )
    out = df.select(K.income_band("inc").alias("i"), K.dti_band("dti").alias("d"), K.amount_band("amt").alias("a")).collect()
    assert [r.i for r in out] == ["< $40k", "$40k–$60k", "$60k–$80k", "$80k–$120k", "$120k+", "Unknown"]
    assert [r.d for r in out] == ["< 10", "10–20", "20–30", "30+", "30+", "Unknown"]
    # the amount band has no NULL branch: NULL falls to the top band
    assert [r.a for r in out] == ["< $5k", "$5k–$10k", "$10k–$20k", "$20k–$30k", "$30k+", "$30k+"]


def test_null_grade_is_not_low_grade(spark):
    df = spark.createDataFrame([("D",), ("E",), ("B",), (None,)], "g string")
    assert [r.x for r in df.select(K.in_set_or_false("g", K.LOW_GRADES).alias("x")).collect()] == [True, True, False, False]


def test_period_label_null_is_late(spark):
    df = spark.createDataFrame([(2014,), (2015,), (None,)], "y int")
    assert [r.p for r in df.select(K.period_label("y").alias("p")).collect()] == ["2014", "2015", "2015"]
