"""Adapters from the driver's star-schema tables to the contract model.

The library works on contract-level data: a raw all-text table shaped like
the source extract, typed into the contract layer. The driver ships
TPC-H-like tables instead, so these adapters render ``orders`` joined with
``customer`` as raw contract *text* (with the awkward forms the typed layer
must survive: padded and invalid month-year dates, blank statuses,
float-formatted counters, percent signs, junk numbers, blanks). The typed
layer then parses that text back, so every query exercises the whole
raw -> typed -> cohort chain and its work grows with the driver tables.

Mapping (one contract per order):

* id = o_orderkey; amount = o_totalprice; grade = priority digit 1..5 -> A..E
* issue date = 2007-01-01 + 1.4 x (days since 1995-01-01), so the data spans
  the reference scopes' windows (2007 .. 2016)
* status from o_orderstatus: F -> defaulted, O -> paid, P -> no final outcome,
  refined by the customer's nation into the full status taxonomy
* purpose from c_mktsegment (BUILDING is the ``debt_consolidation`` segment)
* income = 20 x c_acctbal (blank or junk when the balance is negative)
* term 60 months for nations 20..24, else 36

The join is a test adapter, not a reference operator. It is a plain
equi-join: Spark picks sort-merge or (via AQE, from measured sizes) a
broadcast of ``customer``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortcraft.sources.columnar import driver_table

_EPOCH = dt.date(1995, 1, 1)
_ISSUE_START = dt.date(2007, 1, 1)

# Segment -> purpose used by the adapter.
PURPOSE_BY_SEGMENT = {
    "BUILDING": "debt_consolidation",
    "AUTOMOBILE": "car",
    "FURNITURE": "home_improvement",
    "MACHINERY": "small_business",
    "HOUSEHOLD": "credit_card",
}


def _money(cents: Column) -> Column:
    """Non-negative integer cents -> ``'1234.56'`` (exact, no float formatting)."""
    return F.concat(
        F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0")
    )


def _purpose(segment: Column) -> Column:
    chain = None
    for seg, purpose in PURPOSE_BY_SEGMENT.items():
        chain = F.when(segment == seg, purpose) if chain is None else chain.when(segment == seg, purpose)
    return chain.otherwise(F.lower(segment))


def _status(order_status: Column, nation: Column) -> Column:
    return (
        F.when((order_status == "F") & (nation == 1), "Default")
        .when((order_status == "F") & (nation == 2), "Does not meet the credit policy. Status:Charged Off")
        .when(order_status == "F", "Charged Off")
        .when((order_status == "O") & (nation == 2), "Does not meet the credit policy. Status:Fully Paid")
        .when(order_status == "O", "Fully Paid")
        .when(nation == 1, "Late (31-120 days)")
        .when(nation == 2, "Late (16-30 days)")
        .when(nation == 3, "In Grace Period")
        .when(nation == 4, "Issued")
        .otherwise("Current")
    )


def contract_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw all-text contract table (30 source columns) from orders x customer."""
    orders = driver_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customer = driver_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    j = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")

    nk = F.col("c_nationkey")
    bal = F.col("c_acctbal")
    g = F.substring("o_orderpriority", 1, 1).cast("int")
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit(_EPOCH))
    issue = F.date_add(F.lit(_ISSUE_START), F.floor(days * 7 / 5.0).cast("int"))
    term = F.when(nk >= 20, 60).otherwise(36)
    amount_cents = F.round(F.col("o_totalprice") * 100).cast("long")
    rate_bp = F.lit(500) + 250 * g + F.floor(bal / 20)
    income_cents = F.round(bal * 2000).cast("long")
    grade = F.translate(F.substring("o_orderpriority", 1, 1), "12345", "ABCDE")
    month = F.date_format(issue, "MMM-yyyy")
    history = F.lit(2) + F.floor(F.abs(bal) / 500)
    fico_low = F.lit(660) + F.floor(bal / 100)

    return j.select(
        F.col("o_orderkey").cast("string").alias("id"),
        _money(amount_cents).alias("loan_amnt"),
        _money(amount_cents).alias("funded_amnt"),
        F.when(term == 60, " 60 months").otherwise(" 36 months").alias("term"),
        F.when(nk == 8, "")
        .when(nk == 7, _money(rate_bp))
        .otherwise(F.concat(_money(rate_bp), F.lit("%")))
        .alias("int_rate"),
        _money(F.floor(amount_cents / term)).alias("installment"),
        grade.alias("grade"),
        F.concat(grade, (1 + F.floor(nk / 5)).cast("string")).alias("sub_grade"),
        F.when(nk == 0, "< 1 year")
        .when(nk == 1, "1 year")
        .when(nk == 10, "10+ years")
        .when(nk == 11, "n/a")
        .when(nk == 12, "")
        .when(nk < 10, F.concat(nk.cast("string"), F.lit(" years")))
        .otherwise(F.concat((nk - 10).cast("string"), F.lit(" years")))
        .alias("emp_length"),
        F.when(nk < 8, "MORTGAGE").when(nk < 16, "RENT").otherwise("OWN").alias("home_ownership"),
        F.when(bal < -500, "").when(bal < 0, "n/a").otherwise(_money(income_cents)).alias("annual_inc"),
        F.when(bal < 3000, "Not Verified")
        .when(bal < 6000, "Source Verified")
        .otherwise("Verified")
        .alias("verification_status"),
        F.when((nk == 24) & (g == 1), F.concat(F.lit("13-"), F.year(issue).cast("string")))
        .when(nk == 3, F.concat(F.lit(" "), month, F.lit(" ")))
        .otherwise(month)
        .alias("issue_d"),
        F.when((nk == 23) & (g == 1), "  ")
        .otherwise(_status(F.col("o_orderstatus"), nk))
        .alias("loan_status"),
        F.when((nk == 21) & (g == 5), "").otherwise(_purpose(F.col("c_mktsegment"))).alias("purpose"),
        F.concat(F.lit("N"), F.lpad(nk.cast("string"), 2, "0")).alias("addr_state"),
        F.when(nk == 22, "")
        .otherwise(_money(F.floor(F.col("o_totalprice") / 100)))
        .alias("dti"),
        F.when(nk < 12, "0.0").when(nk < 20, "1").otherwise("2.0").alias("delinq_2yrs"),
        F.date_format(F.add_months(issue, (-12 * history).cast("int")), "MMM-yyyy").alias("earliest_cr_line"),
        (5 + nk).cast("string").alias("open_acc"),
        F.when(nk < 20, "0").otherwise("1.0").alias("pub_rec"),
        _money(F.round(F.abs(bal) * 100).cast("long")).alias("revol_bal"),
        F.concat((nk * 4).cast("string"), F.lit(".5%")).alias("revol_util"),
        (10 + 2 * nk).cast("string").alias("total_acc"),
        F.when(bal < 5000, "w").otherwise("f").alias("initial_list_status"),
        F.lit("Individual").alias("application_type"),
        F.when(nk < 10, "0.0").otherwise("2").alias("mort_acc"),
        F.lit("0").alias("pub_rec_bankruptcies"),
        fico_low.cast("string").alias("fico_range_low"),
        (fico_low + 4).cast("string").alias("fico_range_high"),
    )


def lineitem_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed contract-like rows from ``lineitem`` (the bench-scale rollup input).

    grade = discount step (0.00 -> A, 0.01 -> B, ...); outcome R -> 1,
    A -> 0, N -> unknown; amount = extended price; rate = 100 x tax;
    income = 1000 x quantity; ratio = 100 x discount; no score.
    """
    li = driver_table(spark, sf_dir, "lineitem").select(
        "l_extendedprice", "l_discount", "l_tax", "l_quantity", "l_returnflag"
    )
    return li.select(
        F.chr(F.lit(65) + F.round(F.col("l_discount") * 100).cast("int")).alias("grade"),
        F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 0).alias("default_flag"),
        F.col("l_extendedprice").alias("loan_amount"),
        (F.col("l_tax") * 100).alias("interest_rate_pct"),
        (F.col("l_quantity") * 1000).alias("annual_income"),
        (F.col("l_discount") * 100).alias("debt_to_income_ratio"),
        F.lit(None).cast("double").alias("fico_score_avg"),
    )
