"""Lenient typing traps (dates, float-formatted integers, number shapes)."""

import datetime as dt
import hashlib

import pytest

from cohortcraft.functions import parse as P


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("Dec-2015", dt.date(2015, 12, 1)),
        (" Dec-2015 ", dt.date(2015, 12, 1)),
        ("dec-2015", dt.date(2015, 12, 1)),
        ("13-2015", None),
        ("Dec-15", None),
        ("", None),
        (None, None),
    ],
)
def test_month_year(spark, text, expected):
    assert one(spark, P.month_year("s"), text) == expected


@pytest.mark.parametrize(
    "text,expected",
    [("0.0", 0), ("0", 0), ("12.5", 13), ("13.5", 14), ("12.7", 13), ("1e3", 1000), (" 7 ", 7), ("abc", None),
     ("", None), ("12.5f", None), ("99999999999", None)],
)
def test_to_int_accepts_float_formatted(spark, text, expected):
    assert one(spark, P.to_int("s"), text) == expected


@pytest.mark.parametrize(
    "text,expected",
    [("5000", 5000.0), ("5000.0", 5000.0), (" 7 ", 7.0), ("12.5f", None), ("5d", None), ("nan", None),
     ("Infinity", None), ("", None), ("-1.5e2", -150.0), (".5", 0.5)],
)
def test_to_double_shape(spark, text, expected):
    assert one(spark, P.to_double("s"), text) == expected


def test_first_int_short_type_and_value(spark):
    df = spark.createDataFrame([(" 36 months",), (" 60 months",), ("x",), (None,)], "s string")
    out = df.select(P.first_int_short("s").alias("t"))
    assert out.schema["t"].dataType.simpleString() == "smallint"
    assert [r.t for r in out.collect()] == [36, 60, None, None]


@pytest.mark.parametrize("text,expected", [("10.65%", 10.65), ("10.65", 10.65), ("", None), (None, None), ("x%", None)])
def test_percent(spark, text, expected):
    assert one(spark, P.percent("s"), text) == expected


def test_ordinal_years(spark):
    vals = ["< 1 year", "1 year", "5 years", "10+ years", "n/a", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    out = df.select(P.ordinal_years("s").alias("y"))
    assert out.schema["y"].dataType.simpleString() == "smallint"
    assert [r.y for r in out.collect()] == [0, 1, 5, 10, None, None, None]


def test_years_between_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2014, 12, 31), dt.date(2015, 1, 1))], "a date, b date")
    assert df.select(P.years_between("a", "b").alias("y")).first().y == 1


def test_quarter_label(spark):
    df = spark.createDataFrame([(dt.date(2015, 11, 1),), (None,)], "d date")
    assert [r.q for r in df.select(P.quarter_label("d").alias("q")).collect()] == ["2015-Q4", None]


def test_blank_to_null_keeps_tabs(spark):
    assert one(spark, P.blank_to_null("s"), "   ") is None
    assert one(spark, P.blank_to_null("s"), "\t") == "\t"


def test_row_fingerprint_matches_md5(spark):
    df = spark.createDataFrame([("1", dt.date(2015, 12, 1), 5000.0, "B", None)], "a string, d date, x double, g string, n string")
    got = df.select(P.row_fingerprint("a", "d", "x", "g", "n").alias("h")).first().h
    assert got == hashlib.md5("1|2015-12-01|5000.0|B|".encode()).hexdigest()
