"""Lenient text -> typed column parsing (raw layer to typed layer).

Every helper maps text to a typed value or NULL, never raises, and mirrors
the typing rules of the raw-to-typed step:

* blanks (after trimming spaces) are NULL;
* decimal text that does not look like a number is NULL (Spark alone would
  accept suffixes such as ``12.5f``);
* integer counters accept float-formatted text (``"0.0"`` -> 0, ``"12.5"``
  -> 13, half away from zero) instead of silently turning it into NULL;
* month-year dates (``Dec-2015``) land on the first of the month.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Shape of a plain decimal / scientific number, applied after trimming.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
MONTH_YEAR_FORMAT = "MMM-yyyy"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: ColumnOrName) -> Column:
    """``NULLIF(TRIM(x), '')``: trims spaces only, blank -> NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def to_double(c: ColumnOrName) -> Column:
    """Text -> double; anything that is not a plain number is NULL."""
    text = blank_to_null(c)
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def to_int(c: ColumnOrName) -> Column:
    """Text -> int, accepting float-formatted integers (``"0.0"`` -> 0).

    ``try_cast('0.0' as int)`` is NULL in Spark; going through double and
    rounding half away from zero gives the lenient reading. Out-of-range
    values are NULL.
    """
    return F.round(to_double(c), 0).try_cast("int")


def first_int_short(c: ColumnOrName) -> Column:
    """First run of digits as smallint (``' 36 months'`` -> 36), else NULL."""
    return F.regexp_extract(F.trim(_col(c)), r"([0-9]+)", 1).try_cast("short")


def percent(c: ColumnOrName) -> Column:
    """Percent text (``'10.65%'`` or ``'10.65'``) -> double without the sign."""
    return to_double(F.replace(blank_to_null(c), F.lit("%"), F.lit("")))


def month_year(c: ColumnOrName) -> Column:
    """``'Dec-2015'`` (padding tolerated, case-insensitive) -> 2015-12-01."""
    return F.try_to_date(F.trim(_col(c)), MONTH_YEAR_FORMAT)


def ordinal_years(c: ColumnOrName) -> Column:
    """Employment-length text -> lower bound in years (smallint).

    Exact forms first (``< 1 year`` -> 0, ``10+ years`` -> 10), then the
    first number; ``n/a`` and blanks are NULL.
    """
    text = F.trim(_col(c))
    return (
        F.when(text == "< 1 year", F.lit(0).cast("short"))
        .when(text == "10+ years", F.lit(10).cast("short"))
        .otherwise(first_int_short(c))
    )


def years_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Calendar-year boundaries crossed (2014-12-31 -> 2015-01-01 is 1)."""
    return (F.year(_col(end)) - F.year(_col(start))).cast("long")


def quarter_label(d: ColumnOrName) -> Column:
    """``YYYY-Qn`` label of a date; NULL date gives NULL."""
    d = _col(d)
    return F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string"))


def plain_number(c: ColumnOrName) -> Column:
    """Double -> shortest plain decimal text with at least one decimal (``12345678.5``, ``0.0001``).

    Spark's cast switches to exponents at 1e7 and below 1e-3; a fingerprint
    must not depend on that. Exact for magnitudes from 1e-4 up to 1e15.
    """
    digits = F.regexp_replace(_col(c).cast("decimal(38,18)").cast("string"), "0+$", "")
    return F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)


def row_fingerprint(*parts: ColumnOrName) -> Column:
    """md5 of the parts joined with ``|``; NULL parts count as empty text.

    Parts are cast to text by Spark; pass doubles through ``plain_number``.
    """
    texts = [F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws("|", *texts))
