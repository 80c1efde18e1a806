"""Metric expressions, declared once and reused by rollups, scopes and documents.

Denominator rules:

* a *rate* is the mean of the 0/1 outcome flag, so contracts without a
  final outcome (NULL flag) are left out of the denominator;
* a *share* is the mean of a 0/1 indicator over *all* contracts in scope.

Literals are doubles (``100.0``) so results stay ``double``; Spark would
otherwise type ``100.0 * avg(...)`` and ``avg(CASE .. 1.0 ..)`` as decimals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortcraft.functions.parse import ColumnOrName, _col


def n_rows() -> Column:
    return F.count(F.lit(1))


def n_where(cond: Column) -> Column:
    """Filtered count (``COUNT(*) FILTER (WHERE cond)``); NULL cond is not counted."""
    return F.count_if(cond)


def total(c: ColumnOrName) -> Column:
    """Sum as bigint (sum of an int flag)."""
    return F.sum(_col(c)).cast("long")


def indicator(cond: Column, one: float | int = 1, zero: float | int = 0) -> Column:
    """``CASE WHEN cond THEN 1 ELSE 0 END`` (NULL cond -> 0)."""
    return F.when(cond, F.lit(one)).otherwise(F.lit(zero))


def mean(c: ColumnOrName, where: Column | None = None) -> Column:
    """Mean with NULLs skipped; ``where`` gives ``AVG(x) FILTER (WHERE ..)``."""
    x = _col(c)
    return F.avg(x if where is None else F.when(where, x))


def pct(c: ColumnOrName, where: Column | None = None) -> Column:
    """100 x mean (rate of a 0/1 flag, or share of a 0/1 indicator)."""
    return F.lit(100.0) * mean(c, where)


def round_to(c: ColumnOrName, digits: int = 2) -> Column:
    """``ROUND(x, d)`` of a double as the reference engine does it.

    The value is scaled in binary, rounded half away from zero, and scaled
    back: ``round(x * 10^d) / 10^d``. Spark's ``round(x, d)`` instead rounds
    the decimal expansion, so the two disagree on near-ties such as a median
    that falls on half a cent.
    """
    scale = float(10**digits)
    return F.round(_col(c) * scale, 0) / scale


_SPLIT = float(2**27 + 1)
"""Splits a double into two halves of 26 bits (Dekker)."""


def half_even(c: ColumnOrName, digits: int = 2) -> Column:
    """A double rounded to ``digits`` decimals by its exact binary value, ties to even.

    The documents' rule: 2.675 is a little less than it looks and gives 2.67,
    while 0.125 is a true tie and gives 0.12. The product ``x * 10^digits`` is
    formed exactly as a double and its error (two halves of each factor multiply
    without rounding), so it is known on which side of the half it lies.
    """
    if not 0 <= digits <= 15:
        raise ValueError("digits must be between 0 and 15")
    x = _col(c)
    size, scale = F.abs(x), float(10**digits)
    product = size * scale
    high = size * _SPLIT - (size * _SPLIT - size)
    low = size - high
    scale_high = scale * _SPLIT - (scale * _SPLIT - scale)
    scale_low = scale - scale_high
    error = ((high * scale_high - product) + high * scale_low + low * scale_high) + low * scale_low
    whole = F.floor(product).cast("double")
    part = product - whole
    even = whole % 2.0 == 0.0
    up = (part > 0.5) | ((part == 0.5) & ((error > 0.0) | ((error == 0.0) & ~even)))
    # from 2^52 on the product is whole and its error, of one half at most, decides ties alone
    tie = (product >= float(2**52)) & ~even & (F.abs(error) == 0.5)
    step = F.when(tie, 2.0 * error).when(up & (product < float(2**52)), 1.0).otherwise(0.0)
    # from 2^53 on neighbouring doubles are more than a unit of the last digit apart: the value is its own nearest
    near = F.when(product < float(2**53), (whole + step) / scale).otherwise(size)
    return F.when(x.isNull() | F.isnan(x), x).when(x < 0, -near).otherwise(near)


def rounded(c: Column, digits: int = 2) -> Column:
    return round_to(c, digits)
