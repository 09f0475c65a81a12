"""Exact money arithmetic on decimal columns.

Money stays ``DECIMAL`` from parse to mart. Ratios and means are rounded
half away from zero on the exact rational value (``ROUND(numeric, 2)``
semantics), never on a double and never on an already-rounded quotient.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _units(c: Column, scale: int) -> Column:
    """Value times 10^scale as an integral decimal (exact when c has <= scale digits)."""
    return (c * (10 ** scale)).cast("decimal(38,0)")


def rounded_ratio(num: Column, den: Column, digits: int = 2, factor: int = 1, scale: int = 2) -> Column:
    """``round(factor * num / den, digits)`` rounded half away from zero, exactly.

    ``num`` and ``den`` are decimal or integral columns with at most ``scale``
    fractional digits (money, rates, counts). NULL when ``den`` is 0 or NULL.
    Result is ``DECIMAL(20, digits)``.
    """
    n = _units(num, scale)
    d = _units(F.nullif(den, F.lit(0)), scale)
    mult = factor * 10 ** digits
    quotient = F.call_function(
        "div",
        (F.abs(n) * (2 * mult) + F.abs(d)).cast("decimal(38,0)"),
        (F.abs(d) * 2).cast("decimal(38,0)"),
    )
    signed = quotient * F.signum(n).cast("int") * F.signum(d).cast("int")
    return (signed.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(20,{digits})")


def margin_pct(profit_sum: Column, sales_sum: Column) -> Column:
    """Profit as a percentage of sales, two digits; NULL where sales are 0."""
    return rounded_ratio(profit_sum, sales_sum, digits=2, factor=100)


def rounded_mean(total: Column, count: Column, digits: int = 2) -> Column:
    """``ROUND(AVG(x), digits)`` from an exact sum and a count."""
    return rounded_ratio(total, count, digits=digits)
