"""Exact money and ratios.

Dollars are DECIMAL(18,2) made from integer cents, never a double. Ratios are
rounded half up in integer arithmetic, so any engine gives the same digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents_to_dollars(cents: Column | str) -> Column:
    """DECIMAL(18,2) dollars; null when the value does not fit, never an error."""
    column = F.col(cents) if isinstance(cents, str) else cents
    exact = column.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")
    return exact.try_cast("decimal(18,2)")


def _div(numerator: Column, denominator: Column) -> Column:
    return F.call_function("div", numerator, denominator)


def percent(part: Column, whole: Column) -> Column:
    """`100 * part / whole` as DECIMAL(9,3), rounded half up; null when whole is 0."""
    whole = F.nullif(whole.cast("bigint"), F.lit(0).cast("bigint"))
    thousandths = _div(part.cast("bigint") * 200_000 + whole, whole * 2)
    return (thousandths.cast("decimal(12,0)") * F.lit("0.001").cast("decimal(4,3)")).cast("decimal(9,3)")


def average_dollars(volume: Column, rows: Column) -> Column:
    """Mean of a dollar sum over `rows` as DECIMAL(18,2), rounded half away from zero."""
    cents = (F.abs(volume) * 100).cast("decimal(36,0)")
    count = F.nullif(rows.cast("decimal(19,0)"), F.lit(0).cast("decimal(19,0)"))
    rounded = _div(cents * 2 + count, count * 2) * F.sign(volume).cast("bigint")
    return cents_to_dollars(rounded)
