"""Rounding, percents and small report formats."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round1(value: Column) -> Column:
    """One decimal by scaling and rounding half to even (6.25 gives 6.2)."""
    return F.rint(value * 10) / 10


def round1_exact(value: Column) -> Column:
    """One decimal, nearest to the value that the double stands for, as ``round(x, 1)`` in Python (0.15 gives 0.1).

    The product with ten is rounded to a double; only if that lies half-way between two integers does it matter what was
    rounded off, and that is found by splitting the value into two halves whose products are exact.
    """

    def decide(x: Column) -> Column:
        product, carried = x * 10, x * 134217729.0
        high = carried - (carried - x)
        lost = (high * 10 - product) + (x - high) * 10
        tie = F.when(lost > 0, F.ceil(product)).when(lost < 0, F.floor(product)).otherwise(F.rint(product))
        return F.when(product - F.floor(product) == 0.5, tie).otherwise(F.rint(product)) / 10

    # through a one-element array, so that the value is computed once
    return F.transform(F.array(value), decide)[0]


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def text_bar(pct: Column) -> Column:
    """One ``#`` per full two percent."""
    return F.repeat(F.lit("#"), F.floor(pct / 2).cast("int"))


def thousands(value: Column) -> Column:
    return F.format_number(value, 0)


def one_decimal(value: Column) -> Column:
    return F.format_string("%.1f", value)
