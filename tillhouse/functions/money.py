"""Exact money arithmetic.

Floating-point sums depend on the order in which rows meet, so two runs over the same data may differ in the last
digit.  Amounts are therefore turned into whole units (millionths, unless a scale says otherwise), summed exactly, and
rounded to cents once, after adding.  Every rounding is half away from zero on integers.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WHOLE = "decimal(20,0)"
TOTAL = "decimal(30,0)"  # sums in units

SCALE = 6  # decimals of an amount that count


def to_units(amount: Column, scale: int = 2) -> Column:
    """Whole number of ``10**-scale`` units; ``scale`` is the number of decimals the data carries (2 or more).

    The cast cuts off decimals, so adding a half before rounds; ``round`` on doubles costs twice the time, as it goes
    through decimals.  A value that is no number fails the job in ANSI mode.
    """
    units = amount.cast("double") * F.lit(10**scale)
    return (units + F.when(units < 0, F.lit(-0.5)).otherwise(F.lit(0.5))).cast("bigint")


def total_units(amount: Column, scale: int = SCALE) -> Column:
    """Aggregate: the exact sum of the amounts in units of ``10**-scale``.

    Whole currency and the rest of each amount are added apart, both as plain integers: a sum in units would leave the
    bigint range at ``9.2e18`` units, and a sum of decimals takes more time per row.
    """
    units, base = to_units(amount, scale), F.lit(10**scale).cast("bigint")
    whole = F.sum(F.call_function("div", units, base)).cast(WHOLE)
    return whole * F.lit(10**scale).cast(f"decimal({scale + 1},0)") + F.sum(units % base).cast(WHOLE)


def divide_half_up(numerator: Column, denominator: Column) -> Column:
    """Integer quotient rounded half away from zero; null when either side is null or the denominator is zero.

    The division is done on decimals, so totals near the bigint limit times 10,000 (percentages) do not overflow.
    """
    den = F.abs(F.nullif(denominator.cast(WHOLE), F.lit(0).cast(WHOLE)))
    magnitude = F.call_function("div", F.abs(numerator) * 2 + den, den * 2)
    return F.when((numerator < 0) != (denominator < 0), -magnitude).otherwise(magnitude)


def units_to_cents(units: Column, scale: int = 2) -> Column:
    return units.cast("bigint") if scale == 2 else divide_half_up(units.cast(TOTAL), F.lit(10 ** (scale - 2)))


def from_cents(cents: Column) -> Column:
    return cents.cast("double") / F.lit(100.0)


def money(units: Column, scale: int = 2) -> Column:
    """Units as a double with two decimals."""
    return from_cents(units_to_cents(units, scale))


def mean_cents(units: Column, count: Column, scale: int = 2) -> Column:
    """Mean of ``count`` amounts in cents; null for an empty set."""
    return divide_half_up(units.cast(TOTAL), count.cast(WHOLE) * F.lit(10 ** (scale - 2)))


def percent(part: Column, whole: Column) -> Column:
    """``part / whole`` as a percentage with two decimals; null when ``whole`` is zero or null."""
    return from_cents(divide_half_up(part.cast(WHOLE) * F.lit(10_000), whole))
