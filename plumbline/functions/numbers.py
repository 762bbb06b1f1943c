"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def null_if_nan(value: Column | str) -> Column:
    """NaN counts as missing."""
    column = as_column(value)
    return F.when(F.isnan(column), F.lit(None)).otherwise(column)


def to_double(value: Column | str) -> Column:
    """Number or null: text that is no number, and NaN, become null."""
    return null_if_nan(as_column(value).try_cast("double"))


def summable(value: Column | str, digits: int | None) -> Column:
    """The form in which a measure is added up.

    With ``digits`` the value becomes DECIMAL(18, digits), so that a sum does not
    depend on the order in which partitions arrive, nor change when a lost task
    is run again. ``None`` adds doubles.
    """
    column = as_column(value)
    if digits is None:
        return column.cast("double")
    return column.cast(DecimalType(18, digits))


def clip(value: Column | str, low: float, high: float) -> Column:
    """Pull a value into ``[low, high]``; null stays null."""
    column = as_column(value)
    return F.when(column.isNotNull(), F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), column)))


def ratio(numerator: Column | str, denominator: Column | str, floor: float, digits: int = 2) -> Column:
    """``numerator / max(denominator, floor)``, rounded half to even."""
    below = as_column(denominator)
    bounded = F.when(below.isNotNull(), F.greatest(below, F.lit(float(floor))))
    return round_half_even(F.try_divide(as_column(numerator), bounded), digits)


def percent(part: Column, whole: Column, digits: int) -> Column:
    """Share of ``whole`` in percent; null when ``whole`` is zero or missing."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def round_half_even(value: Column, digits: int) -> Column:
    """Scaled to the digits in double arithmetic, ties to the even neighbour."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def round_up_half(value: Column, digits: int) -> Column:
    """``floor(x * 10^digits + 0.5) / 10^digits``: ties go towards plus infinity."""
    scale = float(10**digits)
    return F.floor(value * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def net_of_discount(amount: Column | str, discount: Column | str) -> Column:
    return as_column(amount) * (F.lit(1.0) - as_column(discount))


def gross_revenue(quantity: Column | str, price: Column | str, discount: Column | str) -> Column:
    """``quantity * price * (1 - discount)``, rounded half to even to two digits."""
    return round_half_even(net_of_discount(as_column(quantity) * as_column(price), discount), 2)
