"""Numeric expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(value: Column, places: int) -> Column:
    """Round half up, through a decimal so that summation noise cannot flip a digit.

    Values a DECIMAL(38,10) cannot hold (huge, NaN, infinite) take the plain rounding.
    """
    exact = F.round(value.try_cast("decimal(38,10)"), places).cast("double")
    return F.coalesce(exact, F.round(value, places))


def percent_change(new: Column, base: Column, places: int = 4) -> Column:
    """``(new - base) / base * 100``; NULL when the base is zero."""
    return round_to(F.try_divide(new - base, base) * 100, places)


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def to_bigint(text: Column) -> Column:
    return text.try_cast("bigint")
