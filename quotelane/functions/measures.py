"""Arithmetic on measures."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_difference(reference: Column, other: Column) -> Column:
    """|reference - other| in percent of ``reference``; 0 unless ``reference`` > 0."""
    gap = 100 * F.abs(reference - other) / reference
    return F.when(reference > 0, gap).otherwise(F.lit(0.0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL where the denominator is 0."""
    return F.try_divide(numerator, denominator)
