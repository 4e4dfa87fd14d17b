"""Expressions over measured values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(value: Column) -> Column:
    """The value with NaN and infinities turned into NULL: what is no finite number counts as missing everywhere."""
    number = value.cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < float("inf")), value)


def cleansed(value: Column, digits: int = 2) -> Column:
    """Missing or negative becomes 0, the rest is rounded."""
    clean = present(value)
    return F.when(clean >= 0, F.round(clean, digits)).otherwise(0.0)


def normalised_country(country: Column) -> Column:
    return F.lower(F.trim(country))


def deviation_pct(actual: Column, expected: Column) -> Column:
    """Percent deviation, NULL where nothing was expected."""
    return F.try_divide(actual - expected, expected) * 100


def performance_status(actual: Column, severe: Column, moderate: Column) -> Column:
    return F.when(actual < severe, "Severe").when(actual < moderate, "Moderate").otherwise("Normal")
