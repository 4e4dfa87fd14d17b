"""Lags and moving averages over half-hour series.

A window here holds one series: one row per half hour, 17,568 a year at most, however many raw
rows lie behind them. That bounds a task by the calendar, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

# Half hours per day and per week.
SLOTS_PER_DAY = 48
SLOTS_PER_WEEK = 336

_DAY, _HALF_HOUR = 86400, 1800


def lag_slots(value: str, series: tuple[str, ...], slots: int, order: str = "timestamp_30min") -> Column:
    """Value so many rows earlier; a gap in the series shifts it."""
    return F.lag(value, slots).over(Window.partitionBy(*series).orderBy(order))


def lag_time(value: str, series: tuple[str, ...], seconds: int, order: str = "timestamp_30min") -> Column:
    """Value exactly so long ago, NULL if that slot is missing."""
    window = Window.partitionBy(*series).orderBy(F.unix_seconds(order)).rangeBetween(-seconds, -seconds)
    return F.max(value).over(window)


def rolling_rows(value: str, series: tuple[str, ...], rows: int = SLOTS_PER_WEEK, order: str = "timestamp_30min") -> Column:
    """Mean of the last `rows` rows including this one; missing values are skipped."""
    window = Window.partitionBy(*series).orderBy(order).rowsBetween(1 - rows, Window.currentRow)
    return F.avg(value).over(window)


def rolling_same_slot(value: str, series: tuple[str, ...], days: int = 7, order: str = "timestamp_30min") -> Column:
    """Mean of the same half hour over the preceding days, without this one."""
    window = (
        Window.partitionBy(*series, "hour", "minute_interval_30")
        .orderBy(F.unix_seconds(order))
        .rangeBetween(-days * _DAY, -_HALF_HOUR)
    )
    return F.avg(value).over(window)
