"""Calendar and half-hour slot expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Season by month number.
SEASON_MONTHS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8)}
LAST_SEASON = "Fall"

# Monthly period text, as parsed and as the quality rule wants it.
PERIOD_FORMAT = "M.yyyy"
PERIOD_PATTERN = r"^[0-9]{2}\.[0-9]{4}$"


def floor_minutes(ts: Column, minutes: int) -> Column:
    """`ts` cut down to a multiple of `minutes`; right before 1970 too, as pmod is never negative."""
    seconds = F.unix_seconds(ts)
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(minutes * 60)))


def half_hour_marker(ts: Column, mode: str = "floor") -> Column:
    """Minute 0 or 30. `legacy15` already moves to 30 from minute 15 on."""
    edge = {"floor": 30, "legacy15": 15}[mode]
    return F.when(F.minute(ts) >= edge, 30).otherwise(0)


def half_hour_slot(ts: Column, mode: str = "floor") -> Column:
    """Start of the half hour that `half_hour_marker` names."""
    if mode == "floor":
        return floor_minutes(ts, 30)
    return floor_minutes(ts, 60) + F.make_dt_interval(mins=half_hour_marker(ts, mode))


def calendar(ts: Column, *parts: str) -> list[Column]:
    """The named parts of `ts`, each aliased to its own name."""
    source = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour, "minute": F.minute}
    return [source[part](ts).alias(part) for part in parts]


def season(month: Column) -> Column:
    """Meteorological season; December counts with the following January."""
    expr = F.lit(LAST_SEASON)
    for name, months in SEASON_MONTHS.items():
        expr = F.when(month.isin(*months), name).otherwise(expr)
    return expr


def hour_start(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def month_start(ts: Column) -> Column:
    return F.date_trunc("month", ts)


def period_start(period: Column) -> Column:
    """First instant of a `MM.YYYY` period, NULL if it is no month."""
    return F.try_to_timestamp(period, F.lit(PERIOD_FORMAT))


def period_well_formed(period: Column) -> Column:
    """Two digits, a dot, four digits. Month 13 passes; use `period_start` for a real check."""
    return period.rlike(PERIOD_PATTERN)
