"""Which part of the calendar to load, and which part is missing.

Every `as_of` is a time zone aware datetime (UTC): a naive one would be read in the zone of the driver.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlake.functions import timeslots


def date_spine(
    spark: SparkSession, start: date, end: date, as_of: datetime | None = None, until_yesterday: bool = False
) -> DataFrame:
    """Every day from `start` to `end` inclusive; prices are only final up to the day before `as_of`."""
    if until_yesterday:
        end = min(end, as_of.date() - timedelta(days=1))
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    if end < start:
        days = F.array().cast("array<date>")
    return spark.range(1).select(F.explode(days).alias("day"))


def missing_days(spine: DataFrame, df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Days of the spine without a row in `df`."""
    seen = df.select(F.to_date(ts).alias("day")).distinct()
    return spine.join(seen, "day", "left_anti")


def missing_slots(
    df: DataFrame, start: datetime, end: datetime, minutes: int, by: tuple[str, ...], ts: str = "timestamp"
) -> DataFrame:
    """Slots in `[start, end)` that a series has no row for.

    Each series expands its own slots, so there is no join of series and calendar. The expected
    rows are bounded by series and calendar, the observed ones are made distinct map-side first.
    """
    observed = df.select(*by, timeslots.floor_minutes(F.col(ts), minutes).alias("slot")).distinct()
    step = F.make_dt_interval(mins=F.lit(minutes))
    slots = F.sequence(F.lit(start), F.lit(end - timedelta(minutes=minutes)), step)
    expected = df.select(*by).distinct().withColumn("slot", F.explode(slots))
    return expected.join(observed, [*by, "slot"], "left_anti")


def gap_ranges(
    df: DataFrame, start: datetime, end: datetime, minutes: int, by: tuple[str, ...], ts: str = "timestamp"
) -> DataFrame:
    """`by, gap_from, gap_to, missing`: runs of slots in `[start, end)` that a series has no row for, `gap_to` exclusive.

    Each slot looks at the next one of its series, the two bounds stand in as slots; no calendar is expanded. Slots are
    made distinct map-side first, so a series sorts at most its slots, however many rows it has. Rows without a time
    still make a series known.
    """
    step = minutes * 60
    seconds = F.unix_seconds(F.col(ts))
    slot = (seconds - F.pmod(seconds, F.lit(step))).alias("slot")
    first, stop = (F.unix_seconds(F.lit(t).cast("timestamp")) for t in (start, end))
    inside = df.select(*by, slot).filter((F.col("slot") >= first) & (F.col("slot") < stop)).distinct()
    edges = df.select(*by).distinct().withColumn("slot", F.explode(F.array(first - step, stop)))
    series = Window.partitionBy(*by).orderBy("slot")
    steps = inside.unionByName(edges).withColumn("next", F.lead("slot").over(series))
    missing = F.expr(f"(next - slot) div {step}") - 1
    return steps.withColumn("missing", missing).filter("missing > 0").select(
        *by, F.timestamp_seconds(F.col("slot") + step).alias("gap_from"), F.timestamp_seconds("next").alias("gap_to"), "missing"
    )


def interval_bounds(as_of: datetime, minutes: int) -> tuple[datetime, datetime]:
    """The last complete interval of `minutes` before `as_of`."""
    end = as_of.replace(second=0, microsecond=0) - timedelta(minutes=as_of.minute % int(minutes))
    return end - timedelta(minutes=int(minutes)), end


def previous_interval(df: DataFrame, as_of: datetime, minutes: int = 15, ts: str = "timestamp") -> DataFrame:
    """Rows of the last complete interval. Literal bounds, so the filter reaches the scan."""
    start, end = interval_bounds(as_of, minutes)
    return df.filter((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)))


def previous_day(df: DataFrame, as_of: datetime, ts: str = "timestamp") -> DataFrame:
    """Rows of the day before `as_of`."""
    midnight = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    return df.filter((F.col(ts) >= F.lit(midnight - timedelta(days=1))) & (F.col(ts) < F.lit(midnight)))


def in_months_from(day: date) -> Column:
    """Condition on the partition columns `year` and `month`: the month of `day` or a later one."""
    return F.make_date("year", "month", F.lit(1)) >= F.lit(day.replace(day=1))


def in_months(df: DataFrame, ts: str, months: list[tuple]) -> Column:
    """Condition: `ts` lies in one of the months (year, month); the month (None, None) is that of rows without a time.

    Neighbouring months become one range, so the filter reaches the scan; columns `year` and `month`, if `df` has them,
    belong to `ts` and skip whole folders.
    """
    numbers = sorted({y * 12 + m - 1 for y, m in months if y is not None})
    condition = F.col(ts).isNull() if (None, None) in map(tuple, months) else F.lit(False)
    ends = [i for i, n in enumerate(numbers) if i + 1 == len(numbers) or numbers[i + 1] != n + 1]
    for first, last in zip([0, *[i + 1 for i in ends]], ends):
        start, stop = (F.lit(date(n // 12, n % 12 + 1, 1)).cast("timestamp") for n in (numbers[first], numbers[last] + 1))
        condition = condition | ((F.col(ts) >= start) & (F.col(ts) < stop))
    if {"year", "month"} <= set(df.columns):
        folder = F.col("year") * 12 + F.col("month") - 1
        condition = condition & (folder.isin(numbers) | folder.isNull())
    return condition


def recent(df: DataFrame, as_of: datetime, ts: str, by_month: bool = False, **span: int) -> DataFrame:
    """Rows not older than `span` (arguments of timedelta) before `as_of`, and none after it.

    A run that is repeated later, or dated back, sees what was there at its time.

    `by_month` says that the columns `year` and `month`, if there, belong to `ts`; a table
    partitioned by them then skips all older folders.
    """
    start = as_of - timedelta(**span)
    rows = df.filter((F.col(ts) >= F.lit(start)) & (F.col(ts) <= F.lit(as_of)))
    return rows.filter(in_months_from(start.date())) if by_month and {"year", "month"} <= set(df.columns) else rows


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first `n` rows in a stated order (top-n, no full sort)."""
    return df.orderBy(*order).limit(n)
