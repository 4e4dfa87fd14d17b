"""Reports over the gold tables. Each returns a sorted DataFrame."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions import taxonomy, timeslots
from gridlake.operators import series
from gridlake.operators.asof import as_of_join
from gridlake.operators.joins import lookup_join
from gridlake.sources.windows import recent
from gridlake.workspace import materialise

_DAY = ("year", "month", "day")


def _with_dim(fact: DataFrame, dim: DataFrame, *columns: str) -> DataFrame:
    """Inner join with the active dimension rows: one per id, so history cannot multiply facts."""
    return lookup_join(fact, dim.filter("active_flag").select("production_type_id", *columns), ("production_type_id",), "inner")


def daily_trend(fact: DataFrame, dim: DataFrame, country: str = "de", category: str | None = None) -> DataFrame:
    """Production per day and plant name of one country, optionally of one energy category."""
    plants = dim if category is None else dim.filter(F.col("energy_category") == category)
    rows = _with_dim(fact.filter(F.col("country") == country), plants, "production_plant_name")
    return (
        rows.groupBy(*_DAY, F.col("production_plant_name").alias("production_type"))
        .agg(F.sum("electricity_produced").alias("total_daily_production"))
        .orderBy(*_DAY, "production_type")
    )


def wind_price(
    fact: DataFrame, dim: DataFrame, country: str = "de", names: tuple[str, ...] = taxonomy.WIND_TYPES
) -> DataFrame:
    """Daily production and mean price of the named plants."""
    plants = dim.filter(F.col("production_plant_name").isin(*names))
    rows = _with_dim(fact.filter(F.col("country") == country), plants, "production_plant_name")
    return (
        rows.groupBy(*_DAY, F.col("production_plant_name").alias("production_type"))
        .agg(
            F.sum("electricity_produced").alias("total_daily_production_mw"),
            F.avg("electricity_price").alias("avg_daily_price_eur_per_mwh"),
        )
        .orderBy(*_DAY, "production_type")
    )


def underperformance_features(
    agg: DataFrame, dim: DataFrame, country: str = "de", rolling: str = "rows", gap_safe: bool = False
) -> DataFrame:
    """Half-hour production with its value a day and a week ago and a weekly mean.

    `rolling="rows"` averages the last 336 rows, "slot" the same half hour of the 7 days before.
    Lags count rows by default, with `gap_safe` they look at the exact time. All windows of one
    call share one shuffle by series.
    """
    total, by = "total_electricity_produced", ("production_type_id", "country")
    rows = _with_dim(
        agg.filter(F.col("country") == country), dim, "production_plant_name", "energy_category", "controllability_type"
    )
    if gap_safe:
        day, week = series.lag_time(total, by, 86400), series.lag_time(total, by, 7 * 86400)
    else:
        day, week = series.lag_slots(total, by, series.SLOTS_PER_DAY), series.lag_slots(total, by, series.SLOTS_PER_WEEK)
    mean = {"rows": series.rolling_rows, "slot": series.rolling_same_slot}[rolling](total, by)
    return rows.select(
        "timestamp_30min",
        "production_type_id",
        "production_plant_name",
        "energy_category",
        "controllability_type",
        total,
        *_DAY,
        "hour",
        "minute_interval_30",
        day.alias("lag_1d"),
        week.alias("lag_1w"),
        mean.alias("rolling_7d_avg"),
    )


def daily_growth(fact: DataFrame, dim: DataFrame, as_of: datetime, days: int = 30, by_country: bool = False) -> DataFrame:
    """Daily production and price per plant name with the production of the previous day on record.

    With `by_country` each country is a series of its own; the original form adds them up.
    """
    country = ("country",) if by_country else ()
    rows = _with_dim(recent(fact, as_of, "timestamp", by_month=True, days=days), dim, "production_plant_name", "energy_category")
    daily = rows.groupBy(
        F.to_date("timestamp").alias("production_date"), *country, "production_plant_name", "energy_category"
    ).agg(
        F.sum("electricity_produced").alias("daily_production"),
        F.avg("electricity_price").alias("avg_daily_price"),
    )
    earlier = Window.partitionBy(*country, "production_plant_name").orderBy("production_date")
    return daily.withColumn("previous_day_production", F.lag("daily_production").over(earlier)).orderBy(
        F.desc("production_date"), F.desc("daily_production")
    )


def renewable_share(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Daily renewable and total production per country, and the share."""
    rows = _with_dim(fact, dim, "energy_category")
    renewable = F.when(F.col("energy_category") == "Renewable", F.col("electricity_produced"))
    daily = rows.groupBy("country", *_DAY).agg(
        F.sum(renewable).alias("renewable_production"), F.sum("electricity_produced").alias("total_production")
    )
    return daily.withColumn("renewable_share", F.try_divide("renewable_production", "total_production")).orderBy(
        "country", *_DAY
    )


def capacity_utilisation(
    agg: DataFrame, dim: DataFrame, installed: DataFrame, mw_per_unit: float = 1000.0, carry_forward: bool = False
) -> DataFrame:
    """Half-hour output against the capacity installed in that month.

    Raw capacity types that share a standard name are added up first, invalid (missing, negative) rows left
    out, so the join keeps one row per half hour. `mw_per_unit` converts the unit of the capacity column to MW.
    With `carry_forward` a month without a record has the last capacity known before it.
    """
    by = ("production_type", "country", "_month")
    valid = installed.filter("is_valid") if "is_valid" in installed.columns else installed
    capacity = valid.groupBy(
        "production_type", "country", timeslots.month_start(F.col("timestamp")).alias("_month")
    ).agg((F.sum("installed_power") * mw_per_unit).alias("installed_mw"))
    rows = _with_dim(agg, dim, "production_plant_name").withColumns(
        {"production_type": F.col("production_plant_name"), "_month": timeslots.month_start(F.col("timestamp_30min"))}
    )
    if carry_forward:
        met = as_of_join(rows, capacity, by[:2], "_month", ("installed_mw",), "_month", bucket="year")
    else:
        met = lookup_join(rows, materialise(capacity, "capacity"), by)
    return met.select(
        "timestamp_30min",
        "production_type",
        "country",
        "avg_electricity_produced",
        "installed_mw",
        F.try_divide("avg_electricity_produced", "installed_mw").alias("utilisation"),
    )
