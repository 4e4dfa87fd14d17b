"""Seasonal baselines and underperformance."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions import measures, timeslots
from gridlake.operators.joins import lookup_join
from gridlake.sources.windows import recent

# Thresholds in deviations below the mean.
MODERATE, SEVERE = 1.5, 2.0

SLOT_KEYS = ("production_type_id", "hour", "minute_interval_30", "day_of_week", "season")


def slots(agg: DataFrame) -> DataFrame:
    """Weekday (Sunday is 1) and season of each half hour."""
    return agg.withColumns(
        {"day_of_week": F.dayofweek("timestamp_30min"), "season": timeslots.season(F.month("timestamp_30min"))}
    )


def performance_baseline(
    agg: DataFrame,
    dim: DataFrame,
    as_of: datetime,
    days: int = 90,
    min_observations: int = 10,
    moderate: float = MODERATE,
    severe: float = SEVERE,
) -> DataFrame:
    """Typical production per plant, half hour, weekday and season over the last `days`.

    A group has at most one value a week, so its exact percentiles stay tiny. The plant columns
    depend on the id and are joined after the aggregation.
    """
    produced = F.col("avg_electricity_produced")
    midnight = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    history = slots(recent(agg, midnight, "timestamp_30min", by_month=True, days=days))
    grouped = history.groupBy(*SLOT_KEYS).agg(
        F.avg(produced).alias("baseline_avg_production"),
        F.percentile(produced, F.lit(0.5)).alias("baseline_median_production"),
        F.percentile(produced, F.lit(0.25)).alias("baseline_p25_production"),
        F.percentile(produced, F.lit(0.75)).alias("baseline_p75_production"),
        F.stddev(produced).alias("baseline_std_production"),
        F.count(F.lit(1)).alias("historical_observations"),
    )
    enough = grouped.filter(F.col("historical_observations") >= min_observations)

    return with_thresholds(enough, dim, as_of, moderate, severe)


def with_thresholds(groups: DataFrame, dim: DataFrame, as_of: datetime, moderate: float = MODERATE, severe: float = SEVERE) -> DataFrame:
    """Add the plant columns, which depend on the id, and the limits of underperformance."""

    def below(deviations: float) -> Column:
        return F.col("baseline_avg_production") - F.col("baseline_std_production") * deviations

    plants = dim.filter("active_flag").select("production_type_id", "energy_category", "controllability_type")
    return lookup_join(groups, plants, ("production_type_id",), "left").withColumns(
        {
            "underperformance_threshold_moderate": below(moderate),
            "underperformance_threshold_severe": below(severe),
            "underperformance_threshold_quartile": F.col("baseline_p25_production"),
            "created_at": F.lit(as_of),
            "updated_at": F.lit(None).cast("timestamp"),
        }
    )


def underperformance(
    agg: DataFrame, baseline: DataFrame, dim: DataFrame, as_of: datetime, hours: int = 4
) -> DataFrame:
    """Recent half hours clearly below their baseline, worst deviation first within a half hour.

    The baseline also depends on weekday and season, so both are join keys: without them a half
    hour would meet all of its weekdays.
    """
    plants = dim.filter("active_flag").select("production_type_id", "production_plant_name", "controllability_type")
    now = lookup_join(slots(recent(agg, as_of, "timestamp_30min", by_month=True, hours=hours)), plants, ("production_type_id",), "inner")
    expected = baseline.select(
        *SLOT_KEYS,
        "baseline_avg_production",
        "underperformance_threshold_moderate",
        "underperformance_threshold_severe",
    )
    actual = F.col("avg_electricity_produced")
    status = measures.performance_status(
        actual, F.col("underperformance_threshold_severe"), F.col("underperformance_threshold_moderate")
    )
    return (
        now.join(expected, list(SLOT_KEYS))
        .select(
            "timestamp_30min",
            "production_plant_name",
            "country",
            "controllability_type",
            actual.alias("actual_production"),
            F.col("baseline_avg_production").alias("expected_production"),
            status.alias("performance_status"),
            measures.deviation_pct(actual, F.col("baseline_avg_production")).alias("deviation_pct"),
        )
        .filter(F.col("performance_status").isin("Severe", "Moderate"))
        .orderBy(F.desc("timestamp_30min"), F.asc("deviation_pct"))
    )
