"""Quality scores, status levels, anomaly flags, expectations and summaries."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.measures import present
from gridlake.functions.timeslots import period_well_formed
from gridlake.operators import moments
from gridlake.operators.joins import lookup_join
from gridlake.operators.quantiles import group_statistics
from gridlake.workspace import materialise


@dataclass(frozen=True)
class Scale:
    """How a measure is scored, and what a valid row needs."""

    negative_score: float
    high: float
    required: tuple[str, ...]
    negative_valid: bool = False


# Score of a negative, limit above which a value is suspicious, required columns.
SCALES = {
    "public_power": Scale(0.3, 100000, ("timestamp", "production_type")),
    "price": Scale(0.1, 1000, ("timestamp",), negative_valid=True),
    "installed_power": Scale(0.0, 1000000, ("timestamp",)),
}
MISSING_SCORE, HIGH_SCORE, GOOD_SCORE = 0.0, 0.5, 1.0

# Limits of the three-level status and the 1-5 score.
LONG_NAME = 100
HUGE_CAPACITY = 100000
SIGMAS = 3
FENCE = 1.5


def _any(*conditions: Column) -> Column:
    return reduce(Column.__or__, conditions)


def _blank(*names: str) -> Column:
    return _any(*[F.col(n).isNull() | (F.col(n) == "") for n in names])


def _null(*names: str) -> Column:
    return _any(*[F.col(n).isNull() for n in names])


def score_quality(df: DataFrame, kind: str, measure: str) -> DataFrame:
    """Add `data_quality_score` (0 to 1) and `is_valid`. NaN counts as missing."""
    scale, value = SCALES[kind], present(F.col(measure))
    score = (
        F.when(value.isNull(), MISSING_SCORE)
        .when(value < 0, scale.negative_score)
        .when(value > scale.high, HIGH_SCORE)
        .otherwise(GOOD_SCORE)
    )
    valid = value.isNotNull() & ~_null(*scale.required)
    if not scale.negative_valid:
        valid = valid & F.coalesce(value >= 0, F.lit(False))
    return df.withColumns({"data_quality_score": score, "is_valid": valid})


def status_a(measure: str = "installed_capacity") -> Column:
    """ERROR, WARNING or VALID from the row alone."""
    value, period = present(F.col(measure)), F.col("time_period")
    error = _blank("record_id", "time_period", "production_type", "country") | value.isNull() | (value < 0)
    warning = ~period_well_formed(period) | (value == 0) | (F.length("production_type") > LONG_NAME)
    return F.when(error, "ERROR").when(warning, "WARNING").otherwise("VALID")


def score_a(measure: str = "installed_capacity") -> Column:
    """1 (unusable) to 5 (good) from the row alone."""
    value, period = present(F.col(measure)), F.col("time_period")
    names = ("record_id", "time_period", "production_type", "country")
    return (
        F.when(_null(*names) | value.isNull(), 1)
        .when((value < 0) | ~period_well_formed(period), 2)
        .when((value == 0) | (F.length("production_type") > LONG_NAME), 3)
        .when(~_blank(*names) & (value > 0), 5)
        .otherwise(4)
    )


def outside_fences(value: Column) -> Column:
    """Beyond the quartiles by more than 1.5 interquartile ranges; needs `q25` and `q75`."""
    reach = FENCE * (F.col("q75") - F.col("q25"))
    return F.coalesce((value < F.col("q25") - reach) | (value > F.col("q75") + reach), F.lit(False))


def z_score(value: Column) -> Column:
    """Distance from the mean in sample deviations; NULL if there is no deviation."""
    return F.try_divide(F.abs(value - F.col("mean")), F.col("deviation"))


def _idle(value: Column) -> Column:
    """Zero capacity where only storage may have none."""
    return (value == 0) & ~F.col("production_type").contains("Storage")


def status_b(measure: str = "installed_capacity") -> Column:
    """ERROR, WARNING or VALID with group statistics joined in."""
    value = present(F.col(measure))
    error = value.isNull() | (value < 0) | _null("time_period", "production_type", "country")
    blank = (F.length(F.trim("time_period")) == 0) | (F.length(F.trim("production_type")) == 0)
    warning = _idle(value) | (value > HUGE_CAPACITY) | outside_fences(value)
    return F.when(error | blank, "ERROR").when(warning, "WARNING").otherwise("VALID")


def score_b(measure: str = "installed_capacity") -> Column:
    """1 (unusable) to 5 (typical) with group statistics joined in."""
    value = present(F.col(measure))
    return (
        F.when(value.isNull() | (value < 0) | _null("time_period", "production_type"), 1)
        .when(_idle(value) | (value > HUGE_CAPACITY), 2)
        .when(outside_fences(value), 3)
        .when(z_score(value) < 1, 5)
        .otherwise(4)
    )


def flag_outliers(df: DataFrame, measure: str, over: DataFrame | None = None, stored: DataFrame | None = None) -> DataFrame:
    """Add `is_anomaly`: more than three sample deviations from the mean of the whole frame.

    `over` may be another frame with the measure, such as the full history when `df` is only its
    newest part, and `stored` moments of such a history (see `moments.refresh`). The two statistics are
    a scalar subquery: one extra scan of a single column, or of the few moments, no collect, no join.
    Without deviation nothing is flagged.
    """
    value = present(F.col(measure)).cast("double")
    if stored is None:
        rows = (df if over is None else over).select(value.alias("_v"))
        mean, deviation = F.avg("_v"), F.stddev("_v")
    else:
        rows, mean, deviation = moments.merged(stored), F.first("mean"), F.first(moments.deviation())
    stats = rows.agg(F.struct(mean.alias("mean"), deviation.alias("deviation")).alias("stats"))
    mean, reach = F.col("_stats.mean"), SIGMAS * F.col("_stats.deviation")
    far = (reach > 0) & ((value > mean + reach) | (value < mean - reach))
    return df.withColumn("_stats", stats.scalar()).withColumn("is_anomaly", F.coalesce(far, F.lit(False))).drop("_stats")


def join_statistics(df: DataFrame, by: tuple[str, ...], measure: str, null_safe: bool = False) -> DataFrame:
    """Add the group's `observations, mean, deviation, q25, q75`."""
    return lookup_join(df, materialise(group_statistics(df, by, measure), "statistics"), by, "left", null_safe)


def group_outlier(measure: str) -> Column:
    """Beyond three deviations or the quartile fences, with statistics joined in; missing is no outlier."""
    value = present(F.col(measure)).cast("double")
    return F.coalesce(z_score(value) > SIGMAS, F.lit(False)) | outside_fences(value)


def flag_group_outliers(df: DataFrame, by: tuple[str, ...], measure: str, null_safe: bool = True) -> DataFrame:
    """Add `is_anomaly` by the statistics of the row's group."""
    flagged = join_statistics(df, by, measure, null_safe).withColumn("is_anomaly", group_outlier(measure))
    return flagged.drop("observations", "mean", "deviation", "q25", "q75")


# Expectations --------------------------------------------------------------------------------


def failed_rules(rules: dict[str, Column]) -> Column:
    """Names of the rules that do not hold; an unknown outcome counts as failed."""
    return F.array_compact(
        F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()])
    )


def apply_policy(
    df: DataFrame, rules: dict[str, Column], policy: str = "flag"
) -> tuple[DataFrame, DataFrame | None]:
    """`flag` keeps all rows, `drop` removes failing ones, `quarantine` returns them as second frame."""
    checked = df.withColumn("failed_rules", failed_rules(rules))
    good, bad = F.size("failed_rules") == 0, F.size("failed_rules") > 0
    if policy == "flag":
        return checked, None
    if policy == "drop":
        return checked.filter(good).drop("failed_rules"), None
    if policy == "quarantine":
        return checked.filter(good).drop("failed_rules"), checked.filter(bad)
    raise ValueError(f"unknown policy {policy!r}")


def power_rules() -> dict[str, Column]:
    """The expectations on production rows."""
    return {
        "valid_timestamp": F.col("timestamp").isNotNull(),
        "positive_value": present(F.col("electricity_generated")) > 0,
    }


def price_rules() -> dict[str, Column]:
    """The expectations on price rows: key and value present, one known currency unit."""
    return {
        "valid_timestamp": F.col("timestamp").isNotNull(),
        "valid_country": ~_blank("country"),
        "price_present": present(F.col("electricity_price")).isNotNull(),
        "unit_present": ~_blank("electricity_unit"),
    }


def capacity_rules() -> dict[str, Column]:
    """The expectations on capacity rows: keys present, a well-formed period, a value that is not negative."""
    return {
        "valid_period": F.coalesce(period_well_formed(F.col("time_period")), F.lit(False)),
        "type_present": ~_blank("production_type"),
        "valid_country": ~_blank("country"),
        "capacity_not_negative": present(F.col("installed_capacity")) >= 0,
    }


# Summaries -----------------------------------------------------------------------------------


def validity_counts(df: DataFrame) -> DataFrame:
    """Total, valid and invalid rows."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("is_valid").alias("valid_records"),
        F.count_if(~F.col("is_valid")).alias("invalid_records"),
    )


def quality_summary(df: DataFrame, measure: str = "installed_capacity") -> DataFrame:
    """One row: rows per status, anomalies, average score, spread, coverage and load times.

    Rows are first combined per type, period and country. The distinct counts then run over that
    small table; directly over the rows each of them would multiply the input.
    """
    status, value = F.col("dq_check_status"), present(F.col(measure)).cast("double")
    groups = df.groupBy("production_type", "time_period", "country").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(status == level).alias(f"_{level}") for level in ("VALID", "WARNING", "ERROR")],
        F.count_if("is_anomaly").alias("_anomalies"),
        F.sum("dq_score").alias("_score"),
        F.count("dq_score").alias("_scored"),
        F.min("ingestion_date").alias("_first"),
        F.max("ingestion_date").alias("_last"),
    )
    # Mean and deviation of all rows come from partial moments that Spark merges, as a scalar.
    moments = df.agg(F.struct(F.avg(value).alias("mean"), F.stddev(value).alias("deviation")).alias("m")).scalar()
    return groups.agg(
        F.sum("_rows").alias("total_records"),
        F.sum("_VALID").alias("valid_records"),
        F.sum("_WARNING").alias("warning_records"),
        F.sum("_ERROR").alias("error_records"),
        F.sum("_anomalies").alias("anomaly_records"),
        F.try_divide(F.sum("_score"), F.sum("_scored")).alias("avg_dq_score"),
        F.count_distinct("production_type").alias("unique_production_types"),
        F.count_distinct("time_period").alias("unique_time_periods"),
        F.count_distinct("country").alias("unique_countries"),
        F.min("_first").alias("earliest_bronze_record"),
        F.max("_last").alias("latest_bronze_record"),
    ).select(
        "*",
        moments["mean"].alias("avg_installed_capacity"),
        moments["deviation"].alias("stddev_installed_capacity"),
    )


def silver_statistics(df: DataFrame, measure: str = "installed_capacity") -> DataFrame:
    """One row: counts, distinct keys, time range, average and sum.

    Rows are combined per business key, which contains the type, so one shuffle serves both
    distinct counts.
    """
    by_key = df.groupBy("business_key").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min("production_type").alias("production_type"),
        F.min("timestamp").alias("_first"),
        F.max("timestamp").alias("_last"),
        F.sum(present(F.col(measure))).alias("_sum"),
        F.count(present(F.col(measure))).alias("_n"),
    )
    return by_key.groupBy("production_type").agg(
        F.sum("_rows").alias("_rows"),
        F.count("business_key").alias("_keys"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        F.sum("_sum").alias("_sum"),
        F.sum("_n").alias("_n"),
    ).agg(
        F.sum("_rows").alias("total_silver_records"),
        F.sum("_keys").alias("unique_business_keys"),
        F.count("production_type").alias("unique_production_types"),
        F.min("_first").alias("earliest_timestamp"),
        F.max("_last").alias("latest_timestamp"),
        F.try_divide(F.sum("_sum"), F.sum("_n")).alias("avg_capacity"),
        F.sum("_sum").alias("total_capacity"),
    )


def post_load_checks(df: DataFrame, keys: tuple[str, ...], measure: str) -> DataFrame:
    """One row: rows, NULL keys, missing and negative measures."""
    value = present(F.col(measure))
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys],
        F.count_if(value.isNull()).alias("missing_measure"),
        F.count_if(value < 0).alias("negative_measure"),
    )
