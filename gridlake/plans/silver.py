"""Bronze to silver."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions import keys, measures, taxonomy, timeslots
from gridlake.operators import merge, quality
from gridlake.operators.dedup import keep_latest
from gridlake.sources.windows import recent

# Constants of the silver tables.
POWER_UNIT = "MW"
CAPACITY_UNIT = "GW"
CURRENCY = "EUR"
MARKET = "EPEX_SPOT"
PRICE_UNIT = "EUR/MWh"
CREATED_BY = "bronze_to_silver_installed_power_pipeline"

NEWEST = ("ingestion_timestamp", "bronze_record_id")


def _processing(as_of: datetime, batch_id: str) -> dict[str, Column]:
    return {"silver_batch_id": F.lit(batch_id), "processing_timestamp": F.lit(as_of)}


def _type_key(dedup_on: str) -> str:
    """Column that stands for the production type in keys.

    Standard names merge distinct series (all wind, all fossil), so keys use the raw name by
    default; "standardized" merges them on purpose.
    """
    return {"raw": "raw_type", "standardized": "production_type"}[dedup_on]


def _typed(bronze: DataFrame, taxonomy_name: str) -> DataFrame:
    """Add `raw_type` and replace the type by its standard name."""
    name, key = F.col("production_type"), F.col("raw_type")
    keyed = bronze.withColumn("raw_type", taxonomy.raw_type_key(name))
    return keyed.withColumn("production_type", taxonomy.standardize_type(name, taxonomy_name, key))


def type_pairs(bronze: DataFrame, taxonomy_name: str = "fine") -> DataFrame:
    """Standard type and country of everything found in a bronze frame.

    Made distinct before the rules apply: they then see a handful of names, and the scan reads two
    columns. Deduplication by time keeps every pair, so this equals the pairs of the silver table.
    """
    pairs = bronze.select("production_type", measures.normalised_country(F.col("country")).alias("country")).distinct()
    return _typed(pairs, taxonomy_name).select("production_type", "country")


def _keyed(bronze: DataFrame, *columns: str) -> DataFrame:
    """The bronze columns silver is made of, with the raw type key. Narrow on purpose: this is what
    the dedup sorts and shuffles, everything derived is added to the surviving rows."""
    return bronze.select(
        "timestamp",
        "production_type",
        taxonomy.raw_type_key(F.col("production_type")).alias("raw_type"),
        *columns,
        measures.normalised_country(F.col("country")).alias("country"),
        "source_system",
        F.col("record_id").alias("bronze_record_id"),
        F.col("ingestion_date").alias("ingestion_timestamp"),
    )


def _standard(rows: DataFrame, taxonomy_name: str) -> DataFrame:
    standard = taxonomy.standardize_type(F.col("production_type"), taxonomy_name, F.col("raw_type"))
    return rows.withColumn("production_type", standard)


def _latest(rows: DataFrame, taxonomy_name: str, dedup_on: str) -> tuple[DataFrame, tuple[str, ...]]:
    """Newest row per time, type and country with the standard type, and the key columns."""
    by = ("timestamp", _type_key(dedup_on), "country")
    if dedup_on == "raw":
        return _standard(keep_latest(rows, by, *NEWEST), taxonomy_name), by
    return keep_latest(_standard(rows, taxonomy_name), by, *NEWEST), by


def _finite(rows: DataFrame, measure: str) -> DataFrame:
    """NaN and infinities end here: sums and means of the later tables meet NULL only."""
    return rows.withColumn(measure, measures.present(F.col(measure)))


def _power_columns(rows: DataFrame) -> DataFrame:
    return rows.select("*", *timeslots.calendar(F.col("timestamp"), "year", "month", "day", "hour"), F.lit(POWER_UNIT).alias("unit"))


def _capacity_columns(rows: DataFrame) -> DataFrame:
    return rows.select("*", *timeslots.calendar(F.col("timestamp"), "year", "month"), F.lit(CAPACITY_UNIT).alias("unit"))


def standardized_power(bronze: DataFrame, taxonomy_name: str = "fine") -> DataFrame:
    """Production rows under silver names, types standardised, not deduplicated."""
    return _power_columns(_standard(_keyed(bronze, "electricity_generated"), taxonomy_name))


def standardized_capacity(bronze: DataFrame, taxonomy_name: str = "fine") -> DataFrame:
    """Capacity rows under silver names, types standardised, not deduplicated."""
    rows = _keyed(bronze, "installed_capacity", "time_period").withColumnRenamed("installed_capacity", "installed_power")
    return _capacity_columns(_standard(rows, taxonomy_name))


def silver_public_power(
    bronze: DataFrame,
    as_of: datetime,
    batch_id: str = "batch",
    history: DataFrame | None = None,
    taxonomy_name: str = "fine",
    dedup_on: str = "raw",
    moments: DataFrame | None = None,
) -> DataFrame:
    """Standardise, score, flag outliers, keep the latest row per time, type and country.

    Outliers are measured against stored `moments` or `history` (a bronze frame) if given, else against all of `bronze`.
    """
    rows, by = _latest(_keyed(bronze, "electricity_generated"), taxonomy_name, dedup_on)
    rows = _finite(rows, "electricity_generated")
    rows = quality.score_quality(_power_columns(rows), "public_power", "electricity_generated")
    rows = quality.flag_outliers(rows, "electricity_generated", bronze if history is None else history, moments)
    return rows.withColumns({"business_key": keys.joined_key(*map(F.col, by)), **_processing(as_of, batch_id)})


def silver_price(
    bronze: DataFrame,
    as_of: datetime,
    batch_id: str = "batch",
    history: DataFrame | None = None,
    moments: DataFrame | None = None,
) -> DataFrame:
    """Score, flag outliers (see `silver_public_power`), keep the latest row per time and country."""
    by = ("timestamp", "country")
    rows = bronze.select(
        "timestamp",
        "electricity_price",
        measures.normalised_country(F.col("country")).alias("country"),
        "electricity_unit",
        "source_system",
        F.col("record_id").alias("bronze_record_id"),
        F.col("ingestion_date").alias("ingestion_timestamp"),
    )
    rows = keep_latest(rows, by, *NEWEST).select(
        "timestamp",
        "electricity_price",
        F.lit(CURRENCY).alias("currency"),
        F.lit(MARKET).alias("market"),
        *timeslots.calendar(F.col("timestamp"), "year", "month", "day"),
        "country",
        F.coalesce("electricity_unit", F.lit(PRICE_UNIT)).alias("unit"),
        "source_system",
        "bronze_record_id",
        "ingestion_timestamp",
    )
    rows = quality.score_quality(rows, "price", "electricity_price")
    rows = quality.flag_outliers(rows, "electricity_price", bronze if history is None else history, moments)
    return rows.withColumns({"business_key": keys.joined_key(*map(F.col, by)), **_processing(as_of, batch_id)})


def silver_installed_power(
    bronze: DataFrame,
    as_of: datetime,
    batch_id: str = "batch",
    history: DataFrame | None = None,
    taxonomy_name: str = "fine",
    dedup_on: str = "raw",
    moments: DataFrame | None = None,
) -> DataFrame:
    """Standardise, score, keep the latest per month, type and country. No outlier flag, so no use of `history` or `moments`."""
    rows = _keyed(bronze, "installed_capacity", "time_period").withColumnRenamed("installed_capacity", "installed_power")
    rows, by = _latest(rows, taxonomy_name, dedup_on)
    rows = _finite(rows, "installed_power")
    rows = quality.score_quality(_capacity_columns(rows), "installed_power", "installed_power")
    return rows.withColumns({"business_key": keys.joined_key(*map(F.col, by)), **_processing(as_of, batch_id)})


def _audited(rows: DataFrame, as_of: datetime, batch_id: str, updated: Column) -> DataFrame:
    """The columns of the capacity table with quality and audit fields."""
    return rows.select(
        "record_id",
        "business_key",
        "timestamp",
        "time_period",
        "production_type",
        "installed_capacity",
        "country",
        "data_source",
        "source_system",
        "dq_check_status",
        F.lit(as_of).alias("dq_check_date"),
        "dq_score",
        "is_anomaly",
        "bronze_record_id",
        F.lit(batch_id).alias("silver_batch_id"),
        F.lit(as_of).alias("silver_ingestion_date"),
        F.lit(CREATED_BY).alias("created_by"),
        updated.alias("last_updated"),
    )


def checked_capacity_a(bronze: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    """Recent capacity rows with status, score and outlier flag per raw type, then normalised."""
    rows = recent(bronze, as_of, "ingestion_date", days=days)
    rows = rows.withColumns({"dq_check_status": quality.status_a(), "dq_score": quality.score_a()})
    rows = quality.flag_group_outliers(rows, ("production_type",), "installed_capacity")
    return rows.withColumns(
        {
            "production_type": taxonomy.standardize_type(F.col("production_type")),
            "installed_capacity": measures.cleansed(F.col("installed_capacity")),
            "country": measures.normalised_country(F.col("country")),
        }
    ).withColumnRenamed("record_id", "bronze_record_id")


def silver_installed_power_a(
    bronze: DataFrame, as_of: datetime, batch_id: str = "batch", days: int = 30
) -> DataFrame:
    """Capacity table by row checks: errors are left out, the latest row per business key is kept."""
    by = ("time_period", "production_type", "country")
    rows = checked_capacity_a(bronze, as_of, days).filter(F.col("dq_check_status").isin("VALID", "WARNING"))
    rows = keep_latest(rows, by, "ingestion_date", "bronze_record_id")
    rows = rows.withColumn("business_key", keys.period_key(*map(F.col, by)))
    rows = rows.withColumn("record_id", keys.hashed_key(F.col("business_key")))
    return _audited(rows, as_of, batch_id, F.lit(as_of))


def checked_capacity_b(bronze: DataFrame) -> DataFrame:
    """Normalised capacity rows with status, score and outlier flag per type and country."""
    rows = bronze.withColumns(
        {
            "production_type": taxonomy.standardize_type(F.col("production_type")),
            "country": measures.normalised_country(F.col("country")),
        }
    )
    rows = quality.join_statistics(rows, ("production_type", "country"), "installed_capacity")
    rows = rows.withColumns(
        {
            "is_anomaly": quality.group_outlier("installed_capacity"),
            "dq_check_status": quality.status_b(),
            "dq_score": quality.score_b(),
        }
    )
    return rows.drop("observations", "mean", "deviation", "q25", "q75").withColumnRenamed("record_id", "bronze_record_id")


def silver_installed_power_b(
    bronze: DataFrame, as_of: datetime, batch_id: str = "batch", existing: DataFrame | None = None
) -> DataFrame:
    """Capacity table by group statistics: errors left out, only business keys not yet `existing` added."""
    rows = checked_capacity_b(bronze).filter(F.col("dq_check_status") != "ERROR")
    key = keys.period_key(F.col("time_period"), F.col("production_type"), F.col("country"), underscored=True)
    rows = keep_latest(rows.withColumn("business_key", key), ("business_key",), "ingestion_date", "bronze_record_id")
    rows = rows.withColumns(
        {
            "record_id": keys.uuid_shaped(F.col("business_key")),
            "timestamp": timeslots.period_start(F.col("time_period")),
        }
    )
    new = _audited(rows, as_of, batch_id, F.lit(None).cast("timestamp"))
    return new if existing is None else merge.insert_absent(existing, new, ("business_key",), "bronze_record_id")
