"""Silver to gold: the dimension and the two facts.

Arguments named `dim` are stored tables, see `lookup_join`.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.functions import keys, measures, taxonomy, timeslots
from gridlake.operators.asof import as_of_join
from gridlake.operators.joins import lookup_join
from gridlake.workspace import materialise


def dim_production_type(typed: list[DataFrame], as_of: datetime, naming: str = "fine") -> DataFrame:
    """One row per plant name and country found in the given frames.

    Silver tables serve, and so do the `type_pairs` of bronze frames. With `naming="family"`
    several types share one family name, and the distinct after mapping keeps one row for them.
    """
    pairs = reduce(DataFrame.unionByName, [df.select("production_type", "country") for df in typed]).distinct()
    known = pairs.filter(F.col("production_type").isNotNull())
    mapped = known.select(
        "production_type", "country", taxonomy.production_attributes(F.col("production_type")).alias("_a")
    ).select("production_type", "country", "_a.*")
    mapped = mapped.withColumnRenamed("production_plant_name", "plant_family")
    if naming == "family":
        rows = mapped.withColumn("production_plant_name", F.col("plant_family")).drop("production_type").distinct()
    else:
        rows = mapped.withColumnRenamed("production_type", "production_plant_name")
    rows = rows.withColumns(
        {
            "production_type_id": F.sha2(F.concat_ws("_", "production_plant_name", "country"), 256),
            "effective_date": F.lit(as_of.date()),
            "expiry_date": F.lit(None),
            "active_flag": F.lit(True),
            "created_at": F.lit(as_of),
            "updated_at": F.lit(None),
        }
    )
    return schemas.conform(rows, schemas.DIM_PRODUCTION_TYPE)


def hourly_price(price: DataFrame) -> DataFrame:
    """One price per country and hour: finer prices are averaged, so the join cannot multiply rows."""
    return price.groupBy("country", timeslots.hour_start(F.col("timestamp")).alias("_price_time")).agg(
        F.avg(F.col("electricity_price").cast("double")).alias("electricity_price")
    )


def with_price(power: DataFrame, price: DataFrame, mode: str = "hour", how: str = "left") -> DataFrame:
    """Add `electricity_price` by exact timestamp or by the hour, and country."""
    if mode == "hour":
        prices, time = hourly_price(price), timeslots.hour_start(F.col("timestamp"))
    else:
        prices = price.select(
            "country", F.col("timestamp").alias("_price_time"), F.col("electricity_price").cast("double").alias("electricity_price")
        )
        time = F.col("timestamp")
    prices = materialise(prices, "prices")
    return lookup_join(power.withColumn("_price_time", time), prices, ("country", "_price_time"), how).drop("_price_time")


def with_plant(power: DataFrame, dim: DataFrame, how: str = "left", columns: tuple[str, ...] = ()) -> DataFrame:
    """Add `production_type_id` (and other columns) of the active dimension row."""
    plants = dim.filter("active_flag").select(
        F.col("production_plant_name").alias("production_type"), "country", "production_type_id", *columns
    )
    return lookup_join(power, plants, ("production_type", "country"), how)


def with_plant_as_of(power: DataFrame, dim: DataFrame, columns: tuple[str, ...], time: str = "timestamp") -> DataFrame:
    """Add `production_type_id` and other columns of the dimension row that was valid at the time of the production.

    The first row of a plant also holds for what was produced before it was known.
    """
    plants = dim.withColumnRenamed("production_plant_name", "production_type")
    return as_of_join(
        power,
        plants,
        ("production_type", "country"),
        time,
        ("production_type_id", *columns),
        "effective_date",
        "expiry_date",
        extend_first=True,
    )


def fact_power(
    power: DataFrame,
    price: DataFrame,
    dim: DataFrame,
    as_of: datetime,
    price_join: str = "hour",
    slot_mode: str = "floor",
    type_key: str = "raw_type",
) -> DataFrame:
    """Every silver production row with its type id, price and half hour; row count is unchanged."""
    ts = F.col("timestamp")
    rows = with_price(with_plant(power, dim), price, price_join)
    rows = rows.withColumns(
        {
            "record_id": keys.hashed_key(ts, F.col(type_key), F.col("country")),
            "minute": F.minute(ts),
            "minute_interval_30": timeslots.half_hour_marker(ts, slot_mode),
            "timestamp_30min": timeslots.half_hour_slot(ts, slot_mode),
            "electricity_produced": F.col("electricity_generated"),
            "created_at": F.lit(as_of),
            "updated_at": F.lit(as_of),
        }
    )
    return schemas.conform(rows, schemas.FACT_POWER)


def fact_power_enriched(power: DataFrame, price: DataFrame, dim: DataFrame) -> DataFrame:
    """The designed fact: only rows with a price of their hour, a known plant and a non-negative value."""
    ts, value = F.col("timestamp"), measures.present(F.col("electricity_generated"))
    valid = power.filter(value >= 0)
    plants = with_plant(valid, dim, "inner", ("energy_category", "controllability_type"))
    return with_price(plants, price, "hour", "inner").select(
        *timeslots.calendar(ts, "year", "month", "day", "hour", "minute"),
        timeslots.half_hour_marker(ts).alias("minute_interval_30"),
        timeslots.half_hour_slot(ts).alias("timestamp_30min"),
        timeslots.floor_minutes(ts, 5).alias("minute_rounded"),
        "timestamp",
        "production_type_id",
        "energy_category",
        "controllability_type",
        F.col("electricity_generated").alias("electricity_produced"),
        "electricity_price",
        "country",
    )


def production_metrics(points: Column | None = None) -> list[Column]:
    """The aggregates of a half hour; `points` replaces the count of non-missing values.

    All combine map-side, so a hot series costs no more than others after the shuffle.
    """
    produced = measures.present(F.col("electricity_produced"))
    return [
        F.avg(produced).alias("avg_electricity_produced"),
        F.sum(produced).alias("total_electricity_produced"),
        F.min(produced).alias("min_electricity_produced"),
        F.max(produced).alias("max_electricity_produced"),
        F.stddev(produced).alias("production_volatility"),
        (F.count(produced) if points is None else points).alias("data_points_count"),
        F.avg("electricity_price").alias("avg_electricity_price"),
    ]


def fact_power_30min(fact: DataFrame, as_of: datetime) -> DataFrame:
    """The fact per type, country and true half hour."""
    slot = F.col("timestamp_30min")
    rows = (
        fact.withColumns(
            {
                "timestamp_30min": timeslots.half_hour_slot(F.col("timestamp")),
                "minute_interval_30": timeslots.half_hour_marker(F.col("timestamp")),
            }
        )
        .groupBy("production_type_id", "country", "timestamp_30min")
        .agg(
            F.min("minute_interval_30").alias("minute_interval_30"),
            F.min("timestamp").alias("timestamp"),
            *production_metrics(),
        )
    )
    rows = rows.withColumns(
        {
            "record_id": keys.hashed_key(F.col("production_type_id"), F.col("country"), slot),
            "created_at": F.lit(as_of),
            "updated_at": F.lit(None),
        }
    ).select("*", *timeslots.calendar(slot, "year", "month", "day", "hour", "minute"))
    return schemas.conform(rows, schemas.FACT_POWER_30MIN)


def fact_power_30min_enriched(enriched: DataFrame) -> DataFrame:
    """The designed aggregate: category columns in the key, all rows counted."""
    by = ("year", "month", "day", "hour", "minute_interval_30", "timestamp_30min", "production_type_id")
    grouped = enriched.groupBy(*by, "energy_category", "controllability_type", "country")
    return grouped.agg(*production_metrics(F.count(F.lit(1))))
