"""Bronze frames made from the general test tables `events` and `orders`.

The test tables hold no market data, so fixed rules map them to it: event types become production
types, order priorities become capacity types. Negative, missing, oversized and badly spelled
values are part of the rules, as the quality operators need them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions.timeslots import floor_minutes

# Production type by event type and parity of the user.
EVENT_TYPES = {
    "view-0": "Wind offshore",
    "view-1": "Wind onshore",
    "click-0": "Solar",
    "click-1": "Residual load",
    "signup-0": "Fossil gas",
    "signup-1": "Fossil hard coal",
    "purchase-0": "Fossil brown coal / lignite",
    "purchase-1": " hydro Run-of-River ",
    "error-0": "Nuclear",
}
OTHER_EVENT = "Biomass"

# Capacity type by order priority.
ORDER_TYPES = {
    "1-URGENT": "Wind onshore",
    "2-HIGH": "Solar gross",
    "3-MEDIUM": "Hydro Run-of-River",
    "4-NOT SPECIFIED": "Battery storage (power)",
}
OTHER_ORDER = "Fossil brown coal / lignite"


def _lookup(text: Column, table: dict[str, str], default: str) -> Column:
    case = F
    for key, label in table.items():
        case = case.when(text == key, label)
    return case.otherwise(default)


def _lineage() -> list[Column]:
    values = {"data_source": "file", "source_system": "synthetic", "ingestion_batch_id": "batch-1"}
    return [F.lit(v).alias(k) for k, v in values.items()]


def _event_country() -> Column:
    return F.when(F.col("user_id") % 3 == 0, "at").otherwise("de")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def power_from_events(df: DataFrame) -> DataFrame:
    """bronze_public_power; works on a stream as well."""
    ts, value, number = F.col("ts").cast("timestamp"), F.col("value"), F.col("event_id")
    slot = floor_minutes(ts, 15)
    name = F.concat("event_type", F.lit("-"), (F.col("user_id") % 2).cast("string"))
    measured = (
        F.when(number % 97 == 0, None)
        .when(number % 89 == 0, -value)
        .when(number % 83 == 0, value * 1000)
        .otherwise(value)
    )
    return df.select(
        number.cast("string").alias("record_id"),
        slot.alias("timestamp"),
        F.unix_seconds(slot).alias("unix_seconds"),
        _lookup(name, EVENT_TYPES, OTHER_EVENT).alias("production_type"),
        measured.alias("electricity_generated"),
        _event_country().alias("country"),
        *_lineage(),
        ts.alias("ingestion_date"),
    )


def price_from_events(df: DataFrame) -> DataFrame:
    """bronze_price: hourly, from two event types, so most hours are reported twice."""
    ts = F.col("ts").cast("timestamp")
    hourly = (
        df.filter(F.col("event_type").isin("view", "click"))
        .groupBy("event_type", _event_country().alias("country"), F.date_trunc("hour", ts).alias("timestamp"))
        .agg(F.max("value").alias("highest"), F.max(ts).alias("ingestion_date"))
    )
    seconds = F.unix_seconds("timestamp")
    return hourly.select(
        F.concat_ws("|", "event_type", "country", seconds.cast("string")).alias("record_id"),
        "timestamp",
        seconds.alias("unix_seconds"),
        (F.col("highest") - 50).cast("decimal(10,4)").alias("electricity_price"),
        F.when(F.col("event_type") == "view", "EUR/MWh").alias("electricity_unit"),
        "country",
        *_lineage(),
        "ingestion_date",
    )


def installed_from_orders(df: DataFrame) -> DataFrame:
    """bronze_installed_power: one row per order, many per month and type."""
    number, price = F.col("o_orderkey"), F.col("o_totalprice")
    ordered = F.col("o_orderdate").cast("timestamp")
    capacity = (
        F.when(number % 113 == 0, None)
        .when(number % 107 == 0, -price)
        .when(number % 103 == 0, 0.0)
        .when(number % 109 == 0, price * 50)
        .otherwise(price)
    )
    period = F.when(number % 101 == 0, "1.2000").otherwise(F.date_format(ordered, "MM.yyyy"))
    return df.select(
        number.cast("string").alias("record_id"),
        F.date_trunc("month", ordered).alias("timestamp"),
        period.alias("time_period"),
        _lookup(F.col("o_orderpriority"), ORDER_TYPES, OTHER_ORDER).alias("production_type"),
        capacity.alias("installed_capacity"),
        F.when(F.col("o_orderstatus") == "O", "de")
        .when(F.col("o_orderstatus") == "F", "at")
        .otherwise(" DE ")
        .alias("country"),
        *_lineage(),
        ordered.alias("ingestion_date"),
    )


def bronze_public_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    return power_from_events(events(spark, sf_dir))


def bronze_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_from_events(events(spark, sf_dir))


def bronze_installed_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    return installed_from_orders(orders(spark, sf_dir))
