"""Column layouts of payloads and of the bronze and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "corrupt_record"

STR, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TIME, DAY, FLAG, PRICE = T.TimestampType(), T.DateType(), T.BooleanType(), T.DecimalType(10, 4)


def _struct(required: tuple[str, ...] = (), **columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, name not in required) for name, kind in columns.items()])


_SERIES = T.ArrayType(_struct(name=STR, data=T.ArrayType(DOUBLE)))

# Payloads: one JSON object of parallel arrays. A price unit may be a plain string or an array;
# read as string, an array arrives as its JSON text.
PAYLOAD = {
    "public_power": _struct(unix_seconds=T.ArrayType(LONG), production_types=_SERIES),
    "price": _struct(unix_seconds=T.ArrayType(LONG), price=T.ArrayType(PRICE), unit=STR),
    "installed_power": _struct(time=T.ArrayType(STR), production_types=_SERIES),
}

# What a landed file carries around the payload.
ENVELOPE = _struct(country=STR, payload_date=DAY, ingestion_date=TIME)

_LINEAGE = dict(country=STR, data_source=STR, source_system=STR, ingestion_batch_id=STR, ingestion_date=TIME)
BRONZE = {
    kind: _struct(("record_id",), record_id=STR, timestamp=TIME, **columns, **_LINEAGE)
    for kind, columns in {
        "public_power": dict(unix_seconds=LONG, production_type=STR, electricity_generated=DOUBLE),
        "price": dict(unix_seconds=LONG, electricity_price=PRICE, electricity_unit=STR),
        "installed_power": dict(time_period=STR, production_type=STR, installed_capacity=DOUBLE),
    }.items()
}

DIM_PRODUCTION_TYPE = _struct(
    production_type_id=STR,
    production_plant_name=STR,
    plant_family=STR,
    energy_category=STR,
    controllability_type=STR,
    description=STR,
    country=STR,
    effective_date=DAY,
    expiry_date=DAY,
    active_flag=FLAG,
    created_at=TIME,
    updated_at=TIME,
)

_CALENDAR = dict(
    record_id=STR,
    year=INT,
    month=INT,
    day=INT,
    hour=INT,
    minute=INT,
    minute_interval_30=INT,
    timestamp_30min=TIME,
    timestamp=TIME,
    production_type_id=STR,
)
FACT_POWER = _struct(
    **_CALENDAR, electricity_produced=DOUBLE, electricity_price=DOUBLE, country=STR, created_at=TIME, updated_at=TIME
)
FACT_POWER_30MIN = _struct(
    **_CALENDAR,
    avg_electricity_produced=DOUBLE,
    total_electricity_produced=DOUBLE,
    min_electricity_produced=DOUBLE,
    max_electricity_produced=DOUBLE,
    production_volatility=DOUBLE,
    data_points_count=INT,
    avg_electricity_price=DOUBLE,
    country=STR,
    created_at=TIME,
    updated_at=TIME,
)

# The measure of each bronze table.
MEASURE = {
    "public_power": "electricity_generated",
    "price": "electricity_price",
    "installed_power": "installed_capacity",
}


def known_kind(kind: str) -> str:
    """`kind` itself, or ValueError for an unknown endpoint."""
    if kind not in BRONZE:
        raise ValueError(f"unknown endpoint {kind!r}, expected one of {sorted(BRONZE)}")
    return kind


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast the columns of `schema`, in its order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def empty_table(spark, schema: T.StructType) -> DataFrame:
    """A typed table without rows."""
    return spark.createDataFrame([], schema)
