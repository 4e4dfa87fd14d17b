"""JSON payloads of parallel arrays to bronze rows.

Everything here is a narrow transformation: a payload is unpacked inside the task that read it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.functions import keys, timeslots

# Fixed value: price unit where the payload names none.
DEFAULT_PRICE_UNIT = "EUR/MWh"

# The array that holds the times, and the one that holds the values.
_TIME_ARRAY = {"public_power": "unix_seconds", "price": "unix_seconds", "installed_power": "time"}
_VALUE_ARRAY = {"public_power": "production_types", "price": "price", "installed_power": "production_types"}


def parse_payloads(df: DataFrame, kind: str, column: str = "payload") -> DataFrame:
    """Decode the JSON text in `column` into the arrays of `kind`; the text stays for reject reports.

    `inline` makes the decoding a step of its own. As a plain column, a filter on its fields would
    be pushed below it and decode every text again.
    """
    schema = schemas.PAYLOAD[schemas.known_kind(kind)]
    decoded = F.from_json(
        F.col(column),
        f"{schema.simpleString()[:-1]},{schemas.CORRUPT}:string>",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT},
    )
    return df.select("*", F.inline(F.array(decoded)))


def _filled(column: str) -> Column:
    return F.coalesce(F.size(column), F.lit(0)) > 0


def reject_reason(kind: str, columns: list[str]) -> Column:
    """Why a payload cannot be used, NULL if it can.

    A payload is empty only if both arrays are missing or empty. One that has times but no value
    array at all is an error too, except for capacity, where it just yields nothing.
    """
    times, values = _TIME_ARRAY[schemas.known_kind(kind)], _VALUE_ARRAY[kind]
    reason = F.when(~_filled(times) & ~_filled(values), "empty payload")
    if schemas.CORRUPT in columns:
        reason = F.when(F.col(schemas.CORRUPT).isNotNull(), "not an object").otherwise(reason)
    if kind != "installed_power":
        reason = F.coalesce(reason, F.when(F.col(values).isNull(), f"missing {values}"))
    return reason


def check_payloads(df: DataFrame, kind: str) -> DataFrame:
    """Add `reject_reason`."""
    return df.withColumn("reject_reason", reject_reason(kind, df.columns))


def usable(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reject_reason").isNull()).drop("reject_reason", schemas.CORRUPT)


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reject_reason").isNotNull())


def validate_payloads(df: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """Usable payloads, and the rest with a `reject_reason`."""
    checked = check_payloads(df, kind)
    return usable(checked), rejected(checked)


def zip_shortest(*columns: Column) -> Column:
    """`arrays_zip` cut to the shortest array instead of padded with NULL."""
    length = F.least(*[F.size(c) for c in columns]) if len(columns) > 1 else F.size(columns[0])
    return F.slice(F.arrays_zip(*columns), F.lit(1), F.greatest(length, F.lit(0)))


def _content(*arrays: str) -> Column:
    """Stands for the payload a row came from."""
    return F.xxhash64(*arrays).alias("_payload")


def _numbered(rows: Column) -> Column:
    """The elements of a zipped array with their position."""
    return F.transform(rows, lambda row, i: row.withField("_position", i))


def _series(payloads: DataFrame, times: str) -> DataFrame:
    """One row per well-formed production type; those without name or data are skipped."""
    return (
        payloads.select("country", "ingestion_date", times, _content(times, "production_types"), F.posexplode("production_types").alias("_at", "_s"))
        .filter(F.col("_s.name").isNotNull() & F.col("_s.data").isNotNull())
        .select("country", "ingestion_date", times, "_payload", "_at", F.col("_s.name").alias("production_type"), F.col("_s.data").alias("data"))
    )


def explode_public_power(payloads: DataFrame) -> DataFrame:
    """One row per type and time; a type with fewer or more values than times is cut."""
    return (
        _series(payloads, "unix_seconds")
        .select("country", "ingestion_date", "_payload", "_at", "production_type", F.inline(_numbered(zip_shortest(F.col("unix_seconds"), F.col("data")))))
        .withColumnRenamed("data", "electricity_generated")
        .withColumn("timestamp", F.timestamp_seconds("unix_seconds"))
    )


def explode_price(payloads: DataFrame) -> DataFrame:
    """One row per time. A unit array is paired by position, a plain unit applies to every row."""
    is_array = F.col("unit").startswith("[")
    units = F.when(is_array, F.from_json(F.when(is_array, F.col("unit")), "array<string>")).otherwise(
        F.array_repeat("unit", F.greatest(F.size("price"), F.lit(0)))
    )
    unit = F.coalesce(F.nullif(F.col("electricity_unit"), F.lit("")), F.lit(DEFAULT_PRICE_UNIT))
    return (
        payloads.withColumn("electricity_unit", units)
        .withColumnRenamed("price", "electricity_price")
        .select(
            "country",
            "ingestion_date",
            _content("unix_seconds", "electricity_price"),
            F.inline(_numbered(zip_shortest(*[F.col(c) for c in ("unix_seconds", "electricity_price", "electricity_unit")]))),
        )
        .withColumn("electricity_unit", unit)
        .withColumn("timestamp", F.timestamp_seconds("unix_seconds"))
    )


def explode_installed_power(payloads: DataFrame) -> DataFrame:
    """One row per type and month. One bad period voids the payload, a length mismatch the type."""
    readable = F.forall("time", lambda p: timeslots.period_start(p).isNotNull())
    return (
        _series(payloads.filter(readable), "time")
        .filter(F.size("data") == F.size("time"))
        .select("country", "ingestion_date", "_payload", "_at", "production_type", F.inline(_numbered(zip_shortest(F.col("time"), F.col("data")))))
        .withColumnsRenamed({"time": "time_period", "data": "installed_capacity"})
        .withColumn("timestamp", timeslots.period_start(F.col("time_period")))
    )


EXPLODE = {
    "public_power": explode_public_power,
    "price": explode_price,
    "installed_power": explode_installed_power,
}


def to_bronze(
    payloads: DataFrame,
    kind: str,
    batch_id: str,
    data_source: str = "api",
    source_system: str = "market_api",
    as_of: datetime | None = None,
) -> DataFrame:
    """Bronze rows of usable payloads, with lineage columns and a repeatable record id.

    The id covers the content of the payload and the place in both arrays, so a payload that names a time or a
    type twice still gives different ids. Only the same payload landed twice in one batch repeats them.
    """
    rows = EXPLODE[schemas.known_kind(kind)](payloads)
    if as_of is not None:
        rows = rows.withColumn("ingestion_date", F.coalesce("ingestion_date", F.lit(as_of)))
    position = "time_period" if kind == "installed_power" else "unix_seconds"
    loaded = F.unix_micros("ingestion_date")
    identity = [F.lit(kind), F.lit(batch_id), F.col("country"), F.col(position), loaded, F.col("_payload"), F.col("_position")]
    if "production_type" in rows.columns:
        identity += [F.col("production_type"), F.col("_at")]
    rows = rows.withColumns(
        {
            "record_id": keys.hashed_key(*identity),
            "data_source": F.lit(data_source),
            "source_system": F.lit(source_system),
            "ingestion_batch_id": F.lit(batch_id),
        }
    )
    return schemas.conform(rows, schemas.BRONZE[kind])
