"""Streams over landed files and bronze rows.

All jobs run with `availableNow`: a scheduled run handles what has arrived and stops. Their state
is bounded by the watermark, their sinks are repeatable, so a restarted batch does no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridlake import schemas
from gridlake.functions import measures
from gridlake.operators import merge, quality
from gridlake.sources import payloads
from gridlake.sources.landing import landing_schema

# How late a row may arrive.
LATENESS = "1 hour"


def landing_stream(spark: SparkSession, path: str, kind: str, files_each: int | None = None) -> DataFrame:
    """Landed JSON files as they arrive; at most `files_each` in a micro-batch."""
    reader = spark.readStream if files_each is None else spark.readStream.option("maxFilesPerTrigger", files_each)
    return (
        reader.schema(landing_schema(kind))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .json(path)
    )


def table_stream(spark: SparkSession, path: str, schema: StructType, only: str | None = None) -> DataFrame:
    """New files of a parquet folder; `only` restricts the file names."""
    reader = spark.readStream.schema(schema)
    return (reader.option("pathGlobFilter", only) if only else reader).parquet(path)


def bronze_stream(landed: DataFrame, kind: str, batch_id: str) -> DataFrame:
    """Usable landed payloads as bronze rows."""
    good, _ = payloads.validate_payloads(landed, kind)
    return payloads.to_bronze(good, kind, batch_id)


def expected_only(rows: DataFrame, policy: str = "drop") -> DataFrame:
    """`drop` removes rows that break an expectation, `warn` names the broken ones. `quarantined` has the removed ones."""
    if policy not in ("drop", "warn"):
        raise ValueError(f"unknown policy {policy!r}: a stream has one output, run `quarantined` next to `drop`")
    return quality.apply_policy(rows, quality.power_rules(), {"warn": "flag"}.get(policy, policy))[0]


def rejected_stream(landed: DataFrame, kind: str) -> DataFrame:
    """The landed payloads that `bronze_stream` leaves out, each with its reason; a second sink for them."""
    return payloads.rejected(payloads.check_payloads(landed, kind))


def quarantined(rows: DataFrame) -> DataFrame:
    """The rows that `expected_only` removes, with the names of the broken expectations; a second sink for them."""
    good, bad = quality.apply_policy(rows, quality.power_rules(), "quarantine")
    return bad


def first_arrivals(rows: DataFrame, keys: tuple[str, ...], ts: str = "timestamp", lateness: str = LATENESS) -> DataFrame:
    """The first row of each key within the watermark."""
    return rows.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(list(keys))


def half_hour_totals(rows: DataFrame, by: tuple[str, ...], lateness: str = LATENESS) -> DataFrame:
    """Half-hour aggregates of production rows."""
    produced = measures.present(F.col("electricity_generated"))
    return (
        rows.withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", "30 minutes").alias("_slot"), *by)
        .agg(
            F.avg(produced).alias("avg_electricity_produced"),
            F.sum(produced).alias("total_electricity_produced"),
            F.min(produced).alias("min_electricity_produced"),
            F.max(produced).alias("max_electricity_produced"),
            F.stddev(produced).alias("production_volatility"),
            F.count(produced).alias("data_points_count"),
        )
        .withColumn("timestamp_30min", F.col("_slot.start"))
        .drop("_slot")
        .withColumns({"year": F.year("timestamp_30min"), "month": F.month("timestamp_30min"), "day": F.dayofmonth("timestamp_30min")})
    )


def run_to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append everything that has arrived to a parquet folder, exactly once."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()


def run_to_upsert(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: tuple[str, ...],
    partition_by: tuple[str, ...],
    newest_first: tuple[str, ...],
    mode: str = "append",
) -> None:
    """Upsert every micro-batch into a partitioned table.

    In `append` mode a stored row that is newer than an arriving one survives; in `update` mode the
    stream itself carries the latest state of a key and replaces the stored row.
    """

    def write(batch: DataFrame, _: int) -> None:
        merge.upsert_table(
            batch.sparkSession, path, batch, keys, partition_by, newest_first, incremental=mode == "append"
        )

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
