"""Streaming jobs, each run over all staged files to completion and compared with its batch twin."""

from pyspark.sql import functions as F

from gridlake.functions import taxonomy
from gridlake.plans import silver
from gridlake.sources import staging
from gridlake.streaming import jobs
from gridlake.workspace import scratch_path
from registry.core import HALF_HOUR_METRICS, query, slot_sql
from registry.ingest import POWER_ROWS_COLUMNS, POWER_ROWS_SQL, land
from registry.tables import KEYS


def _power(lake):
    """Production rows as a stream over the file of events."""
    schema = lake.events.schema
    return staging.power_from_events(jobs.table_stream(lake.spark, lake.dir, schema, only="events.parquet"))


def _to_files(lake, stream):
    path = scratch_path(lake.spark, "stream")
    jobs.run_to_files(stream, path, scratch_path(lake.spark, "progress"))
    return lake.spark.read.schema(stream.schema).parquet(path)


@query("stream_ingest", POWER_ROWS_SQL, POWER_ROWS_COLUMNS)
def _(lake):
    landed = jobs.landing_stream(lake.spark, land(lake), "public_power")
    return _to_files(lake, jobs.bronze_stream(landed, "public_power", "batch-1"))


@query("stream_expectations", "SELECT * FROM b_power WHERE electricity_generated > 0")
def _(lake):
    return _to_files(lake, jobs.expected_only(_power(lake)))


@query("stream_dedup", "SELECT DISTINCT timestamp, country FROM b_power")
def _(lake):
    first = jobs.first_arrivals(_power(lake), ("timestamp", "country"))
    return _to_files(lake, first).select("timestamp", "country")


@query(
    "stream_30min",
    f"""SELECT production_type, country, {slot_sql('timestamp')} AS timestamp_30min, {HALF_HOUR_METRICS},
      count(electricity_produced) AS data_points_count
      FROM (SELECT production_type, country, timestamp, electricity_generated AS electricity_produced FROM std_power) AS p
      GROUP BY 1, 2, 3""",
    "production_type country timestamp_30min avg_electricity_produced total_electricity_produced min_electricity_produced "
    "max_electricity_produced production_volatility data_points_count",
    {"avg_electricity_produced": 4, "total_electricity_produced": 3, "production_volatility": 3},
)
def _(lake):
    typed = _power(lake).withColumn("production_type", taxonomy.standardize_type(F.col("production_type")))
    keys = ("production_type", "country", "timestamp_30min")
    path = scratch_path(lake.spark, "stream")
    totals = jobs.half_hour_totals(typed, keys[:2])
    jobs.run_to_upsert(totals, path, scratch_path(lake.spark, "progress"), keys, ("year", "month", "day"), ("data_points_count",), "update")
    return lake.spark.read.parquet(path)


@query(
    "stream_upsert",
    "SELECT * FROM s_power",
    "timestamp production_type raw_type country electricity_generated bronze_record_id ingestion_timestamp",
)
def _(lake):
    rows = silver.standardized_power(_power(lake))
    path = scratch_path(lake.spark, "stream")
    jobs.run_to_upsert(rows, path, scratch_path(lake.spark, "progress"), KEYS, ("year", "month", "day"), silver.NEWEST)
    return lake.spark.read.parquet(path)
