"""Upserts, snapshot differences, dimension history, and stored tables."""

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.operators import bucketed, merge
from gridlake.operators.dedup import keep_latest
from gridlake.plans import gold, lakehouse, silver
from gridlake.sources import tables
from gridlake.workspace import scratch_path
from registry.core import NOW, STEPS, dim_sql, latest_sql, query

KEYS = ("timestamp", "raw_type", "country")
_COLUMNS = "timestamp raw_type country electricity_generated bronze_record_id ingestion_timestamp"


def batches(lake) -> tuple[DataFrame, DataFrame]:
    """All production rows as two deliveries: within eight minutes of their slot, and later."""
    rows = silver.standardized_power(lake.power()).select(*_COLUMNS.split())
    late = F.unix_seconds("ingestion_timestamp") - F.unix_seconds("timestamp") >= 480
    return rows.filter(~late), rows.filter(late)


_LATE = "epoch(date_trunc('second', ingestion_timestamp)) - epoch(timestamp) >= 480"
_BY, _ORDER = "timestamp, raw_type, country", "ingestion_timestamp DESC, bronze_record_id DESC"
STEPS["early_rows"] = latest_sql(f"(SELECT * FROM std_power WHERE NOT ({_LATE})) AS e", _BY, _ORDER)
STEPS["late_rows"] = latest_sql(f"(SELECT * FROM std_power WHERE {_LATE}) AS l", _BY, _ORDER)
_MATCH = "a.timestamp = b.timestamp AND a.raw_type = b.raw_type AND a.country = b.country"


@query(
    "upsert",
    f"""SELECT * FROM late_rows UNION ALL
      SELECT * FROM early_rows a WHERE NOT EXISTS (SELECT 1 FROM late_rows b WHERE {_MATCH})""",
    _COLUMNS,
)
def _(lake):
    early, late = batches(lake)
    return merge.upsert(keep_latest(early, KEYS, *silver.NEWEST), late, KEYS, *silver.NEWEST)


@query(
    "insert_absent",
    f"""SELECT * FROM early_rows UNION ALL
      SELECT * FROM late_rows a WHERE NOT EXISTS (SELECT 1 FROM early_rows b WHERE {_MATCH})""",
    _COLUMNS,
)
def _(lake):
    early, late = batches(lake)
    return merge.insert_absent(keep_latest(early, KEYS, *silver.NEWEST), late, KEYS, *silver.NEWEST)


@query(
    "upsert_stored",
    f"""SELECT * FROM late_rows UNION ALL
      SELECT * FROM early_rows a WHERE NOT EXISTS (SELECT 1 FROM late_rows b WHERE {_MATCH})""",
    _COLUMNS,
)
def _(lake):
    path = scratch_path(lake.spark, "upserted")
    early, late = batches(lake)
    for batch in (early, late, early):
        dated = batch.withColumns({"year": F.year("timestamp"), "month": F.month("timestamp")})
        merge.upsert_table(lake.spark, path, dated, KEYS, ("year", "month"), silver.NEWEST)
    return lake.spark.read.parquet(path)


@query(
    "upsert_bucketed",
    f"""SELECT *, CAST(year(timestamp) AS INTEGER) AS year, CAST(month(timestamp) AS INTEGER) AS month FROM (
      SELECT * FROM late_rows UNION ALL
      SELECT * FROM early_rows a WHERE NOT EXISTS (SELECT 1 FROM late_rows b WHERE {_MATCH}))""",
    f"{_COLUMNS} year month",
)
def _(lake):
    name = f"bucketed_{uuid.uuid4().hex}"
    early, late = (b.withColumns({"year": F.year("timestamp"), "month": F.month("timestamp")}) for b in batches(lake))
    bucketed.create(early, name, KEYS, ("year", "month"), silver.NEWEST, 4, scratch_path(lake.spark, "bucketed"))
    for batch in (late, early):
        bucketed.upsert(lake.spark, name, batch, KEYS, ("year", "month"), silver.NEWEST)
    return bucketed.read(lake.spark, name)


@query(
    "table_diff",
    """SELECT CASE WHEN b.timestamp IS NULL THEN 'insert' WHEN a.timestamp IS NULL THEN 'delete' ELSE 'update' END AS change_type,
        coalesce(a.timestamp, b.timestamp) AS timestamp, coalesce(a.raw_type, b.raw_type) AS raw_type,
        coalesce(a.country, b.country) AS country,
        CASE WHEN a.timestamp IS NULL THEN b.electricity_generated ELSE a.electricity_generated END AS electricity_generated
      FROM late_rows a FULL OUTER JOIN early_rows b
        ON a.timestamp = b.timestamp AND a.raw_type = b.raw_type AND a.country = b.country
      WHERE a.timestamp IS NULL OR b.timestamp IS NULL OR a.electricity_generated IS DISTINCT FROM b.electricity_generated""",
)
def _(lake):
    early, late = batches(lake)
    columns = (*KEYS, "electricity_generated")
    old = keep_latest(early, KEYS, *silver.NEWEST).select(*columns)
    new = keep_latest(late, KEYS, *silver.NEWEST).select(*columns)
    return merge.table_diff(old, new, KEYS)


STEPS["capacity_dim"] = dim_sql("SELECT DISTINCT production_type AS t, country FROM std_capacity", "t")
STEPS["power_dim"] = dim_sql("SELECT DISTINCT production_type AS t, country FROM std_power", "t")


@query(
    "scd2",
    """SELECT o.* REPLACE (n.production_type_id IS NULL OR o.country <> 'at' AS active_flag), '2001-08-01' AS effective_date,
        CASE WHEN n.production_type_id IS NOT NULL AND o.country = 'at' THEN '2024-01-31' END AS expiry_date
      FROM (SELECT *, true AS active_flag FROM capacity_dim) o LEFT JOIN power_dim n USING (production_type_id)
      UNION ALL
      SELECT n.* REPLACE (CASE WHEN n.country = 'at' THEN n.description || ' (AT)' ELSE n.description END AS description),
        true AS active_flag, '2024-01-31', NULL
      FROM power_dim n LEFT JOIN capacity_dim o USING (production_type_id)
      WHERE o.production_type_id IS NULL OR n.country = 'at'""",
    "production_type_id production_plant_name energy_category description country active_flag effective_date expiry_date",
)
def _(lake):
    then = datetime(2001, 8, 1, tzinfo=timezone.utc)
    old = gold.dim_production_type([silver.type_pairs(lake.capacity())], then)
    new = gold.dim_production_type([silver.type_pairs(lake.power())], NOW)
    renamed = F.when(F.col("country") == "at", F.concat("description", F.lit(" (AT)"))).otherwise(F.col("description"))
    return merge.scd2_merge(old, new.withColumn("description", renamed), NOW)


@query(
    "schema_evolve",
    f"""SELECT record_id, production_type, electricity_generated,
      CASE WHEN {_LATE.replace('ingestion_timestamp', 'ingestion_date')} THEN country END AS country FROM b_power""",
    "record_id production_type electricity_generated country",
)
def _(lake):
    path = scratch_path(lake.spark, "evolving")
    late = F.unix_seconds("ingestion_date") - F.unix_seconds("timestamp") >= 480
    columns = ("record_id", "production_type", "electricity_generated")
    tables.append_table(lake.power().filter(~late).select(*columns), path)
    tables.append_table(lake.power().filter(late).select(*columns, "country"), path)
    return tables.read_table(lake.spark, path, merge=True)


@query("compact", "SELECT * FROM b_power")
def _(lake):
    scattered, compacted = scratch_path(lake.spark, "scattered"), scratch_path(lake.spark, "compacted")
    lake.power().repartition(16).write.parquet(scattered)
    tables.compact_table(lake.spark, scattered, compacted, ("timestamp", "country"), "record_id")
    return lake.spark.read.parquet(compacted)


@query("partitioned_write", "SELECT * FROM s_capacity", "timestamp raw_type country installed_power year month")
def _(lake):
    path = scratch_path(lake.spark, "partitioned")
    tables.checked_write(lake.silver_capacity(), path, ("year", "month"))
    return lake.spark.read.parquet(path)


@query(
    "lakehouse_run",
    "SELECT * FROM half_hours",
    "record_id year month day hour timestamp_30min production_type_id min_electricity_produced max_electricity_produced "
    "data_points_count country",
)
def _(lake):
    root = scratch_path(lake.spark, "lakehouse")
    bronze = {"public_power": lake.power(), "price": lake.price(), "installed_power": lake.capacity()}
    lakehouse.run(lake.spark, bronze, root, NOW, "batch-1")
    return lake.spark.read.parquet(f"{root}/gold_fact_power_30min_agg")
