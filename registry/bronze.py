"""Staged bronze tables and the expressions over them."""

from pyspark.sql import functions as F

from gridlake.functions import taxonomy, timeslots
from registry.core import coarse_sql, fine_sql, parts_sql, plant_sql, query, slot_sql


@query("bronze_public_power", "SELECT * FROM b_power")
def _(lake):
    return lake.power()


@query("bronze_price", "SELECT * REPLACE (CAST(electricity_price AS DOUBLE) AS electricity_price) FROM b_price")
def _(lake):
    return lake.price()


@query("bronze_installed", "SELECT * FROM b_capacity")
def _(lake):
    return lake.capacity()


@query(
    "slot_floor",
    f"""SELECT record_id, {slot_sql('ingestion_date')} AS slot_30, {slot_sql('ingestion_date', 5)} AS slot_5,
      CAST(CASE WHEN minute(ingestion_date) >= 30 THEN 30 ELSE 0 END AS INTEGER) AS marker FROM b_power""",
)
def _(lake):
    ts = F.col("ingestion_date")
    return lake.power().select(
        "record_id",
        timeslots.half_hour_slot(ts).alias("slot_30"),
        timeslots.floor_minutes(ts, 5).alias("slot_5"),
        timeslots.half_hour_marker(ts).alias("marker"),
    )


@query(
    "slot_legacy15",
    """SELECT record_id, date_trunc('hour', ingestion_date)
        + CASE WHEN minute(ingestion_date) >= 15 THEN INTERVAL 30 MINUTE ELSE INTERVAL 0 MINUTE END AS slot_30,
      CAST(CASE WHEN minute(ingestion_date) >= 15 THEN 30 ELSE 0 END AS INTEGER) AS marker FROM b_power""",
)
def _(lake):
    ts = F.col("ingestion_date")
    return lake.power().select(
        "record_id",
        timeslots.half_hour_slot(ts, "legacy15").alias("slot_30"),
        timeslots.half_hour_marker(ts, "legacy15").alias("marker"),
    )


@query(
    "calendar_parts",
    f"""SELECT record_id, {parts_sql('ingestion_date', 'year', 'month', 'day', 'hour', 'minute')},
      CAST(dayofweek(ingestion_date) + 1 AS INTEGER) AS day_of_week,
      CASE WHEN month(ingestion_date) IN (12, 1, 2) THEN 'Winter' WHEN month(ingestion_date) IN (3, 4, 5) THEN 'Spring'
        WHEN month(ingestion_date) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
      CAST(CAST(ingestion_date AS DATE) AS VARCHAR) AS day_text, strftime(ingestion_date, '%Y-%m-%d %H') AS hour_text
      FROM b_capacity""",
)
def _(lake):
    ts = F.col("ingestion_date")
    return lake.capacity().select(
        "record_id",
        *timeslots.calendar(ts, "year", "month", "day", "hour", "minute"),
        F.dayofweek(ts).alias("day_of_week"),
        timeslots.season(F.month(ts)).alias("season"),
        F.to_date(ts).cast("string").alias("day_text"),
        F.date_format(ts, "yyyy-MM-dd HH").alias("hour_text"),
    )


@query(
    "period_dates",
    """SELECT record_id, time_period, strptime(time_period, '%m.%Y') AS period_start,
      regexp_matches(time_period, '^[0-9]{2}\\.[0-9]{4}$') AS well_formed FROM b_capacity""",
)
def _(lake):
    period = F.col("time_period")
    return lake.capacity().select(
        "record_id",
        "time_period",
        timeslots.period_start(period).alias("period_start"),
        timeslots.period_well_formed(period).alias("well_formed"),
    )


_BOTH = "SELECT record_id, production_type FROM b_power UNION ALL SELECT record_id, production_type FROM b_capacity"


def _both(lake):
    columns = ("record_id", "production_type")
    return lake.power().select(*columns).unionByName(lake.capacity().select(*columns))


@query("type_coarse", f"SELECT record_id, {coarse_sql('production_type')} AS standard FROM ({_BOTH}) AS t")
def _(lake):
    return _both(lake).select("record_id", taxonomy.standardize_type(F.col("production_type"), "coarse").alias("standard"))


@query("type_fine", f"SELECT record_id, {fine_sql('production_type')} AS standard FROM ({_BOTH}) AS t")
def _(lake):
    return _both(lake).select("record_id", taxonomy.standardize_type(F.col("production_type")).alias("standard"))


@query(
    "type_attributes",
    f"""SELECT record_id, {plant_sql('production_type', 'name')} AS production_plant_name,
      {plant_sql('production_type', 'category')} AS energy_category,
      {plant_sql('production_type', 'controllability')} AS controllability_type,
      {plant_sql('production_type', 'description')} AS description FROM ({_BOTH}) AS t""",
)
def _(lake):
    attributes = taxonomy.production_attributes(F.col("production_type")).alias("a")
    return _both(lake).select("record_id", attributes).select("record_id", "a.*")
