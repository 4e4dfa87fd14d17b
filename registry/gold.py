"""Dimension and facts."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from gridlake.operators import merge
from gridlake.plans import gold, silver
from gridlake.workspace import materialise
from registry.core import (
    FLOOR_MARKER,
    HALF_HOUR_METRICS,
    LEGACY_MARKER,
    NOW,
    STEPS,
    dim_sql,
    fact_sql,
    plant_sql,
    query,
    slot_sql,
)

_DIM = (
    "production_type_id production_plant_name plant_family energy_category controllability_type description country "
    "active_flag created_at effective_date"
)
_DIM_EXTRA = "true AS active_flag, TIMESTAMP '2024-01-31' AS created_at, '2024-01-31' AS effective_date"


@query("dim_production_type", f"SELECT *, {_DIM_EXTRA} FROM dim", _DIM)
def _(lake):
    return lake.dim()


STEPS["coarse_pairs"] = """SELECT coarse AS t, lower(trim(country)) AS country FROM coarse_types
  JOIN b_power ON record_id = bronze_record_id"""
STEPS["family_dim"] = dim_sql("SELECT DISTINCT t, country FROM coarse_pairs", plant_sql("t", "name"))


@query("dim_by_family", f"SELECT *, {_DIM_EXTRA} FROM family_dim", _DIM)
def _(lake):
    return gold.dim_production_type([silver.type_pairs(lake.power(), "coarse")], NOW, "family")


_FACT = (
    "record_id year month day hour minute minute_interval_30 timestamp_30min timestamp production_type_id "
    "electricity_produced electricity_price country"
)


@query("fact_power_hour", "SELECT * FROM fact", _FACT)
def _(lake):
    return lake.fact(lake.dim())


@query(
    "fact_power_exact",
    fact_sql("s_power", "s_price", "dim", slot_sql("p.timestamp"), FLOOR_MARKER, "p.raw_type", False),
    _FACT,
)
def _(lake):
    return lake.fact(lake.dim(), "exact")


def dim_with_history(lake):
    """Known since the first of the month; on the 10th German renewables are curtailed, on the 20th no longer, and coal runs out."""
    first, second, third = (datetime(2024, 1, day, tzinfo=timezone.utc) for day in (1, 10, 20))
    typed = [silver.type_pairs(lake.power()), silver.type_pairs(lake.capacity())]
    dim = materialise(gold.dim_production_type(typed, first), "dim")
    curtailed = (F.col("country") == "de") & (F.col("energy_category") == "Renewable")
    with_curtailed = dim.withColumn("controllability_type", F.when(curtailed, "Curtailed").otherwise(F.col("controllability_type")))
    coal = F.lower("production_plant_name").contains("coal")
    with_phase_out = dim.withColumn("energy_category", F.when(coal, "Phase-out").otherwise(F.col("energy_category")))
    for incoming, as_of in ((with_curtailed, second), (with_phase_out, third)):
        dim = materialise(merge.scd2_merge(dim, incoming, as_of), "dim")
    return dim


@query(
    "fact_power_as_of_dim",
    """SELECT p.timestamp, p.production_type, p.country, electricity_generated, production_type_id,
        CASE WHEN lower(production_plant_name) LIKE '%coal%' AND p.timestamp >= TIMESTAMP '2024-01-20' THEN 'Phase-out'
          ELSE energy_category END AS energy_category,
        CASE WHEN p.country = 'de' AND energy_category = 'Renewable' AND p.timestamp >= TIMESTAMP '2024-01-10'
          AND p.timestamp < TIMESTAMP '2024-01-20' THEN 'Curtailed' ELSE controllability_type END AS controllability_type
      FROM s_power p LEFT JOIN dim d ON p.production_type = d.production_plant_name AND p.country = d.country""",
    "timestamp production_type country electricity_generated production_type_id energy_category controllability_type",
)
def _(lake):
    return gold.with_plant_as_of(lake.silver_power(), dim_with_history(lake), ("energy_category", "controllability_type"))


_LEGACY_SLOT = f"date_trunc('hour', p.timestamp) + to_minutes({LEGACY_MARKER})"


@query(
    "fact_power_legacy",
    fact_sql("legacy_power", "s_price", "family_dim", _LEGACY_SLOT, LEGACY_MARKER, "d.production_type_id", False),
    _FACT,
)
def _(lake):
    power = silver.silver_public_power(lake.power(), NOW, taxonomy_name="coarse", dedup_on="standardized")
    dim = gold.dim_production_type([silver.type_pairs(lake.power(), "coarse")], NOW, "family")
    return gold.fact_power(
        power, lake.silver_price(), materialise(dim, "dim"), NOW, "exact", "legacy15", "production_type_id"
    )


STEPS["enriched"] = f"""SELECT p.year, p.month, p.day, p.hour, CAST(minute(p.timestamp) AS INTEGER) AS minute,
    CAST({FLOOR_MARKER} AS INTEGER) AS minute_interval_30, {slot_sql('p.timestamp')} AS timestamp_30min,
    {slot_sql('p.timestamp', 5)} AS minute_rounded, p.timestamp, production_type_id, energy_category, controllability_type,
    electricity_generated AS electricity_produced, CAST(q.electricity_price AS DOUBLE) AS electricity_price, p.country
  FROM s_power p JOIN s_price q ON q.timestamp = date_trunc('hour', p.timestamp) AND q.country = p.country
  JOIN dim d ON p.production_type = d.production_plant_name AND p.country = d.country
  WHERE electricity_generated IS NOT NULL AND electricity_generated >= 0"""


@query("fact_power_enriched", "SELECT * FROM enriched")
def _(lake):
    return gold.fact_power_enriched(lake.silver_power(), lake.silver_price(), lake.dim())


_DIGITS = {
    "avg_electricity_produced": 4,
    "total_electricity_produced": 3,
    "production_volatility": 3,
    "avg_electricity_price": 4,
}


@query("fact_30min", "SELECT * FROM half_hours", digits=_DIGITS)
def _(lake):
    return lake.half_hours(lake.dim()).drop("created_at", "updated_at")


@query(
    "fact_30min_enriched",
    f"""SELECT year, month, day, hour, minute_interval_30, timestamp_30min, production_type_id, energy_category,
      controllability_type, country, {HALF_HOUR_METRICS}, count(*) AS data_points_count,
      avg(electricity_price) AS avg_electricity_price FROM enriched GROUP BY ALL""",
    digits=_DIGITS,
)
def _(lake):
    enriched = gold.fact_power_enriched(lake.silver_power(), lake.silver_price(), lake.dim())
    return gold.fact_power_30min_enriched(enriched)
