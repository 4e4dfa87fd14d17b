"""Registration, output format and the shared steps on both sides."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import datetime, timezone
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.plans import gold, silver
from gridlake.session import prepare
from gridlake.sources import staging
from gridlake.workspace import materialise

# The clocks of the staged data.
NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)
CAPACITY_NOW = datetime(2001, 8, 1, tzinfo=timezone.utc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, tuple[str, str, dict[str, int]]] = {}


class Lake:
    """The staged tables and what is built from them, each on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    @cached_property
    def events(self) -> DataFrame:
        return staging.events(self.spark, self.dir)

    @cached_property
    def orders(self) -> DataFrame:
        return staging.orders(self.spark, self.dir)

    def power(self) -> DataFrame:
        return staging.power_from_events(self.events)

    def price(self) -> DataFrame:
        return staging.price_from_events(self.events)

    def capacity(self) -> DataFrame:
        return staging.installed_from_orders(self.orders)

    def silver_power(self) -> DataFrame:
        return silver.silver_public_power(self.power(), NOW)

    def silver_price(self) -> DataFrame:
        return silver.silver_price(self.price(), NOW)

    def silver_capacity(self) -> DataFrame:
        return silver.silver_installed_power(self.capacity(), CAPACITY_NOW)

    def dim(self) -> DataFrame:
        """Stored; made from the bronze pairs, which needs no dedup shuffle."""
        typed = [silver.type_pairs(self.power()), silver.type_pairs(self.capacity())]
        return materialise(gold.dim_production_type(typed, NOW), "dim")

    def fact(self, dim: DataFrame, price_join: str = "hour") -> DataFrame:
        return gold.fact_power(self.silver_power(), self.silver_price(), dim, NOW, price_join)

    def half_hours(self, dim: DataFrame) -> DataFrame:
        return gold.fact_power_30min(self.fact(dim), NOW)


def rounded(column, digits: int = 4, nudge: float = 1e-6):
    """Round away the differences of summation order. The nudge moves exact halves off the edge."""
    return F.round(F.col(column) + nudge, digits).alias(column) if isinstance(column, str) else F.round(column + nudge, digits)


def presented(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Types that read the same from both engines: zone-free times, dates as text, decimals as double."""

    def column(field: T.StructField):
        col = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return col.cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return col.cast("string").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        return (rounded(col, digits[field.name]) if field.name in digits else col).alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None, columns: str = "", digits: dict[str, int] | None = None):
    """Register a function of a `Lake`, its SQL twin, the columns to show and the digits to round to.

    The SQL selects from the named steps in `STEPS`; its columns are rounded the same way.
    """
    digits = digits or {}

    def register(build: Callable[[Lake], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = build(Lake(prepare(spark), sf_dir))
            return presented(df.select(*columns.split()) if columns else df, digits)

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            TWINS[name] = (sql, columns, digits)
        return build

    return register


def twin(body: str, columns: str = "", digits: dict[str, int] | None = None) -> str:
    """A complete statement: the steps that `body` refers to, in order, and `body`."""
    if digits:
        changed = ", ".join(f"round({c} + 1e-6, {d}) AS {c}" for c, d in digits.items())
        chosen = f"* REPLACE ({changed})"
        if columns:
            chosen = ", ".join(f"round({c} + 1e-6, {digits[c]}) AS {c}" if c in digits else c for c in columns.split())
        body = f"SELECT {chosen} FROM ({body}) AS r"
    elif columns:
        body = f"SELECT {', '.join(columns.split())} FROM ({body}) AS r"
    needed: list[str] = []

    def visit(text: str) -> None:
        for step in STEPS:
            if step not in needed and re.search(rf"\b{step}\b", text):
                visit(STEPS[step])
                needed.append(step)

    visit(body)
    steps = ",\n".join(f"{step} AS ({STEPS[step]})" for step in needed)
    return f"WITH {steps}\n{body}" if steps else body


# SQL text of the shared expressions -----------------------------------------------------------


def fine_sql(name: str) -> str:
    """The fine types, written out: the engine's table of rules is not used here."""
    return f"""CASE
      WHEN lower(trim({name})) LIKE '%solar%' AND lower(trim({name})) LIKE '%gross%' THEN 'Solar gross'
      WHEN lower(trim({name})) LIKE '%solar%' THEN 'Solar'
      WHEN lower(trim({name})) LIKE '%wind%' AND lower(trim({name})) LIKE '%onshore%' THEN 'Wind onshore'
      WHEN lower(trim({name})) LIKE '%wind%' AND lower(trim({name})) LIKE '%offshore%' THEN 'Wind offshore'
      WHEN lower(trim({name})) LIKE '%wind%' THEN 'Wind'
      WHEN lower(trim({name})) LIKE '%nuclear%' THEN 'Nuclear'
      WHEN lower(trim({name})) LIKE '%coal%' AND lower(trim({name})) LIKE '%brown%' THEN 'Brown coal'
      WHEN lower(trim({name})) LIKE '%coal%' AND lower(trim({name})) LIKE '%hard%' THEN 'Hard coal'
      WHEN lower(trim({name})) LIKE '%coal%' THEN 'Coal'
      WHEN lower(trim({name})) LIKE '%gas%' AND lower(trim({name})) LIKE '%fossil%' THEN 'Fossil gas'
      WHEN lower(trim({name})) LIKE '%gas%' THEN 'Gas'
      WHEN lower(trim({name})) LIKE '%hydro%' AND lower(trim({name})) LIKE '%run%' THEN 'Hydro Run-of-River'
      WHEN lower(trim({name})) LIKE '%hydro%' AND lower(trim({name})) LIKE '%reservoir%' THEN 'Hydro Reservoir'
      WHEN lower(trim({name})) LIKE '%hydro%' THEN 'Hydro'
      WHEN lower(trim({name})) LIKE '%battery%' THEN 'Battery Storage (Capacity)'
      WHEN lower(trim({name})) LIKE '%biomass%' THEN 'Biomass'
      WHEN lower(trim({name})) LIKE '%waste%' THEN 'Waste'
      WHEN lower(trim({name})) LIKE '%oil%' THEN 'Oil'
      WHEN lower(trim({name})) LIKE '%other%' THEN 'Other'
      ELSE trim({name}) END"""


def coarse_sql(name: str) -> str:
    """The coarse types, written out. Of the twelve rules the last five can only be met by names without the first seven words."""
    return f"""CASE
      WHEN contains(upper(trim({name})), 'WIND') THEN 'Wind'
      WHEN contains(upper(trim({name})), 'SOLAR') THEN 'Solar'
      WHEN contains(upper(trim({name})), 'NUCLEAR') THEN 'Nuclear'
      WHEN contains(upper(trim({name})), 'FOSSIL') THEN 'Fossil'
      WHEN contains(upper(trim({name})), 'HYDRO') THEN 'Hydro'
      WHEN contains(upper(trim({name})), 'BIOMASS') THEN 'Biomass'
      WHEN contains(upper(trim({name})), 'GEOTHERMAL') THEN 'Geothermal'
      WHEN contains(upper(trim({name})), 'PV') THEN 'Solar PV'
      WHEN contains(upper(trim({name})), 'RUN_OF_RIVER') THEN 'Run of River'
      WHEN contains(upper(trim({name})), 'PUMPED_STORAGE') THEN 'Pumped Storage'
      ELSE {name} END"""


def title_sql(name: str) -> str:
    words = f"regexp_extract_all(lower({name}), '[a-z]*[^a-z]|[a-z]+$')"
    return f"array_to_string(list_transform({words}, lambda y: upper(y[1:1]) || y[2:]), '')"


def plant_sql(name: str, field: str) -> str:
    """Plant attributes, written out: name, category, controllability and description by the first word that the name holds."""
    found = f"""CASE
      WHEN lower({name}) LIKE '%solar%' THEN {{'name': 'Solar', 'category': 'Renewable', 'controllability': 'Weather_Dependent',
        'description': 'Photovoltaic and solar thermal power'}}
      WHEN lower({name}) LIKE '%wind%' THEN {{'name': 'Wind', 'category': 'Renewable', 'controllability': 'Weather_Dependent',
        'description': 'Onshore and offshore wind power'}}
      WHEN lower({name}) LIKE '%hydro%' THEN {{'name': 'Hydro', 'category': 'Renewable', 'controllability': 'Controllable',
        'description': 'Hydroelectric power'}}
      WHEN lower({name}) LIKE '%nuclear%' THEN {{'name': 'Nuclear', 'category': 'Non-Renewable', 'controllability': 'Controllable',
        'description': 'Nuclear power plants'}}
      WHEN lower({name}) LIKE '%coal%' THEN {{'name': 'Coal', 'category': 'Non-Renewable', 'controllability': 'Controllable',
        'description': 'Coal-fired power plants'}}
      WHEN lower({name}) LIKE '%gas%' THEN {{'name': 'Fossil Gas', 'category': 'Non-Renewable', 'controllability': 'Controllable',
        'description': 'Gas-fired power plants'}}
      WHEN lower({name}) LIKE '%biomass%' THEN {{'name': 'Biomass', 'category': 'Renewable', 'controllability': 'Controllable',
        'description': 'Biomass and biogas plants'}}
      WHEN lower({name}) LIKE '%oil%' THEN {{'name': 'Oil', 'category': 'Non-Renewable', 'controllability': 'Controllable',
        'description': 'Oil-fired power plants'}}
      WHEN lower({name}) LIKE '%battery%' THEN {{'name': 'Battery Storage', 'category': 'Renewable', 'controllability': 'Mixed',
        'description': 'Battery energy storage systems'}}
      ELSE {{'name': {title_sql(name)}, 'category': 'Mixed', 'controllability': 'Mixed', 'description': 'Other or unknown type'}} END"""
    return f"({found})['{field}']"


def slot_sql(ts: str, minutes: int = 30) -> str:
    return f"time_bucket(INTERVAL {minutes} MINUTE, {ts})"


def parts_sql(ts: str, *parts: str) -> str:
    return ", ".join(f"CAST({part}({ts}) AS INTEGER) AS {part}" for part in parts)


def latest_sql(source: str, by: str, order: str) -> str:
    return f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY {order}) = 1"


def dim_sql(pairs: str, name: str) -> str:
    return f"""SELECT DISTINCT sha256(concat_ws('_', {name}, country)) AS production_type_id,
        {name} AS production_plant_name, {plant_sql('t', 'name')} AS plant_family,
        {plant_sql('t', 'category')} AS energy_category, {plant_sql('t', 'controllability')} AS controllability_type,
        {plant_sql('t', 'description')} AS description, country FROM ({pairs}) AS p WHERE t IS NOT NULL"""


def fact_sql(power: str, price: str, dim: str, slot: str, marker: str, type_key: str, hour: bool) -> str:
    price_time = "date_trunc('hour', p.timestamp)" if hour else "p.timestamp"
    return f"""SELECT sha256(concat_ws('_', CAST(p.timestamp AS VARCHAR), coalesce({type_key}, '<null>'), p.country)) AS record_id,
        p.year, p.month, p.day, p.hour, CAST(minute(p.timestamp) AS INTEGER) AS minute,
        CAST({marker} AS INTEGER) AS minute_interval_30, {slot} AS timestamp_30min, p.timestamp,
        d.production_type_id, p.electricity_generated AS electricity_produced,
        CAST(q.electricity_price AS DOUBLE) AS electricity_price, p.country
      FROM {power} p
      LEFT JOIN {dim} d ON p.production_type = d.production_plant_name AND p.country = d.country
      LEFT JOIN {price} q ON q.timestamp = {price_time} AND q.country = p.country"""


FLOOR_MARKER = "CASE WHEN minute(p.timestamp) >= 30 THEN 30 ELSE 0 END"
LEGACY_MARKER = "CASE WHEN minute(p.timestamp) >= 15 THEN 30 ELSE 0 END"
NEWEST_SQL = "ingestion_timestamp DESC, bronze_record_id DESC"
HALF_HOUR_METRICS = """avg(electricity_produced) AS avg_electricity_produced,
      sum(electricity_produced) AS total_electricity_produced, min(electricity_produced) AS min_electricity_produced,
      max(electricity_produced) AS max_electricity_produced, stddev_samp(electricity_produced) AS production_volatility"""

# Named SQL steps, the twins of `Lake`.
STEPS = {
    "b_power": """SELECT CAST(event_id AS VARCHAR) AS record_id, time_bucket(INTERVAL 15 MINUTE, ts) AS timestamp,
        CAST(epoch(time_bucket(INTERVAL 15 MINUTE, ts)) AS BIGINT) AS unix_seconds,
        CASE concat(event_type, '-', CAST(user_id % 2 AS VARCHAR))
          WHEN 'view-0' THEN 'Wind offshore' WHEN 'view-1' THEN 'Wind onshore'
          WHEN 'click-0' THEN 'Solar' WHEN 'click-1' THEN 'Residual load'
          WHEN 'signup-0' THEN 'Fossil gas' WHEN 'signup-1' THEN 'Fossil hard coal'
          WHEN 'purchase-0' THEN 'Fossil brown coal / lignite' WHEN 'purchase-1' THEN ' hydro Run-of-River '
          WHEN 'error-0' THEN 'Nuclear' ELSE 'Biomass' END AS production_type,
        CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN -value
          WHEN event_id % 83 = 0 THEN value * 1000 ELSE value END AS electricity_generated,
        CASE WHEN user_id % 3 = 0 THEN 'at' ELSE 'de' END AS country,
        'file' AS data_source, 'synthetic' AS source_system, 'batch-1' AS ingestion_batch_id, ts AS ingestion_date
      FROM events""",
    "b_price": """SELECT concat(event_type, '|', country, '|', CAST(CAST(epoch(hr) AS BIGINT) AS VARCHAR)) AS record_id,
        hr AS timestamp, CAST(epoch(hr) AS BIGINT) AS unix_seconds, CAST(mx - 50 AS DECIMAL(10,4)) AS electricity_price,
        CASE WHEN event_type = 'view' THEN 'EUR/MWh' END AS electricity_unit, country,
        'file' AS data_source, 'synthetic' AS source_system, 'batch-1' AS ingestion_batch_id, last_ts AS ingestion_date
      FROM (SELECT event_type, CASE WHEN user_id % 3 = 0 THEN 'at' ELSE 'de' END AS country,
          date_trunc('hour', ts) AS hr, max(value) AS mx, max(ts) AS last_ts
        FROM events WHERE event_type IN ('view', 'click') GROUP BY 1, 2, 3) AS h""",
    "b_capacity": """SELECT CAST(o_orderkey AS VARCHAR) AS record_id, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS timestamp,
        CASE WHEN o_orderkey % 101 = 0 THEN '1.2000' ELSE strftime(o_orderdate, '%m.%Y') END AS time_period,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'Wind onshore' WHEN '2-HIGH' THEN 'Solar gross'
          WHEN '3-MEDIUM' THEN 'Hydro Run-of-River' WHEN '4-NOT SPECIFIED' THEN 'Battery storage (power)'
          ELSE 'Fossil brown coal / lignite' END AS production_type,
        CASE WHEN o_orderkey % 113 = 0 THEN NULL WHEN o_orderkey % 107 = 0 THEN -o_totalprice
          WHEN o_orderkey % 103 = 0 THEN 0.0 WHEN o_orderkey % 109 = 0 THEN o_totalprice * 50
          ELSE o_totalprice END AS installed_capacity,
        CASE o_orderstatus WHEN 'O' THEN 'de' WHEN 'F' THEN 'at' ELSE ' DE ' END AS country,
        'file' AS data_source, 'synthetic' AS source_system, 'batch-1' AS ingestion_batch_id, o_orderdate AS ingestion_date
      FROM orders""",
    "std_power": f"""SELECT timestamp, {fine_sql('production_type')} AS production_type, lower(trim(production_type)) AS raw_type,
        electricity_generated, {parts_sql('timestamp', 'year', 'month', 'day', 'hour')}, lower(trim(country)) AS country,
        'MW' AS unit, source_system, record_id AS bronze_record_id, ingestion_date AS ingestion_timestamp FROM b_power""",
    "std_capacity": f"""SELECT timestamp, {fine_sql('production_type')} AS production_type, lower(trim(production_type)) AS raw_type,
        installed_capacity AS installed_power, {parts_sql('timestamp', 'year', 'month')}, time_period,
        lower(trim(country)) AS country, 'GW' AS unit, source_system, record_id AS bronze_record_id,
        ingestion_date AS ingestion_timestamp FROM b_capacity""",
    "coarse_types": f"SELECT record_id AS bronze_record_id, {coarse_sql('production_type')} AS coarse FROM b_power",
    "power_spread": "SELECT avg(electricity_generated) AS m, stddev_samp(electricity_generated) AS s FROM b_power",
    "price_spread": """SELECT avg(CAST(electricity_price AS DOUBLE)) AS m, stddev_samp(CAST(electricity_price AS DOUBLE)) AS s
      FROM b_price""",
    "scored_power": """SELECT p.*,
        CASE WHEN electricity_generated IS NULL THEN 0.0 WHEN electricity_generated < 0 THEN 0.3
          WHEN electricity_generated > 100000 THEN 0.5 ELSE 1.0 END::DOUBLE AS data_quality_score,
        timestamp IS NOT NULL AND production_type IS NOT NULL AND electricity_generated IS NOT NULL
          AND electricity_generated >= 0 AS is_valid,
        coalesce(s > 0 AND (electricity_generated > m + 3 * s OR electricity_generated < m - 3 * s), false) AS is_anomaly
      FROM std_power p, power_spread""",
    "scored_price": f"""SELECT timestamp, electricity_price, 'EUR' AS currency, 'EPEX_SPOT' AS market,
        {parts_sql('timestamp', 'year', 'month', 'day')}, lower(trim(country)) AS country,
        coalesce(electricity_unit, 'EUR/MWh') AS unit, source_system, record_id AS bronze_record_id,
        ingestion_date AS ingestion_timestamp,
        CASE WHEN electricity_price IS NULL THEN 0.0 WHEN electricity_price < 0 THEN 0.1
          WHEN electricity_price > 1000 THEN 0.5 ELSE 1.0 END::DOUBLE AS data_quality_score,
        timestamp IS NOT NULL AND electricity_price IS NOT NULL AS is_valid,
        coalesce(s > 0 AND (electricity_price::DOUBLE > m + 3 * s OR electricity_price::DOUBLE < m - 3 * s), false) AS is_anomaly
      FROM b_price, price_spread""",
    "scored_capacity": """SELECT *,
        CASE WHEN installed_power IS NULL THEN 0.0 WHEN installed_power < 0 THEN 0.0
          WHEN installed_power > 1000000 THEN 0.5 ELSE 1.0 END::DOUBLE AS data_quality_score,
        timestamp IS NOT NULL AND installed_power IS NOT NULL AND installed_power >= 0 AS is_valid
      FROM std_capacity""",
    "s_power": latest_sql("scored_power", "timestamp, raw_type, country", NEWEST_SQL),
    "s_price": latest_sql("scored_price", "timestamp, country", NEWEST_SQL),
    "s_capacity": latest_sql("scored_capacity", "timestamp, raw_type, country", NEWEST_SQL),
    "dim": dim_sql(
        "SELECT production_type AS t, country FROM s_power UNION SELECT production_type AS t, country FROM s_capacity", "t"
    ),
    "fact": fact_sql("s_power", "s_price", "dim", slot_sql("p.timestamp"), FLOOR_MARKER, "p.raw_type", True),
    "half_hours": f"""SELECT sha256(concat_ws('_', coalesce(production_type_id, '<null>'), country, CAST(timestamp_30min AS VARCHAR)))
        AS record_id, {parts_sql('timestamp_30min', 'year', 'month', 'day', 'hour', 'minute')}, minute_interval_30,
        timestamp_30min, timestamp, production_type_id, avg_electricity_produced, total_electricity_produced,
        min_electricity_produced, max_electricity_produced, production_volatility, data_points_count,
        avg_electricity_price, country
      FROM (SELECT production_type_id, country, {slot_sql('timestamp')} AS timestamp_30min,
          min(minute_interval_30) AS minute_interval_30, min(timestamp) AS timestamp, {HALF_HOUR_METRICS},
          CAST(count(electricity_produced) AS INTEGER) AS data_points_count, avg(electricity_price) AS avg_electricity_price
        FROM fact GROUP BY 1, 2, 3) AS g""",
}
