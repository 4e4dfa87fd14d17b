"""What happens later: processing again, back-dated runs, incremental runs, second sinks, odd values."""

import re
from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from gridlake.operators import merge, quality
from gridlake.plans import baseline, gold, lakehouse, reports, silver
from gridlake.plans.sliding import SlidingBaseline
from gridlake.sources import payloads, tables
from gridlake.streaming import jobs
from gridlake.workspace import materialise, scratch_path
from registry.core import CAPACITY_NOW, NOW, STEPS, query
from registry.ingest import land
from registry.reports import _MIN_OBSERVATIONS
from registry.streams import _power, _to_files
from registry.tables import _MATCH, KEYS, batches

_HALF_HOUR = (
    "record_id year month day hour minute minute_interval_30 timestamp_30min timestamp production_type_id "
    "avg_electricity_produced total_electricity_produced min_electricity_produced max_electricity_produced "
    "production_volatility data_points_count avg_electricity_price country"
).split()
_HALF_DIGITS = {c: 4 for c in _HALF_HOUR if c.endswith(("_produced", "_volatility", "_price"))}
_COLUMNS = "timestamp raw_type country electricity_generated bronze_record_id ingestion_timestamp"


def _dated(rows):
    return rows.withColumns({"year": F.year("timestamp"), "month": F.month("timestamp")})


def _upserted(lake, *deliveries):
    path = scratch_path(lake.spark, "upserted")
    for rows in deliveries:
        merge.upsert_table(lake.spark, path, _dated(rows), KEYS, ("year", "month"), silver.NEWEST)
    return lake.spark.read.parquet(path)


@query(
    "upsert_missing_column",
    f"""SELECT b.*, 'note ' || a.bronze_record_id AS note FROM late_rows b LEFT JOIN early_rows a ON {_MATCH}
      UNION ALL SELECT a.*, 'note ' || a.bronze_record_id FROM early_rows a
      WHERE NOT EXISTS (SELECT 1 FROM late_rows b WHERE {_MATCH})""",
    _COLUMNS + " note",
)
def _(lake):
    """The second delivery lacks a column that the table has: stored notes stay, also in updated rows."""
    early, late = batches(lake)
    return _upserted(lake, early.withColumn("note", F.concat(F.lit("note "), "bronze_record_id")), late)


@query("upsert_reprocessed", "SELECT * REPLACE (electricity_generated + 1 AS electricity_generated) FROM s_power", _COLUMNS)
def _(lake):
    """The same bronze rows by another rule: every stored row takes the new value, though none is newer."""
    rows = silver.standardized_power(lake.power()).select(*_COLUMNS.split())
    return _upserted(lake, rows, rows.withColumn("electricity_generated", F.col("electricity_generated") + 1))


# Every step from bronze to the fact again, over production rows some of which are no finite numbers.
_ODD = ("b_power", "std_power", "power_spread", "scored_power", "s_power", "dim", "fact")
_WORDS = re.compile(rf"\b({'|'.join(_ODD)})\b")
for _step in _ODD[1:]:
    STEPS[f"odd_{_step}"] = _WORDS.sub(r"odd_\1", STEPS[_step])
STEPS["odd_b_power"] = """SELECT * REPLACE (CASE WHEN CAST(record_id AS BIGINT) % 71 = 0 OR CAST(record_id AS BIGINT) % 73 = 0
    THEN NULL ELSE electricity_generated END AS electricity_generated) FROM b_power"""


# The staged rows cover one month: some are moved back by one to four months. Every step to the silver table again.
_MOVED = ("b_power", "std_power", "power_spread", "scored_power", "s_power")
for _step in _MOVED[1:]:
    STEPS[f"moved_{_step}"] = re.sub(rf"\b({'|'.join(_MOVED)})\b", r"moved_\1", STEPS[_step])
STEPS["moved_b_power"] = """SELECT * REPLACE (timestamp - to_months(CAST(CAST(record_id AS BIGINT) % 5 AS INTEGER)) AS timestamp)
  FROM b_power"""


def moved_power(lake):
    """Production rows of five months."""
    back = F.make_ym_interval(F.lit(0), (F.col("record_id").cast("long") % 5).cast("int"))
    return lake.power().withColumn("timestamp", F.col("timestamp") - back)


@query(
    "anomaly_incremental",
    "SELECT bronze_record_id AS record_id, timestamp, is_anomaly FROM moved_s_power WHERE timestamp >= TIMESTAMP '2023-12-01'",
)
def _(lake):
    """Three months, then two more: their limits come from the moments of all five, though the first three aren't read again."""
    root = scratch_path(lake.spark, "moments")
    bronze = f"{root}/bronze"
    rows = moved_power(lake)
    tables.overwrite_table(_dated(rows), bronze, ("year", "month"))
    stored = lake.spark.read.parquet(bronze)
    new = F.col("timestamp") >= F.lit(date(2023, 12, 1)).cast("timestamp")
    for part, history in ((stored.filter(~new), stored.filter(~new)), (stored.filter(new), stored)):
        lakehouse.build_silver(lake.spark, {"public_power": part}, root, NOW, "batch-1", {"public_power": history})
    found = lake.spark.read.parquet(f"{root}/silver_public_power").filter(new)
    return found.select(F.col("bronze_record_id").alias("record_id"), "timestamp", "is_anomaly")


def _odd_power(lake):
    number = F.col("record_id").cast("long")
    value = F.when(number % 71 == 0, float("nan")).when(number % 73 == 0, float("-inf")).otherwise(F.col("electricity_generated"))
    return lake.power().withColumn("electricity_generated", value)


def _odd_fact(lake):
    power = _odd_power(lake)
    dim = gold.dim_production_type([silver.type_pairs(power), silver.type_pairs(lake.capacity())], NOW)
    return gold.fact_power(silver.silver_public_power(power, NOW), lake.silver_price(), dim, NOW), dim


@query(
    "odd_values_silver",
    "SELECT * FROM odd_s_power",
    "timestamp raw_type country electricity_generated data_quality_score is_valid is_anomaly bronze_record_id",
)
def _(lake):
    return silver.silver_public_power(_odd_power(lake), NOW)


@query(
    "odd_values_trend",
    """SELECT f.year, f.month, f.day, production_plant_name AS production_type, sum(electricity_produced) AS total_daily_production
      FROM odd_fact f JOIN odd_dim USING (production_type_id) WHERE f.country = 'de' GROUP BY ALL""",
    digits={"total_daily_production": 3},
)
def _(lake):
    return reports.daily_trend(*_odd_fact(lake))


@query(
    "odd_values_renewable",
    """SELECT f.country, f.year, f.month, f.day,
        sum(electricity_produced) FILTER (energy_category = 'Renewable') AS renewable_production,
        sum(electricity_produced) AS total_production, renewable_production / nullif(total_production, 0) AS renewable_share
      FROM odd_fact f JOIN odd_dim d USING (production_type_id) GROUP BY 1, 2, 3, 4""",
    digits={"renewable_production": 3, "total_production": 3, "renewable_share": 4},
)
def _(lake):
    return reports.renewable_share(*_odd_fact(lake))


_THEN = datetime(2024, 1, 20, tzinfo=timezone.utc)
STEPS["base_then"] = STEPS["base"].replace(
    "timestamp_30min >= TIMESTAMP '2024-01-31' - INTERVAL 90 DAY",
    "timestamp_30min BETWEEN TIMESTAMP '2024-01-20' - INTERVAL 90 DAY AND TIMESTAMP '2024-01-20'",
)


@query(
    "baseline_backdated",
    "SELECT * FROM base_then",
    digits={f"baseline_{m}_production": 3 for m in ("avg", "median", "p25", "p75", "std")}
    | {f"underperformance_threshold_{t}": 3 for t in ("moderate", "severe", "quartile")},
)
def _(lake):
    """A run dated back into the middle of the data sees nothing that came later."""
    dim = lake.dim()
    rows = baseline.performance_baseline(lake.half_hours(dim), dim, _THEN, min_observations=_MIN_OBSERVATIONS)
    return rows.drop("created_at", "updated_at")


def _window_sql(day: str) -> str:
    """`base` on half hours of five months, with the window before the given day."""
    moved = re.sub(r"\bhalf_hours\b", "moved_half_hours", STEPS["slotted"])
    rows = f"({moved})"
    window = f"timestamp_30min BETWEEN TIMESTAMP '{day}' - INTERVAL 60 DAY AND TIMESTAMP '{day}'"
    base = STEPS["base"].replace("timestamp_30min >= TIMESTAMP '2024-01-31' - INTERVAL 90 DAY", window)
    return f"SELECT '{day}' AS until, w.* FROM ({base.replace('FROM slotted', f'FROM {rows} AS s')}) AS w"


_DAYS = ("2023-12-20", "2024-01-20", "2023-11-27")


@query(
    "baseline_sliding",
    " UNION ALL ".join(map(_window_sql, _DAYS)),
    digits={f"baseline_{m}_production": 3 for m in ("avg", "median", "p25", "p75", "std")}
    | {f"underperformance_threshold_{t}": 3 for t in ("moderate", "severe", "quartile")},
)
def _(lake):
    """One window of 60 days moved to three dates, forward and back; the rows of the last month arrive between the first two."""
    dim = lake.dim()
    back = F.make_ym_interval(F.lit(0), F.col("day") % 5)
    agg = materialise(lake.half_hours(dim).withColumn("timestamp_30min", F.col("timestamp_30min") - back), "half_hours")
    early = agg.filter(F.col("timestamp_30min") < F.lit(date(2024, 1, 1)).cast("timestamp"))
    sliding = SlidingBaseline(lake.spark, scratch_path(lake.spark, "baseline"), days=60)
    found = []
    for day, rows, since in zip(_DAYS, (early, agg, agg), (None, datetime(2024, 1, 1, tzinfo=timezone.utc), datetime(2024, 1, 1, tzinfo=timezone.utc))):
        then = datetime.fromisoformat(day).replace(tzinfo=timezone.utc)
        sliding.advance(rows.drop("year", "month"), then, since)
        typical = sliding.baseline(dim, then, min_observations=_MIN_OBSERVATIONS).drop("created_at", "updated_at")
        found.append(materialise(typical.withColumn("until", F.lit(day)), "baseline"))
    return found[0].unionByName(found[1]).unionByName(found[2])


def _growth_sql(country: str, upper: str) -> str:
    return f"""SELECT production_date, {country} production_plant_name, energy_category, daily_production, avg_daily_price,
        lag(daily_production) OVER (PARTITION BY {country} production_plant_name ORDER BY production_date) AS previous_day_production
      FROM (SELECT strftime(timestamp, '%Y-%m-%d') AS production_date, {country.replace('country', 'f.country')}
          production_plant_name, energy_category, sum(electricity_produced) AS daily_production, avg(electricity_price) AS avg_daily_price
        FROM fact f JOIN dim d USING (production_type_id)
        WHERE timestamp BETWEEN TIMESTAMP '{upper}' - INTERVAL 30 DAY AND TIMESTAMP '{upper}' GROUP BY ALL) AS daily"""


_GROWTH_DIGITS = {"daily_production": 3, "avg_daily_price": 4, "previous_day_production": 3}


@query("daily_growth_backdated", _growth_sql("", "2024-01-20"), digits=_GROWTH_DIGITS)
def _(lake):
    dim = lake.dim()
    return reports.daily_growth(lake.fact(dim), dim, _THEN)


@query("daily_growth_countries", _growth_sql("country,", "2024-01-31"), digits=_GROWTH_DIGITS)
def _(lake):
    dim = lake.dim()
    return reports.daily_growth(lake.fact(dim), dim, NOW, by_country=True)


@query(
    "lakehouse_incremental",
    "SELECT *, concat_ws('_', CAST(timestamp AS VARCHAR), raw_type, country) AS business_key FROM s_power",
    "business_key timestamp production_type raw_type electricity_generated year month day hour country unit "
    "source_system bronze_record_id ingestion_timestamp data_quality_score is_valid is_anomaly",
)
def _(lake):
    """A first run over what came early, then one over the new month: the tables are those of a full run."""
    root = scratch_path(lake.spark, "lakehouse")
    late = F.unix_seconds("ingestion_date") - F.unix_seconds("timestamp") >= 480
    bronze = {"public_power": lake.power(), "price": lake.price(), "installed_power": lake.capacity()}
    lakehouse.run(lake.spark, bronze | {"public_power": lake.power().filter(~late)}, root, NOW, "batch-1")
    lakehouse.run(lake.spark, bronze, root, NOW, "batch-1", since=date(2024, 1, 1))
    return lake.spark.read.parquet(f"{root}/silver_public_power")


@query("gold_from_changes", "SELECT * FROM half_hours", " ".join(_HALF_HOUR), _HALF_DIGITS)
def _(lake):
    """Facts from what came early, then only what the late rows, of power and of prices, change in them."""
    root = scratch_path(lake.spark, "changes")
    late = F.unix_seconds("ingestion_date") - F.unix_seconds("timestamp") >= 480
    morning = F.hour("timestamp") < 9
    bronze = {"public_power": lake.power(), "price": lake.price(), "installed_power": lake.capacity()}
    early = {"public_power": lake.power().filter(~late), "price": lake.price().filter(~morning)}
    lakehouse.run(lake.spark, bronze | early, root, NOW, "batch-1")
    rest = {"public_power": lake.power().filter(late), "price": lake.price().filter(morning)}
    lakehouse.build_silver(lake.spark, rest, root, NOW, "batch-2", note_changes=True)
    lakehouse.gold_from_changes(lake.spark, root, NOW)
    return lake.spark.read.parquet(f"{root}/gold_fact_power_30min_agg")


@query(
    "stream_rejects",
    """SELECT CASE WHEN event_id % 7 <> 4 THEN country END AS country, CASE event_id % 7 WHEN 3 THEN 'empty payload'
      WHEN 4 THEN 'not an object' ELSE 'missing production_types' END AS reject_reason FROM shaped WHERE event_id % 7 IN (3, 4, 5)""",
    "country reject_reason",
)
def _(lake):
    landed = jobs.landing_stream(lake.spark, land(lake), "public_power", files_each=1)
    return _to_files(lake, jobs.rejected_stream(landed, "public_power"))


@query(
    "stream_quarantine",
    """SELECT record_id, electricity_generated, 'positive_value' AS failed FROM b_power
      WHERE electricity_generated IS NULL OR electricity_generated <= 0""",
)
def _(lake):
    held = jobs.quarantined(_power(lake))
    return _to_files(lake, held.select("record_id", "electricity_generated", F.array_join("failed_rules", ",").alias("failed")))


@query(
    "stream_warn",
    "SELECT record_id, CASE WHEN electricity_generated > 0 THEN '' ELSE 'positive_value' END AS failed FROM b_power",
)
def _(lake):
    named = jobs.expected_only(_power(lake), "warn")
    return _to_files(lake, named.select("record_id", F.array_join("failed_rules", ",").alias("failed")))


@query("compact_partitioned", "SELECT * FROM b_power")
def _(lake):
    scattered, compacted = scratch_path(lake.spark, "scattered"), scratch_path(lake.spark, "compacted")
    lake.power().repartition(16).write.partitionBy("country").parquet(scattered)
    tables.compact_table(lake.spark, scattered, compacted, ("timestamp",), "record_id", partition_by=("country",))
    return lake.spark.read.parquet(compacted)


@query("record_ids", "SELECT 4 * count(*) AS n_rows, 4 * count(*) AS n_ids FROM events")
def _(lake):
    """Payloads that name a time and a type twice: each row has an id of its own."""
    slot = F.unix_seconds(F.col("ts").cast("timestamp"))
    series = [F.concat(F.lit('{"name":"Solar","data":['), F.col("value"), F.lit(","), F.lit(v), F.lit("]}")) for v in ("1", "2")]
    text = F.concat(F.lit('{"unix_seconds":['), slot, F.lit(","), slot, F.lit('],"production_types":['), series[0], F.lit(","), series[1], F.lit("]}"))
    rows = lake.events.select(text.alias("payload"), F.lit("de").alias("country"), F.col("ts").cast("timestamp").alias("ingestion_date"))
    good, _ = payloads.validate_payloads(payloads.parse_payloads(rows, "public_power"), "public_power")
    bronze = payloads.to_bronze(good, "public_power", "batch-1")
    return bronze.agg(F.count("*").alias("n_rows"), F.count_distinct("record_id").alias("n_ids"))


def _summary_sql(step: str) -> str:
    return f"""SELECT count(*) AS total_records, count(*) FILTER (dq_check_status = 'VALID') AS valid_records,
      count(*) FILTER (dq_check_status = 'WARNING') AS warning_records, count(*) FILTER (dq_check_status = 'ERROR') AS error_records,
      count(*) FILTER (is_anomaly) AS anomaly_records, avg(dq_score) AS avg_dq_score, avg(installed_capacity) AS avg_installed_capacity,
      stddev_samp(installed_capacity) AS stddev_installed_capacity, count(DISTINCT production_type) AS unique_production_types,
      count(DISTINCT time_period) AS unique_time_periods, count(DISTINCT country) AS unique_countries,
      min(ingestion_date) AS earliest_bronze_record, max(ingestion_date) AS latest_bronze_record FROM {step}"""


_SUMMARY_DIGITS = {"avg_dq_score": 4, "avg_installed_capacity": 2, "stddev_installed_capacity": 2}


@query("dq_summary_a", _summary_sql("checked_a"), digits=_SUMMARY_DIGITS)
def _(lake):
    return quality.quality_summary(silver.checked_capacity_a(lake.capacity(), CAPACITY_NOW))


@query("dq_summary_loaded", _summary_sql("status_b WHERE dq_check_status <> 'ERROR'"), digits=_SUMMARY_DIGITS)
def _(lake):
    return quality.quality_summary(silver.checked_capacity_b(lake.capacity()).filter("dq_check_status <> 'ERROR'"))


@query(
    "price_rules",
    """SELECT record_id, array_to_string(list_filter([
        CASE WHEN timestamp IS NULL THEN 'valid_timestamp' END, CASE WHEN coalesce(country, '') = '' THEN 'valid_country' END,
        CASE WHEN electricity_price IS NULL THEN 'price_present' END,
        CASE WHEN coalesce(electricity_unit, '') = '' THEN 'unit_present' END], lambda x: x IS NOT NULL), ',') AS failed FROM b_price""",
)
def _(lake):
    flagged, _ = quality.apply_policy(lake.price(), quality.price_rules())
    return flagged.select("record_id", F.array_join("failed_rules", ",").alias("failed"))


@query(
    "capacity_rules",
    """SELECT record_id, array_to_string(list_filter([
        CASE WHEN NOT regexp_full_match(coalesce(time_period, ''), '[0-9]{2}\\.[0-9]{4}') THEN 'valid_period' END,
        CASE WHEN coalesce(production_type, '') = '' THEN 'type_present' END,
        CASE WHEN coalesce(country, '') = '' THEN 'valid_country' END,
        CASE WHEN coalesce(installed_capacity, -1) < 0 THEN 'capacity_not_negative' END], lambda x: x IS NOT NULL), ',') AS failed
      FROM b_capacity""",
)
def _(lake):
    flagged, _ = quality.apply_policy(lake.capacity(), quality.capacity_rules())
    return flagged.select("record_id", F.array_join("failed_rules", ",").alias("failed"))
