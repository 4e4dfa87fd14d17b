"""Payload decoding and load windows.

The payload texts are made from every row of the test tables, in several shapes (ragged arrays,
missing parts, non-objects). The SQL states the rows that each shape must give.
"""

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.functions.timeslots import floor_minutes
from gridlake.sources import drift, landing, payloads, windows
from gridlake.workspace import scratch_path
from registry.core import CAPACITY_NOW, NOW, STEPS, query, slot_sql


def _text(*parts) -> F.Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _shapes(number, texts: list) -> F.Column:
    """Every row gets one of the shapes in turn."""
    case = F
    for i, text in enumerate(texts):
        case = case.when(number % len(texts) == i, text)
    return case


def _events(lake) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return lake.events.select(
        "event_id",
        F.when(F.col("user_id") % 3 == 0, "at").otherwise("de").alias("country"),
        ts.alias("ingestion_date"),
        F.unix_seconds(floor_minutes(ts, 15)).alias("s"),
        F.col("value").alias("v"),
    )


def power_payloads(lake) -> DataFrame:
    s, v = F.col("s"), F.col("v")
    second, third = s + 900, s + 1800
    texts = [
        _text('{"unix_seconds":[', s, ",", second, ",", third, '],"production_types":[{"name":"Wind offshore","data":[', v,
              ',null,2.5]},{"name":"Solar","data":[1.5,', v, "]}]}"),
        _text('{"unix_seconds":[', s, ",", second, '],"production_types":[{"name":"Nuclear","data":[', v,
              ',3,4,5]},{"data":[1]},{"name":"Load"}]}'),
        _text('{"production_types":[{"name":"Solar","data":[', v, "]}]}"),
        _text("{}"),
        _text("[", s, ",", v, "]"),
        _text('{"unix_seconds":[', s, "]}"),
        _text('{"unix_seconds":[', s, '],"production_types":[{"name":"Biomass","data":[', v, "]}]}"),
    ]
    return _events(lake).select("event_id", "country", "ingestion_date", _shapes(F.col("event_id"), texts).alias("payload"))


def price_payloads(lake) -> DataFrame:
    s, v = F.col("s"), F.col("v")
    two = _text('{"unix_seconds":[', s, ",", s + 3600, '],"price":[', v, ",-5.12345]")
    texts = [
        _text(two, ',"unit":"EUR / MWh"}'),
        _text(two, ',"unit":["EUR/MWh",""]}'),
        _text(two, "}"),
        _text(two, ',"unit":["X"]}'),
        _text("{}"),
        _text('{"unix_seconds":[', s, "]}"),
    ]
    return _events(lake).select("event_id", "country", "ingestion_date", _shapes(F.col("event_id"), texts).alias("payload"))


def capacity_payloads(lake) -> DataFrame:
    ordered = F.col("o_orderdate").cast("timestamp")
    p, t = F.date_format(ordered, "MM.yyyy"), F.col("o_totalprice")
    texts = [
        _text('{"time":["', p, '","05.2011"],"production_types":[{"name":"Solar gross","data":[', t,
              ',0.1]},{"name":"Wind onshore","data":[7310.25]}]}'),
        _text('{"time":["', p, '","13.2011"],"production_types":[{"name":"Solar gross","data":[', t, ",0.1]}]}"),
        _text('{"time":["1.2011"],"production_types":[{"name":"Wind onshore","data":[', t, "]}]}"),
        _text('{"time":["', p, '"]}'),
        _text("{}"),
    ]
    shaped = _shapes(F.col("o_orderkey"), texts).alias("payload")
    return lake.orders.select("o_orderkey", F.lit("de").alias("country"), ordered.alias("ingestion_date"), shaped)


def _bronze(rows: DataFrame, kind: str) -> DataFrame:
    good, _ = payloads.validate_payloads(payloads.parse_payloads(rows, kind), kind)
    return payloads.to_bronze(good, kind, "batch-1")


STEPS["shaped"] = f"""SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 'at' ELSE 'de' END AS country, ts AS ingestion_date,
    CAST(epoch({slot_sql('ts', 15)}) AS BIGINT) AS s, value AS v FROM events"""
STEPS["power_rows"] = """
  SELECT country, ingestion_date, s AS unix_seconds, 'Wind offshore' AS production_type, v AS electricity_generated
    FROM shaped WHERE event_id % 7 = 0
  UNION ALL SELECT country, ingestion_date, s + 900, 'Wind offshore', NULL FROM shaped WHERE event_id % 7 = 0
  UNION ALL SELECT country, ingestion_date, s + 1800, 'Wind offshore', 2.5 FROM shaped WHERE event_id % 7 = 0
  UNION ALL SELECT country, ingestion_date, s, 'Solar', 1.5 FROM shaped WHERE event_id % 7 = 0
  UNION ALL SELECT country, ingestion_date, s + 900, 'Solar', v FROM shaped WHERE event_id % 7 = 0
  UNION ALL SELECT country, ingestion_date, s, 'Nuclear', v FROM shaped WHERE event_id % 7 = 1
  UNION ALL SELECT country, ingestion_date, s + 900, 'Nuclear', 3.0 FROM shaped WHERE event_id % 7 = 1
  UNION ALL SELECT country, ingestion_date, s, 'Biomass', v FROM shaped WHERE event_id % 7 = 6"""
POWER_ROWS_SQL = """SELECT *, CAST(to_timestamp(unix_seconds) AT TIME ZONE 'UTC' AS TIMESTAMP) AS timestamp, 'batch-1' AS ingestion_batch_id
  FROM power_rows"""
POWER_ROWS_COLUMNS = (
    "country ingestion_date unix_seconds timestamp production_type electricity_generated ingestion_batch_id"
)


@query("explode_power", POWER_ROWS_SQL, POWER_ROWS_COLUMNS)
def _(lake):
    return _bronze(power_payloads(lake), "public_power")


@query(
    "explode_price",
    """SELECT country, ingestion_date, unix_seconds, CAST(electricity_price AS DOUBLE) AS electricity_price, electricity_unit FROM (
      SELECT country, ingestion_date, s AS unix_seconds, CAST(v AS DECIMAL(10,4)) AS electricity_price,
        CASE event_id % 6 WHEN 0 THEN 'EUR / MWh' WHEN 3 THEN 'X' ELSE 'EUR/MWh' END AS electricity_unit
        FROM shaped WHERE event_id % 6 < 4
      UNION ALL SELECT country, ingestion_date, s + 3600, -5.1235,
        CASE event_id % 6 WHEN 0 THEN 'EUR / MWh' ELSE 'EUR/MWh' END FROM shaped WHERE event_id % 6 < 3) AS u""",
    "country ingestion_date unix_seconds electricity_price electricity_unit",
)
def _(lake):
    return _bronze(price_payloads(lake), "price")


@query(
    "explode_installed",
    """SELECT o_orderdate AS ingestion_date, strftime(o_orderdate, '%m.%Y') AS time_period,
        CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS timestamp, 'Solar gross' AS production_type,
        o_totalprice AS installed_capacity FROM orders WHERE o_orderkey % 5 = 0
      UNION ALL SELECT o_orderdate, '05.2011', TIMESTAMP '2011-05-01', 'Solar gross', 0.1 FROM orders WHERE o_orderkey % 5 = 0
      UNION ALL SELECT o_orderdate, '1.2011', TIMESTAMP '2011-01-01', 'Wind onshore', o_totalprice
        FROM orders WHERE o_orderkey % 5 = 2""",
    "ingestion_date time_period timestamp production_type installed_capacity",
)
def _(lake):
    return _bronze(capacity_payloads(lake), "installed_power")


@query(
    "payload_rejects",
    """SELECT event_id, CASE event_id % 7 WHEN 3 THEN 'empty payload' WHEN 4 THEN 'not an object'
      ELSE 'missing production_types' END AS reject_reason FROM events WHERE event_id % 7 IN (3, 4, 5)""",
)
def _(lake):
    parsed = payloads.parse_payloads(power_payloads(lake), "public_power")
    return payloads.validate_payloads(parsed, "public_power")[1].select("event_id", "reject_reason")


def land(lake) -> str:
    """Write the power payloads as landed files: envelope and payload in one JSON object per line."""
    body = F.col("payload")
    envelope = _text(
        '{"country":"', F.col("country"), '","payload_date":"', F.to_date("ingestion_date"),
        '","ingestion_date":"', F.date_format("ingestion_date", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), '"',
    )
    rest = F.when(body == "{}", "}").otherwise(F.concat(F.lit(","), F.substr(body, F.lit(2))))
    line = F.when(body.startswith("["), body).otherwise(F.concat(envelope, rest))
    path = scratch_path(lake.spark, "landing")
    power_payloads(lake).select(line.alias("value")).write.text(path)
    return path


@query("landing_ingest", POWER_ROWS_SQL, POWER_ROWS_COLUMNS)
def _(lake):
    bronze = scratch_path(lake.spark, "bronze")
    landing.ingest(lake.spark, land(lake), "public_power", bronze, "batch-1", NOW)
    return lake.spark.read.parquet(bronze)


_LANDED = POWER_ROWS_COLUMNS.replace(" ingestion_batch_id", "")


@query("landing_twice", POWER_ROWS_SQL, _LANDED)
def _(lake):
    """Some files, the same again, all of them, and all again: the register lets each through once."""
    everything, some = land(lake), scratch_path(lake.spark, "landing")
    lines = lake.spark.read.text(everything)
    first = F.pmod(F.xxhash64("value"), F.lit(3)) == 0
    bronze, register = scratch_path(lake.spark, "bronze"), scratch_path(lake.spark, "register")
    for batch, rows in enumerate((lines.filter(first), None, lines.filter(~first), None)):
        if rows is not None:
            rows.repartition(4).write.mode("append").text(some)
        landing.ingest_new(lake.spark, some, "public_power", bronze, register, f"batch-{batch}", NOW)
    return lake.spark.read.parquet(bronze)


@query(
    "date_spine",
    """SELECT CAST(CAST(d.day AS DATE) AS VARCHAR) AS day, count(o_orderkey) AS loaded_rows
      FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-07-31', INTERVAL 1 DAY) AS d(day)
      LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d.day AS DATE) GROUP BY 1""",
)
def _(lake):
    spine = windows.date_spine(lake.spark, date(1995, 1, 1), date(2001, 12, 31), CAPACITY_NOW, until_yesterday=True)
    loaded = lake.capacity().groupBy(F.to_date("ingestion_date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(loaded, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("loaded_rows"))


@query(
    "missing_days",
    """SELECT CAST(CAST(d.day AS DATE) AS VARCHAR) AS day
      FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) AS d(day)
      WHERE NOT EXISTS (SELECT 1 FROM orders WHERE CAST(o_orderdate AS DATE) = CAST(d.day AS DATE))""",
)
def _(lake):
    spine = windows.date_spine(lake.spark, date(1995, 1, 1), date(2001, 12, 31))
    return windows.missing_days(spine, lake.capacity(), "ingestion_date")


@query(
    "missing_slots",
    f"""SELECT production_type, country, slot FROM (SELECT DISTINCT production_type, country FROM b_power) AS k,
      generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:30:00', INTERVAL 30 MINUTE) AS g(slot)
      WHERE NOT EXISTS (SELECT 1 FROM b_power b WHERE b.production_type = k.production_type AND b.country = k.country
        AND {slot_sql('b.timestamp')} = g.slot)""",
)
def _(lake):
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    return windows.missing_slots(lake.power(), start, NOW, 30, ("production_type", "country"))


@query(
    "gap_ranges",
    f"""SELECT production_type, country, min(slot) AS gap_from, max(slot) + INTERVAL 30 MINUTE AS gap_to, count(*) AS missing
      FROM (SELECT k.production_type, k.country, g.slot,
          row_number() OVER (PARTITION BY k.production_type, k.country ORDER BY g.slot) AS i
        FROM (SELECT DISTINCT production_type, country FROM b_power) AS k,
          generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:30:00', INTERVAL 30 MINUTE) AS g(slot)
        WHERE NOT EXISTS (SELECT 1 FROM b_power b WHERE b.production_type = k.production_type AND b.country = k.country
          AND {slot_sql('b.timestamp')} = g.slot)) AS lost
      GROUP BY production_type, country, slot - to_minutes(30 * i)""",
)
def _(lake):
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    return windows.gap_ranges(lake.power(), start, NOW, 30, ("production_type", "country"))


@query(
    "previous_interval",
    """SELECT * FROM b_power WHERE timestamp >= TIMESTAMP '2024-01-30 11:45:00' AND timestamp < TIMESTAMP '2024-01-30 12:00:00'""",
)
def _(lake):
    return windows.previous_interval(lake.power(), datetime(2024, 1, 30, 12, 7, 41, tzinfo=timezone.utc), 15)


@query(
    "previous_day",
    """SELECT * REPLACE (CAST(electricity_price AS DOUBLE) AS electricity_price) FROM b_price
      WHERE timestamp >= TIMESTAMP '2024-01-29' AND timestamp < TIMESTAMP '2024-01-30'""",
)
def _(lake):
    return windows.previous_day(lake.price(), datetime(2024, 1, 30, 9, tzinfo=timezone.utc))


@query(
    "recency_filter",
    "SELECT * FROM b_capacity WHERE ingestion_date >= TIMESTAMP '2001-08-01' - INTERVAL 90 DAY",
)
def _(lake):
    return windows.recent(lake.capacity(), CAPACITY_NOW, "ingestion_date", days=90)


@query("row_limit", "SELECT * FROM b_power ORDER BY ingestion_date, record_id LIMIT 1000")
def _(lake):
    return windows.first_rows(lake.power(), 1000, "ingestion_date", "record_id")


def drifting_payloads(lake) -> DataFrame:
    """Payloads of a source that adds, drops and retypes fields."""
    s, n = F.col("s"), F.col("event_id")
    series = _text('"production_types":[{"name":"Solar","data":[', n, "]}]")
    texts = [
        _text('{"unix_seconds":[', s, "],", series, "}"),
        _text('{"unix_seconds":[', s, "],", series, ',"deprecated":false,"note":"n', n, '"}'),
        _text('{"unix_seconds":[', s, '],"production_types":[{"name":"Solar","data":[', n, ']},{"name":"Load","data":[],"unit":"MW"}]}'),
        _text('{"unix_seconds":["', s, '"],', series, "}"),
        _text("{", series, ',"resolution":{"minutes":', n, "}}"),
        _text("[", n, "]"),
        _text('{"unix_seconds":[', s, "],", series, ',"deprecated":"since ', n, '"}'),
    ]
    return _events(lake).select("event_id", "country", "ingestion_date", _shapes(n, texts).alias("payload"))


_TYPES = "ARRAY<OBJECT<data: ARRAY<BIGINT>, name: STRING, unit: STRING>>"
_OBJECTS = "CASE WHEN x = 5 THEN 0 ELSE 1 END"
_ITEMS = "CASE x WHEN 5 THEN 0 WHEN 2 THEN 2 ELSE 1 END"


def _field_sql(field: str, status: str, kind: str, given: str, objects: str = "") -> str:
    missing = f"CAST(sum({objects}) - sum({given}) AS BIGINT)" if objects else "CAST(NULL AS BIGINT)"
    return f"""SELECT '{field}' AS field, '{status}' AS status, CAST(sum({given}) AS BIGINT) AS given, {missing} AS missing, '{kind}' AS type,
      min(ingestion_date) FILTER (WHERE {given} > 0) AS first_seen, max(ingestion_date) FILTER (WHERE {given} > 0) AS last_seen FROM drifting"""


STEPS["drifting"] = "SELECT *, event_id % 7 AS x FROM shaped"
STEPS["drift_fields"] = " UNION ALL ".join(
    [
        _field_sql("unix_seconds", "retyped", "ARRAY<VARIANT>", "CASE WHEN x IN (4, 5) THEN 0 ELSE 1 END", _OBJECTS),
        _field_sql("production_types", "known", _TYPES, _OBJECTS, _OBJECTS),
        _field_sql("production_types[].name", "known", "STRING", _ITEMS, _ITEMS),
        _field_sql("production_types[].data", "known", "ARRAY<BIGINT>", _ITEMS, _ITEMS),
        _field_sql("production_types[].unit", "unknown", "STRING", "CASE WHEN x = 2 THEN 1 ELSE 0 END"),
        _field_sql("deprecated", "unknown", "VARIANT", "CASE WHEN x IN (1, 6) THEN 1 ELSE 0 END"),
        _field_sql("note", "unknown", "STRING", "CASE WHEN x = 1 THEN 1 ELSE 0 END"),
        _field_sql("resolution", "unknown", "OBJECT<minutes: BIGINT>", "CASE WHEN x = 4 THEN 1 ELSE 0 END"),
    ]
)


@query("payload_drift", "SELECT * FROM drift_fields")
def _(lake):
    return drift.report(drifting_payloads(lake), "public_power")


@query(
    "payload_unknown",
    """SELECT event_id, 'deprecated' AS field, CAST(NULL AS INTEGER) AS item, 'false' AS value FROM drifting WHERE x = 1
      UNION ALL SELECT event_id, 'deprecated', NULL, concat('"since ', event_id, '"') FROM drifting WHERE x = 6
      UNION ALL SELECT event_id, 'note', NULL, concat('"n', event_id, '"') FROM drifting WHERE x = 1
      UNION ALL SELECT event_id, 'production_types[].unit', 1, '"MW"' FROM drifting WHERE x = 2
      UNION ALL SELECT event_id, 'resolution', NULL, concat('{"minutes":', event_id, '}') FROM drifting WHERE x = 4""",
)
def _(lake):
    path = scratch_path(lake.spark, "unknown")
    drift.with_unknown(drifting_payloads(lake), "public_power").select("event_id", "unknown").write.parquet(path)
    kept = lake.spark.read.parquet(path).select("event_id", F.inline("unknown"))
    return kept.withColumn("value", F.to_json("value"))
