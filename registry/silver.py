"""Quality, anomalies, deduplication and the silver tables."""

from pyspark.sql import functions as F

from gridlake.functions import keys, measures
from gridlake.operators import quality
from gridlake.operators.dedup import keep_latest
from gridlake.operators.quantiles import group_statistics
from gridlake.plans import silver
from registry.core import CAPACITY_NOW, NOW, STEPS, fine_sql, latest_sql, query

_SCORES = "record_id data_quality_score is_valid"


@query("dq_power", "SELECT bronze_record_id AS record_id, data_quality_score, is_valid FROM scored_power")
def _(lake):
    return quality.score_quality(lake.power(), "public_power", "electricity_generated").select(*_SCORES.split())


@query("dq_price", "SELECT bronze_record_id AS record_id, data_quality_score, is_valid FROM scored_price")
def _(lake):
    return quality.score_quality(lake.price(), "price", "electricity_price").select(*_SCORES.split())


@query("dq_installed", "SELECT bronze_record_id AS record_id, data_quality_score, is_valid FROM scored_capacity")
def _(lake):
    return quality.score_quality(lake.capacity(), "installed_power", "installed_capacity").select(*_SCORES.split())


_KEY_COLUMNS = ("record_id", "time_period", "production_type", "country")
_NO_KEY = " OR ".join(f"{c} IS NULL" for c in _KEY_COLUMNS)
_BLANK_KEY = " OR ".join(f"coalesce({c}, '') = ''" for c in _KEY_COLUMNS)
STEPS["judged_a"] = rf"""SELECT *, installed_capacity AS x, {_NO_KEY} AS no_key, {_BLANK_KEY} AS blank_key,
    NOT regexp_matches(time_period, '^\d\d\.\d\d\d\d$') AS odd_period, length(production_type) > 100 AS long_name
  FROM b_capacity"""
STEPS["status_a"] = """SELECT * EXCLUDE (x, no_key, blank_key, odd_period, long_name),
    CASE WHEN blank_key OR x IS NULL OR x < 0 THEN 'ERROR' WHEN odd_period OR x = 0 OR long_name THEN 'WARNING'
      ELSE 'VALID' END AS dq_check_status,
    CAST(CASE WHEN no_key OR x IS NULL THEN 1 WHEN x < 0 OR odd_period THEN 2 WHEN x = 0 OR long_name THEN 3
      WHEN NOT blank_key THEN 5 ELSE 4 END AS INTEGER) AS dq_score FROM judged_a"""


@query("dq_status_a", "SELECT record_id, dq_check_status, dq_score FROM status_a")
def _(lake):
    return lake.capacity().select(
        "record_id", quality.status_a().alias("dq_check_status"), quality.score_a().alias("dq_score")
    )


STEPS["normal_capacity"] = f"""SELECT * REPLACE ({fine_sql('production_type')} AS production_type,
    lower(trim(country)) AS country) FROM b_capacity"""
STEPS["pair_stats"] = """SELECT *, q1 - 1.5 * (q3 - q1) AS lowest, q3 + 1.5 * (q3 - q1) AS highest FROM (
    SELECT production_type, country, avg(installed_capacity) AS a, stddev_samp(installed_capacity) AS s,
      quantile_cont(installed_capacity, 0.25) AS q1, quantile_cont(installed_capacity, 0.75) AS q3
    FROM normal_capacity GROUP BY ALL) AS g"""
STEPS["judged_b"] = """SELECT b.*, installed_capacity AS x, abs(installed_capacity - a) / nullif(s, 0) AS z,
    coalesce(installed_capacity < lowest OR installed_capacity > highest, false) AS outside,
    installed_capacity = 0 AND NOT contains(b.production_type, 'Storage') AS idle
  FROM normal_capacity b LEFT JOIN pair_stats p ON b.production_type = p.production_type AND b.country = p.country"""
STEPS["status_b"] = """SELECT * EXCLUDE (x, z, outside, idle), outside OR coalesce(z > 3, false) AS is_anomaly,
    CASE WHEN x IS NULL OR x < 0 OR coalesce(trim(time_period), '') = '' OR coalesce(trim(production_type), '') = ''
        OR country IS NULL THEN 'ERROR'
      WHEN idle OR x > 100000 OR outside THEN 'WARNING' ELSE 'VALID' END AS dq_check_status,
    CAST(CASE WHEN x IS NULL OR x < 0 OR time_period IS NULL OR production_type IS NULL THEN 1
      WHEN idle OR x > 100000 THEN 2 WHEN outside THEN 3 WHEN z < 1 THEN 5 ELSE 4 END AS INTEGER) AS dq_score FROM judged_b"""


@query("dq_status_b", "SELECT record_id, dq_check_status, dq_score FROM status_b")
def _(lake):
    rows = silver.checked_capacity_b(lake.capacity())
    return rows.select(F.col("bronze_record_id").alias("record_id"), "dq_check_status", "dq_score")


@query("anomaly_global", "SELECT bronze_record_id AS record_id, is_anomaly FROM scored_power")
def _(lake):
    return quality.flag_outliers(lake.power(), "electricity_generated").select("record_id", "is_anomaly")


STEPS["type_flags"] = """SELECT * EXCLUDE (a, s, q1, q3), coalesce(abs(installed_capacity - a) > 3 * s, false)
    OR coalesce(installed_capacity < q1 - 1.5 * (q3 - q1), false)
    OR coalesce(installed_capacity > q3 + 1.5 * (q3 - q1), false) AS is_anomaly
  FROM (SELECT *, avg(installed_capacity) OVER w AS a, stddev_samp(installed_capacity) OVER w AS s,
      quantile_cont(installed_capacity, 0.25) OVER w AS q1, quantile_cont(installed_capacity, 0.75) OVER w AS q3
    FROM b_capacity WINDOW w AS (PARTITION BY production_type)) AS k"""


@query("anomaly_by_type", "SELECT record_id, is_anomaly FROM type_flags")
def _(lake):
    flagged = quality.flag_group_outliers(lake.capacity(), ("production_type",), "installed_capacity")
    return flagged.select("record_id", "is_anomaly")


@query("anomaly_by_stats_join", "SELECT record_id, is_anomaly FROM status_b")
def _(lake):
    rows = silver.checked_capacity_b(lake.capacity())
    return rows.select(F.col("bronze_record_id").alias("record_id"), "is_anomaly")


_STATS = {"mean": 2, "deviation": 2, "q25": 3, "q75": 3}


@query(
    "group_quartiles",
    """SELECT production_type, country, count(electricity_generated) AS observations, avg(electricity_generated) AS mean,
      stddev_samp(electricity_generated) AS deviation, quantile_cont(electricity_generated, 0.25) AS q25,
      quantile_cont(electricity_generated, 0.75) AS q75 FROM b_power GROUP BY 1, 2""",
    digits=_STATS,
)
def _(lake):
    return group_statistics(lake.power(), ("production_type", "country"), "electricity_generated")


@query(
    "dq_cleanse",
    """SELECT record_id, CASE WHEN installed_capacity IS NULL OR installed_capacity < 0 THEN 0.0
      ELSE round(installed_capacity, 2) END::DOUBLE AS cleansed FROM b_capacity""",
)
def _(lake):
    return lake.capacity().select("record_id", measures.cleansed(F.col("installed_capacity")).alias("cleansed"))


@query("normalise_country", "SELECT record_id, lower(trim(country)) AS country FROM b_capacity")
def _(lake):
    return lake.capacity().select("record_id", measures.normalised_country(F.col("country")).alias("country"))


@query(
    "dedup_latest",
    latest_sql("normal_capacity", "time_period, production_type, country", "ingestion_date DESC, record_id DESC"),
    "record_id time_period production_type country installed_capacity ingestion_date",
)
def _(lake):
    rows = silver.standardized_capacity(lake.capacity()).withColumnsRenamed(
        {"bronze_record_id": "record_id", "ingestion_timestamp": "ingestion_date", "installed_power": "installed_capacity"}
    )
    return keep_latest(rows, ("time_period", "production_type", "country"), "ingestion_date", "record_id")


_POWER = (
    "business_key timestamp production_type raw_type electricity_generated year month day hour country unit "
    "source_system bronze_record_id ingestion_timestamp data_quality_score is_valid is_anomaly"
)


@query("silver_power", "SELECT *, concat_ws('_', CAST(timestamp AS VARCHAR), raw_type, country) AS business_key FROM s_power", _POWER)
def _(lake):
    return lake.silver_power()


STEPS["legacy_power"] = latest_sql(
    "(SELECT * REPLACE (coarse AS production_type) FROM scored_power JOIN coarse_types USING (bronze_record_id)) AS c",
    "timestamp, production_type, country",
    "ingestion_timestamp DESC, bronze_record_id DESC",
)


@query("silver_power_legacy", "SELECT * FROM legacy_power", _POWER.replace("business_key ", "").replace("raw_type ", ""))
def _(lake):
    return silver.silver_public_power(lake.power(), NOW, taxonomy_name="coarse", dedup_on="standardized")


@query(
    "silver_price",
    """SELECT * REPLACE (CAST(electricity_price AS DOUBLE) AS electricity_price),
      concat_ws('_', CAST(timestamp AS VARCHAR), country) AS business_key FROM s_price""",
    "business_key timestamp electricity_price currency market year month day country unit source_system "
    "bronze_record_id ingestion_timestamp data_quality_score is_valid is_anomaly",
)
def _(lake):
    return lake.silver_price()


@query(
    "silver_installed",
    "SELECT *, concat_ws('_', CAST(timestamp AS VARCHAR), raw_type, country) AS business_key FROM s_capacity",
    "business_key timestamp production_type raw_type installed_power year month time_period country unit source_system "
    "bronze_record_id ingestion_timestamp data_quality_score is_valid",
)
def _(lake):
    return lake.silver_capacity()


_AUDITED = (
    "record_id business_key timestamp time_period production_type installed_capacity country data_source source_system "
    "dq_check_status dq_score is_anomaly bronze_record_id created_by"
)
STEPS["recent_a"] = "SELECT * FROM status_a WHERE ingestion_date >= TIMESTAMP '2001-08-01' - INTERVAL 30 DAY"
STEPS["checked_a"] = f"""SELECT * REPLACE ({fine_sql('production_type')} AS production_type,
    CASE WHEN installed_capacity IS NULL OR installed_capacity < 0 THEN 0.0 ELSE round(installed_capacity, 2) END::DOUBLE
      AS installed_capacity, lower(trim(country)) AS country) FROM ({STEPS['type_flags'].replace('b_capacity', 'recent_a')}) AS f"""
STEPS["audited_a"] = f"""SELECT * REPLACE (sha256(business_key) AS record_id) FROM (
    SELECT *, record_id AS bronze_record_id, concat_ws('_', time_period, production_type, country) AS business_key,
      'bronze_to_silver_installed_power_pipeline' AS created_by
    FROM checked_a WHERE dq_check_status IN ('VALID', 'WARNING')
    QUALIFY row_number() OVER (PARTITION BY time_period, production_type, country
      ORDER BY ingestion_date DESC, record_id DESC) = 1) AS l"""


@query("silver_installed_a", "SELECT * FROM audited_a", _AUDITED)
def _(lake):
    return silver.silver_installed_power_a(lake.capacity(), CAPACITY_NOW)


STEPS["audited_b"] = """SELECT * REPLACE (strptime(time_period, '%m.%Y') AS timestamp,
      concat_ws('-', substr(md5(business_key), 1, 8), substr(md5(business_key), 9, 4), '4' || substr(md5(business_key), 13, 3),
        'a' || substr(md5(business_key), 17, 3), substr(md5(business_key), 21, 12)) AS record_id) FROM (
    SELECT *, record_id AS bronze_record_id,
      concat_ws('_', time_period, replace(production_type, ' ', '_'), country) AS business_key,
      'bronze_to_silver_installed_power_pipeline' AS created_by
    FROM status_b WHERE dq_check_status <> 'ERROR'
    QUALIFY row_number() OVER (PARTITION BY time_period, production_type, country
      ORDER BY ingestion_date DESC, record_id DESC) = 1) AS l"""


@query("silver_installed_b", "SELECT * FROM audited_b", _AUDITED)
def _(lake):
    return silver.silver_installed_power_b(lake.capacity(), CAPACITY_NOW)


@query(
    "dq_summary",
    """SELECT count(*) AS total_records, count(*) FILTER (dq_check_status = 'VALID') AS valid_records,
      count(*) FILTER (dq_check_status = 'WARNING') AS warning_records,
      count(*) FILTER (dq_check_status = 'ERROR') AS error_records, count(*) FILTER (is_anomaly) AS anomaly_records,
      avg(dq_score) AS avg_dq_score, avg(installed_capacity) AS avg_installed_capacity,
      stddev_samp(installed_capacity) AS stddev_installed_capacity,
      count(DISTINCT production_type) AS unique_production_types, count(DISTINCT time_period) AS unique_time_periods,
      count(DISTINCT country) AS unique_countries, min(ingestion_date) AS earliest_bronze_record,
      max(ingestion_date) AS latest_bronze_record FROM status_b""",
    digits={"avg_dq_score": 4, "avg_installed_capacity": 2, "stddev_installed_capacity": 2},
)
def _(lake):
    return quality.quality_summary(silver.checked_capacity_b(lake.capacity()))


@query(
    "silver_stats",
    """SELECT count(*) AS total_silver_records, count(DISTINCT business_key) AS unique_business_keys,
      count(DISTINCT production_type) AS unique_production_types, min(timestamp) AS earliest_timestamp,
      max(timestamp) AS latest_timestamp, avg(installed_capacity) AS avg_capacity, sum(installed_capacity) AS total_capacity
      FROM audited_b""",
    digits={"avg_capacity": 2, "total_capacity": 1},
)
def _(lake):
    return quality.silver_statistics(silver.silver_installed_power_b(lake.capacity(), CAPACITY_NOW))


@query(
    "validity_counts",
    """SELECT count(*) AS total_records, count(*) FILTER (is_valid) AS valid_records,
      count(*) FILTER (NOT is_valid) AS invalid_records FROM s_power""",
)
def _(lake):
    return quality.validity_counts(lake.silver_power())


@query(
    "quarantine",
    """SELECT record_id, production_type, electricity_generated, 'positive_value' AS failed FROM b_power
      WHERE electricity_generated IS NULL OR electricity_generated <= 0""",
)
def _(lake):
    _, held = quality.apply_policy(lake.power(), quality.power_rules(), "quarantine")
    return held.select("record_id", "production_type", "electricity_generated", F.array_join("failed_rules", ",").alias("failed"))


@query("expectations_drop", "SELECT * FROM b_power WHERE electricity_generated > 0")
def _(lake):
    return quality.apply_policy(lake.power(), quality.power_rules(), "drop")[0]


@query(
    "business_keys",
    """SELECT record_id, concat_ws('_', time_period, production_type, country) AS plain,
      concat_ws('_', time_period, replace(production_type, ' ', '_'), country) AS underscored,
      sha256(concat_ws('_', time_period, production_type, country)) AS hashed,
      concat_ws('-', substr(md5(record_id), 1, 8), substr(md5(record_id), 9, 4), '4' || substr(md5(record_id), 13, 3),
        'a' || substr(md5(record_id), 17, 3), substr(md5(record_id), 21, 12)) AS uuid_shaped FROM b_capacity""",
)
def _(lake):
    parts = [F.col(c) for c in ("time_period", "production_type", "country")]
    return lake.capacity().select(
        "record_id",
        keys.period_key(*parts).alias("plain"),
        keys.period_key(*parts, underscored=True).alias("underscored"),
        keys.hashed_key(*parts).alias("hashed"),
        keys.uuid_shaped(F.col("record_id")).alias("uuid_shaped"),
    )


@query(
    "post_load_checks",
    """SELECT count(*) AS row_count, count(*) FILTER (timestamp IS NULL) AS null_timestamp,
      count(*) FILTER (production_type_id IS NULL) AS null_production_type_id,
      count(*) FILTER (electricity_produced IS NULL) AS missing_measure,
      count(*) FILTER (electricity_produced < 0) AS negative_measure FROM fact""",
)
def _(lake):
    return quality.post_load_checks(lake.fact(lake.dim()), ("timestamp", "production_type_id"), "electricity_produced")
