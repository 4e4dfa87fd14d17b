"""Reports, features, baselines."""

from pyspark.sql import functions as F

from gridlake.operators import series
from gridlake.plans import baseline, lakehouse, reports
from gridlake.workspace import materialise, scratch_path
from registry.core import NOW, STEPS, query

_TREND = """SELECT f.year, f.month, f.day, d.production_plant_name AS production_type,
    sum(electricity_produced) AS total_daily_production
  FROM fact f JOIN dim d USING (production_type_id) WHERE f.country = 'de' GROUP BY 1, 2, 3, 4"""


@query("daily_trend", _TREND, digits={"total_daily_production": 3})
def _(lake):
    dim = lake.dim()
    return reports.daily_trend(lake.fact(dim), dim)


@query("daily_trend_sql", _TREND, digits={"total_daily_production": 3})
def _(lake):
    """The same report as parameterised SQL over frames."""
    dim = lake.dim()
    return lake.spark.sql(
        """WITH plants AS (SELECT production_type_id, production_plant_name AS production_type FROM {dim} WHERE active_flag)
           SELECT year, month, day, production_type, sum(electricity_produced) AS total_daily_production
           FROM {fact} JOIN plants USING (production_type_id) WHERE country = :country GROUP BY ALL ORDER BY ALL""",
        args={"country": "de"},
        fact=lake.fact(dim),
        dim=dim,
    )


@query(
    "daily_trend_renewable",
    """SELECT f.year, f.month, f.day, d.production_plant_name AS production_type,
      sum(electricity_produced) AS total_daily_production FROM fact f JOIN dim d USING (production_type_id)
      WHERE f.country = 'at' AND energy_category = 'Renewable' GROUP BY 1, 2, 3, 4""",
    digits={"total_daily_production": 3},
)
def _(lake):
    dim = lake.dim()
    return reports.daily_trend(lake.fact(dim), dim, "at", "Renewable")


@query(
    "wind_price",
    """SELECT f.year, f.month, f.day, d.production_plant_name AS production_type,
      sum(electricity_produced) AS total_daily_production_mw, avg(electricity_price) AS avg_daily_price_eur_per_mwh
      FROM fact f JOIN dim d USING (production_type_id)
      WHERE f.country = 'de' AND d.production_plant_name IN ('Wind offshore', 'Wind onshore') GROUP BY 1, 2, 3, 4""",
    digits={"total_daily_production_mw": 3, "avg_daily_price_eur_per_mwh": 4},
)
def _(lake):
    dim = lake.dim()
    return reports.wind_price(lake.fact(dim), dim)


@query(
    "wind_price_views",
    """SELECT f.year, f.month, f.day, d.production_plant_name AS production_type,
      sum(electricity_produced) AS total_daily_production_mw, avg(electricity_price) AS avg_daily_price_eur_per_mwh
      FROM fact f JOIN dim d USING (production_type_id)
      WHERE f.country = 'at' AND d.production_plant_name IN ('Wind offshore', 'Wind onshore') GROUP BY 1, 2, 3, 4""",
    digits={"total_daily_production_mw": 3, "avg_daily_price_eur_per_mwh": 4},
)
def _(lake):
    """SQL with parameters over the published views of a stored run."""
    root = scratch_path(lake.spark, "lakehouse")
    bronze = {"public_power": lake.power(), "price": lake.price(), "installed_power": lake.capacity()}
    lakehouse.run(lake.spark, bronze, root, NOW, "batch-1")
    lakehouse.publish_views(lake.spark, root)
    return lake.spark.sql(
        """WITH plants AS (
             SELECT production_type_id, production_plant_name AS production_type FROM gold_dim_production_type
             WHERE active_flag AND array_contains(:names, production_plant_name))
           SELECT year, month, day, production_type, sum(electricity_produced) AS total_daily_production_mw,
             avg(electricity_price) AS avg_daily_price_eur_per_mwh
           FROM gold_fact_power JOIN plants USING (production_type_id) WHERE country = :country GROUP BY ALL""",
        args={"country": "at", "names": F.array(F.lit("Wind offshore"), F.lit("Wind onshore"))},
    )


STEPS["featured"] = """SELECT h.*, production_plant_name, energy_category, controllability_type
  FROM half_hours h JOIN dim USING (production_type_id) WHERE h.country = 'de'"""
_FEATURES = (
    "timestamp_30min production_type_id production_plant_name energy_category controllability_type "
    "total_electricity_produced year month day hour minute_interval_30 lag_1d lag_1w rolling_7d_avg"
)
_FEATURE_DIGITS = {"total_electricity_produced": 3, "lag_1d": 3, "lag_1w": 3, "rolling_7d_avg": 3}
_ROW_LAGS = """lag(total_electricity_produced, 48) OVER s AS lag_1d, lag(total_electricity_produced, 336) OVER s AS lag_1w"""
_SERIES_SQL = "s AS (PARTITION BY production_type_id ORDER BY timestamp_30min)"


@query(
    "underperf_features",
    f"""SELECT *, {_ROW_LAGS}, avg(total_electricity_produced) OVER (PARTITION BY production_type_id ORDER BY timestamp_30min
      ROWS BETWEEN 335 PRECEDING AND CURRENT ROW) AS rolling_7d_avg FROM featured WINDOW {_SERIES_SQL}""",
    _FEATURES,
    _FEATURE_DIGITS,
)
def _(lake):
    dim = lake.dim()
    return reports.underperformance_features(lake.half_hours(dim), dim)


@query(
    "rolling_slot_7d",
    f"""SELECT *, {_ROW_LAGS}, avg(total_electricity_produced) OVER (PARTITION BY production_type_id, hour, minute_interval_30
      ORDER BY timestamp_30min RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 30 MINUTES PRECEDING) AS rolling_7d_avg
      FROM featured WINDOW {_SERIES_SQL}""",
    _FEATURES,
    _FEATURE_DIGITS,
)
def _(lake):
    dim = lake.dim()
    return reports.underperformance_features(lake.half_hours(dim), dim, rolling="slot")


@query(
    "lag_gap_safe",
    """SELECT h.country, h.timestamp_30min, h.production_type_id, h.total_electricity_produced,
        d.total_electricity_produced AS lag_1d, w.total_electricity_produced AS lag_1w
      FROM half_hours h
      LEFT JOIN half_hours d ON d.production_type_id = h.production_type_id AND d.timestamp_30min = h.timestamp_30min - INTERVAL 1 DAY
      LEFT JOIN half_hours w ON w.production_type_id = h.production_type_id AND w.timestamp_30min = h.timestamp_30min - INTERVAL 7 DAY""",
    "country timestamp_30min production_type_id total_electricity_produced lag_1d lag_1w",
    {"total_electricity_produced": 3, "lag_1d": 3, "lag_1w": 3},
)
def _(lake):
    total, by = "total_electricity_produced", ("production_type_id", "country")
    return lake.half_hours(lake.dim()).select(
        "country",
        "timestamp_30min",
        "production_type_id",
        total,
        series.lag_time(total, by, 86400).alias("lag_1d"),
        series.lag_time(total, by, 7 * 86400).alias("lag_1w"),
    )


@query(
    "daily_growth",
    """SELECT CAST(CAST(timestamp AS DATE) AS VARCHAR) AS production_date, production_plant_name, energy_category,
        sum(electricity_produced) AS daily_production, avg(electricity_price) AS avg_daily_price,
        lag(sum(electricity_produced)) OVER (PARTITION BY production_plant_name ORDER BY CAST(timestamp AS DATE))
          AS previous_day_production
      FROM fact f JOIN dim d USING (production_type_id) WHERE timestamp >= TIMESTAMP '2024-01-31' - INTERVAL 30 DAY
      GROUP BY CAST(timestamp AS DATE), production_plant_name, energy_category""",
    digits={"daily_production": 3, "avg_daily_price": 4, "previous_day_production": 3},
)
def _(lake):
    dim = lake.dim()
    return reports.daily_growth(lake.fact(dim), dim, NOW)


@query(
    "renewable_share",
    """SELECT f.country, f.year, f.month, f.day,
        sum(CASE WHEN energy_category = 'Renewable' THEN electricity_produced END) AS renewable_production,
        sum(electricity_produced) AS total_production,
        sum(CASE WHEN energy_category = 'Renewable' THEN electricity_produced END) / nullif(sum(electricity_produced), 0)
          AS renewable_share
      FROM fact f JOIN dim d USING (production_type_id) GROUP BY 1, 2, 3, 4""",
    digits={"renewable_production": 3, "total_production": 3, "renewable_share": 4},
)
def _(lake):
    dim = lake.dim()
    return reports.renewable_share(lake.fact(dim), dim)


# The staged data covers one month, so a weekday and half hour has at most five observations: the
# registered baselines ask for two instead of the default ten.
_MIN_OBSERVATIONS = 2
_SLOT_SQL = """CAST(dayofweek(timestamp_30min) + 1 AS INTEGER) AS day_of_week, CASE WHEN month(timestamp_30min) IN (12, 1, 2) THEN 'Winter'
    WHEN month(timestamp_30min) IN (3, 4, 5) THEN 'Spring' WHEN month(timestamp_30min) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END
    AS season"""
STEPS["slotted"] = f"SELECT *, {_SLOT_SQL} FROM half_hours"
STEPS["base"] = f"""SELECT g.*, energy_category, controllability_type,
    baseline_avg_production - baseline_std_production * 1.5 AS underperformance_threshold_moderate,
    baseline_avg_production - baseline_std_production * 2.0 AS underperformance_threshold_severe,
    baseline_p25_production AS underperformance_threshold_quartile
  FROM (SELECT production_type_id, hour, minute_interval_30, day_of_week, season,
      avg(avg_electricity_produced) AS baseline_avg_production,
      quantile_cont(avg_electricity_produced, 0.5) AS baseline_median_production,
      quantile_cont(avg_electricity_produced, 0.25) AS baseline_p25_production,
      quantile_cont(avg_electricity_produced, 0.75) AS baseline_p75_production,
      stddev_samp(avg_electricity_produced) AS baseline_std_production, count(*) AS historical_observations
    FROM slotted WHERE timestamp_30min >= TIMESTAMP '2024-01-31' - INTERVAL 90 DAY
    GROUP BY 1, 2, 3, 4, 5 HAVING count(*) >= {_MIN_OBSERVATIONS}) AS g
  LEFT JOIN dim d USING (production_type_id)"""


@query(
    "baseline",
    "SELECT * FROM base",
    digits={
        f"baseline_{m}_production": 3 for m in ("avg", "median", "p25", "p75", "std")
    }
    | {f"underperformance_threshold_{t}": 3 for t in ("moderate", "severe", "quartile")},
)
def _(lake):
    dim = lake.dim()
    rows = baseline.performance_baseline(lake.half_hours(dim), dim, NOW, min_observations=_MIN_OBSERVATIONS)
    return rows.drop("created_at", "updated_at")


_LOW_SQL = """SELECT * FROM (SELECT h.timestamp_30min, production_plant_name, h.country, d.controllability_type,
    avg_electricity_produced AS actual_production, baseline_avg_production AS expected_production,
    CASE WHEN avg_electricity_produced < baseline_avg_production - baseline_std_production * {severe} THEN 'Severe'
      WHEN avg_electricity_produced < baseline_avg_production - baseline_std_production * {moderate} THEN 'Moderate'
      ELSE 'Normal' END AS performance_status,
    (avg_electricity_produced - baseline_avg_production) / nullif(baseline_avg_production, 0) * 100 AS deviation_pct
  FROM slotted h JOIN dim d USING (production_type_id)
  JOIN base b ON h.production_type_id = b.production_type_id AND h.hour = b.hour
    AND h.minute_interval_30 = b.minute_interval_30 AND h.day_of_week = b.day_of_week AND h.season = b.season
  WHERE timestamp_30min >= TIMESTAMP '2024-01-31' - INTERVAL 720 HOUR) AS c
  WHERE performance_status IN ('Severe', 'Moderate')"""
_LOW_DIGITS = {"actual_production": 3, "expected_production": 3, "deviation_pct": 2}


def _underperformance(lake, **thresholds):
    dim = lake.dim()
    agg = materialise(lake.half_hours(dim), "half_hours")
    base = baseline.performance_baseline(agg, dim, NOW, min_observations=_MIN_OBSERVATIONS, **thresholds)
    return baseline.underperformance(agg, base, dim, NOW, hours=720)


@query("underperformance", _LOW_SQL.format(moderate=1.5, severe=2.0), digits=_LOW_DIGITS)
def _(lake):
    return _underperformance(lake)


@query("underperformance_tight", _LOW_SQL.format(moderate=0.7, severe=1.0), digits=_LOW_DIGITS)
def _(lake):
    """With so few observations hardly a value is 1.5 deviations low; tighter thresholds find some."""
    return _underperformance(lake, moderate=0.7, severe=1.0)


@query(
    "capacity_utilisation",
    """SELECT timestamp_30min, production_plant_name AS production_type, h.country, avg_electricity_produced, installed_mw,
        avg_electricity_produced / nullif(installed_mw, 0) AS utilisation
      FROM half_hours h JOIN dim USING (production_type_id)
      LEFT JOIN (SELECT production_type, country, timestamp + INTERVAL 270 MONTH AS mon, sum(installed_power) * 1000 AS installed_mw
        FROM s_capacity WHERE is_valid GROUP BY 1, 2, 3) AS c
      ON c.production_type = production_plant_name AND c.country = h.country AND c.mon = date_trunc('month', timestamp_30min)""",
    digits={"avg_electricity_produced": 4, "installed_mw": 0, "utilisation": 9},
)
def _(lake):
    """The staged capacities end in July 2001; they are moved to January 2024 to meet the production."""
    dim = lake.dim()
    moved = F.col("timestamp") + F.make_ym_interval(F.lit(0), F.lit(270))
    installed = lake.silver_capacity().withColumn("timestamp", moved)
    return reports.capacity_utilisation(lake.half_hours(dim), dim, installed)


STEPS["moved_half_hours"] = """SELECT * REPLACE (timestamp_30min - to_months(day % 5) AS timestamp_30min) FROM half_hours"""
STEPS["sparse_capacity"] = """SELECT production_type, country, timestamp + INTERVAL 270 MONTH AS mon, sum(installed_power) * 1000 AS installed_mw
  FROM s_capacity WHERE is_valid AND month(timestamp + INTERVAL 270 MONTH) % 4 = 3 GROUP BY 1, 2, 3"""


@query(
    "capacity_as_of",
    """SELECT h.timestamp_30min, production_plant_name AS production_type, h.country, avg_electricity_produced, installed_mw,
        avg_electricity_produced / nullif(installed_mw, 0) AS utilisation
      FROM (SELECT h.*, production_plant_name FROM moved_half_hours h JOIN dim USING (production_type_id)) AS h
      ASOF LEFT JOIN sparse_capacity c ON c.production_type = h.production_plant_name AND c.country = h.country
        AND h.timestamp_30min >= c.mon""",
    digits={"avg_electricity_produced": 4, "installed_mw": 0, "utilisation": 9},
)
def _(lake):
    """Production of five months, capacities of every fourth: the months between have the last one known."""
    dim = lake.dim()
    installed = lake.silver_capacity().withColumn("timestamp", F.col("timestamp") + F.make_ym_interval(F.lit(0), F.lit(270)))
    back = F.make_ym_interval(F.lit(0), F.col("day") % 5)
    agg = lake.half_hours(dim).withColumn("timestamp_30min", F.col("timestamp_30min") - back)
    return reports.capacity_utilisation(agg, dim, installed.filter(F.month("timestamp") % 4 == 3), carry_forward=True)
