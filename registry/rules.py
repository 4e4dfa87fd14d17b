"""Rules over sets of rows."""

from datetime import timedelta

from pyspark.sql import functions as F

from gridlake.operators import setrules
from gridlake.operators.quality import power_rules
from registry.core import NOW, STEPS, query

_KEY = ("timestamp", "production_type", "country")
_FRESH = timedelta(hours=30)


def _findings(lake) -> setrules.Findings:
    rows = [setrules.Row(name, condition) for name, condition in power_rules().items()]
    hours = lake.price().select(F.col("timestamp").alias("hour"), "country")
    return setrules.check(
        lake.power().withColumn("hour", F.date_trunc("hour", "timestamp")),
        [
            *rows,
            setrules.Unique("one_record", ("record_id",)),
            setrules.Unique("one_value", _KEY),
            setrules.Reference("priced_hour", ("hour", "country"), hours),
            setrules.Reference("known_capacity", ("production_type",), lake.capacity()),
            setrules.Fresh("recent_type", ("production_type", "country"), "timestamp", NOW, _FRESH),
            setrules.Fresh("recent_value", ("production_type", "electricity_generated"), "timestamp", NOW, _FRESH),
        ],
    )


STEPS["priced_hours"] = "SELECT DISTINCT timestamp AS hour, country FROM b_price"
STEPS["capacity_types"] = "SELECT DISTINCT production_type FROM b_capacity"
STEPS["hourly_power"] = "SELECT *, date_trunc('hour', timestamp) AS hour FROM b_power"
_LAPSED = "max(timestamp) IS NULL OR max(timestamp) < TIMESTAMP '2024-01-29 18:00:00'"
STEPS["set_counts"] = f"""
  SELECT 'valid_timestamp' AS rule, 'row' AS kind, count(*) AS checked, count(*) - count(timestamp) AS failed FROM b_power
  UNION ALL SELECT 'positive_value', 'row', count(*),
    count(*) - count(*) FILTER (WHERE NOT isnan(electricity_generated) AND NOT isinf(electricity_generated) AND electricity_generated > 0) FROM b_power
  UNION ALL SELECT 'one_record', 'unique', count(*), count(*) - count(DISTINCT record_id) FROM b_power
  UNION ALL SELECT 'one_value', 'unique', count(*), count(*) - (SELECT count(*) FROM (SELECT DISTINCT timestamp, production_type, country FROM b_power)) FROM b_power
  UNION ALL SELECT 'priced_hour', 'reference', count(*), count(*) - count(h.hour) FROM hourly_power p
    LEFT JOIN priced_hours h ON p.hour = h.hour AND p.country = h.country WHERE p.hour IS NOT NULL AND p.country IS NOT NULL
  UNION ALL SELECT 'known_capacity', 'reference', count(*), count(*) - count(t.production_type) FROM b_power p
    LEFT JOIN capacity_types t ON p.production_type = t.production_type WHERE p.production_type IS NOT NULL
  UNION ALL SELECT 'recent_type', 'fresh', count(*), count(*) FILTER (WHERE lapsed)
    FROM (SELECT {_LAPSED} AS lapsed FROM b_power GROUP BY production_type, country)
  UNION ALL SELECT 'recent_value', 'fresh', count(*), count(*) FILTER (WHERE lapsed)
    FROM (SELECT {_LAPSED} AS lapsed FROM b_power GROUP BY production_type, electricity_generated)"""


@query("set_rules", "SELECT rule, kind, checked, failed, failed = 0 AS passed FROM set_counts")
def _(lake):
    return _findings(lake).report


# The keys themselves, for the rules whose keys are text or times.
@query(
    "set_rule_offenders",
    """SELECT rule, key, rows, latest FROM (
      SELECT 'one_value' AS rule, concat('{"timestamp":"', strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f'), '","production_type":"', production_type,
        '","country":"', country, '"}') AS key, count(*) AS rows, CAST(NULL AS TIMESTAMP) AS latest
        FROM b_power GROUP BY timestamp, production_type, country HAVING count(*) > 1
      UNION ALL SELECT 'priced_hour', concat('{"hour":"', strftime(p.hour, '%Y-%m-%d %H:%M:%S.%f'), '","country":"', p.country, '"}'), count(*), NULL
        FROM hourly_power p ANTI JOIN priced_hours h ON p.hour = h.hour AND p.country = h.country GROUP BY p.hour, p.country
      UNION ALL SELECT 'known_capacity', concat('{"production_type":"', production_type, '"}'), count(*), NULL
        FROM b_power WHERE production_type NOT IN (SELECT production_type FROM capacity_types) GROUP BY production_type)""",
)
def _(lake):
    return _findings(lake).offenders.filter(F.col("rule").isin("one_value", "priced_hour", "known_capacity"))
