import random
import statistics

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from gridlake.operators import quality
from gridlake.operators.dedup import keep_latest
from gridlake.operators.quantiles import group_statistics

NAN = float("nan")


def _power(spark, values):
    data = [(i, "Solar", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "id int, production_type string, x double")
    return df.withColumn("timestamp", F.timestamp_seconds("id"))


def test_scores(spark):
    got = quality.score_quality(_power(spark, [None, NAN, -1.0, 100001.0, 5.0]), "public_power", "x").orderBy("id").collect()
    assert [r.data_quality_score for r in got] == [0.0, 0.0, 0.3, 0.5, 1.0]
    assert [r.is_valid for r in got] == [False, False, False, True, True]
    price = quality.score_quality(_power(spark, [-1.0, 1001.0, None]), "price", "x").orderBy("id").collect()
    assert [(r.data_quality_score, r.is_valid) for r in price] == [(0.1, True), (0.5, True), (0.0, False)]


def test_missing_type_is_invalid(spark):
    df = _power(spark, [1.0]).withColumn("production_type", F.lit(None).cast("string"))
    assert quality.score_quality(df, "public_power", "x").first().is_valid is False


def test_equal_values_are_no_outliers(spark):
    flagged = quality.flag_outliers(_power(spark, [7.0] * 50), "x")
    assert flagged.filter("is_anomaly").isEmpty()


def test_outlier_and_missing(spark):
    got = quality.flag_outliers(_power(spark, [1.0, 2.0, 3.0] * 20 + [1000.0, None, NAN]), "x").orderBy("id").collect()
    assert [r.id for r in got if r.is_anomaly] == [60]


def test_outliers_against_a_history(spark):
    history = _power(spark, [1.0, 2.0, 3.0] * 20)
    flagged = quality.flag_outliers(_power(spark, [50.0, 51.0, 2.0]), "x", history)
    assert sorted(r.id for r in flagged.filter("is_anomaly").collect()) == [0, 1]


def test_group_outliers_with_null_group(spark):
    df = _power(spark, [1.0, 2.0, 3.0, 2.0, 500.0]).withColumn("production_type", F.lit(None).cast("string"))
    flagged = quality.flag_group_outliers(df, ("production_type",), "x")
    assert [r.id for r in flagged.filter("is_anomaly").collect()] == [4]
    joined = quality.flag_group_outliers(df, ("production_type",), "x", null_safe=False)
    assert joined.filter("is_anomaly").isEmpty() and joined.count() == 5


def _expected(values):
    found = [v for v in values if v is not None and v == v]
    return (
        len(found),
        statistics.fmean(found),
        statistics.stdev(found) if len(found) > 1 else None,
        *[float(np.percentile(found, p)) for p in (25, 50, 75)],
    )


@pytest.mark.parametrize("exact_rows", [1_000_000, 3])
def test_group_statistics_by_brute_force(spark, exact_rows):
    """Both the direct way and the narrowing over several steps, on awkward groups."""
    rng = random.Random(7)
    groups = {
        "hot": [rng.lognormvariate(3, 2) for _ in range(4000)],
        "ties": [float(rng.randint(0, 3)) for _ in range(500)],
        "signs": [rng.uniform(-5, 5) for _ in range(301)],
        "tiny": [1e-300, 2e-300, 5e-324, 0.0, -0.0, 1e120],
        "near": [1.0 + i * 2**-52 for i in range(64)],
        "one": [42.0],
        "gaps": [None, NAN, 3.0, None, 4.0],
    }
    data = [(g, v) for g, values in groups.items() for v in values] + [("none", None)]
    df = spark.createDataFrame(data, "g string, x double").repartition(7)
    got = {r.g: tuple(r)[1:] for r in group_statistics(df, ("g",), "x", (0.25, 0.5, 0.75), exact_rows).collect()}
    assert set(got) == set(groups)
    for name, values in groups.items():
        count, mean, deviation, *quartiles = _expected(values)
        assert got[name][0] == count
        assert got[name][1] == pytest.approx(mean, rel=1e-12, abs=1e-12)
        if deviation is None:
            assert got[name][2] is None
        else:
            assert got[name][2] == pytest.approx(deviation, rel=1e-9, abs=1e-12)
        assert list(got[name][3:]) == pytest.approx(quartiles, rel=1e-14, abs=0)


def test_group_statistics_needs_a_group(spark):
    with pytest.raises(ValueError, match="group column"):
        group_statistics(spark.range(3), (), "id")


def test_statistics_without_broadcast(spark):
    """The shuffle way of the lookup gives the same flags."""
    df = _power(spark, [float(i % 10) for i in range(300)] + [99.0])
    normal = rows(quality.flag_group_outliers(df, ("production_type",), "x"), "id", "is_anomaly")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(quality.flag_group_outliers(df, ("production_type",), "x"), "id", "is_anomaly") == normal
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64m")


def test_keep_latest(spark):
    data = [("a", 1, 1), ("a", 1, 2), ("a", 0, 9), (None, 5, 1), (None, 4, 1)]
    df = spark.createDataFrame(data, "k string, t int, id int")
    assert rows(keep_latest(df, ("k",), "t", "id")) == [(None, 5, 1), ("a", 1, 2)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = keep_latest(df, ("k",), "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_policies(spark):
    df = _power(spark, [1.0, 0.0, None, 2.0]).withColumnRenamed("x", "electricity_generated")
    rules = quality.power_rules()
    flagged, none = quality.apply_policy(df, rules, "flag")
    assert none is None and flagged.count() == 4 and flagged.filter("size(failed_rules) = 1").count() == 2
    good, held = quality.apply_policy(df, rules, "quarantine")
    assert (good.count(), held.count()) == (2, 2)
    assert quality.apply_policy(df, rules, "drop")[0].count() == 2


def test_status_levels(spark):
    data = [
        ("1", "01.2002", "Wind", 5.0, "de"),
        ("2", "1.2002", "Wind", 5.0, "de"),
        ("3", "01.2002", "Wind", 0.0, "de"),
        ("4", "01.2002", "", 5.0, "de"),
        ("5", "01.2002", "Wind", -5.0, "de"),
        ("6", "01.2002", "Wind", NAN, "de"),
        ("7", "01.2002", "W" * 101, 5.0, "de"),
        ("8", "01.2002", "Wind", 5.0, None),
    ]
    df = spark.createDataFrame(
        data, "record_id string, time_period string, production_type string, installed_capacity double, country string"
    )
    got = df.select("record_id", quality.status_a(), quality.score_a()).orderBy("record_id").collect()
    assert [tuple(r)[1:] for r in got] == [
        ("VALID", 5), ("WARNING", 2), ("WARNING", 3), ("ERROR", 4), ("ERROR", 2), ("ERROR", 1), ("WARNING", 3), ("ERROR", 1),
    ]
