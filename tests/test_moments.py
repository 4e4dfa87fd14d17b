"""Moments that are stored by month against those of all rows."""

import math
import statistics
from datetime import timedelta

import pytest
from helpers import rows, utc
from pyspark.sql import functions as F

from gridlake.operators import moments, quality
from gridlake.plans import lakehouse, silver
from gridlake.sources import staging, tables
from gridlake.sources.windows import in_months
from gridlake.workspace import materialise

SCHEMA = "timestamp timestamp, v double, k string"


@pytest.fixture(scope="module")
def frame(spark):
    start = utc(2023, 1, 1)
    values = [(start + timedelta(hours=7 * i), 1e6 + math.sin(i) * (i % 13), "a" if i % 3 else None) for i in range(1500)]
    odd = [(None, 1e6 + 3, "a"), (start, None, "a"), (start, float("nan"), None), (start, float("inf"), "b"), (None, None, "c")]
    return spark.createDataFrame(values + odd, SCHEMA)


def test_merged_equals_the_whole(spark, frame):
    """Means far from zero, one group, many groups, null groups."""
    parts = materialise(moments.moments(frame.withColumn("m", F.month("timestamp")), "v", ("k", "m")), "parts")
    good = [r for r in frame.collect() if r.v is not None and math.isfinite(r.v)]
    whole = moments.merged(parts).select("n", "mean", moments.deviation().alias("d")).first()
    values = [r.v for r in good]
    assert whole.n == len(values) and whole.mean == pytest.approx(statistics.fmean(values), rel=1e-14)
    assert whole.d == pytest.approx(statistics.stdev(values), rel=1e-9)
    for r in moments.merged(parts, ("k",)).select("k", "n", "mean", moments.deviation().alias("d")).collect():
        own = [g.v for g in good if g.k == r.k]
        assert (r.n, r.mean, r.d) == (len(own), pytest.approx(statistics.fmean(own), rel=1e-14), pytest.approx(statistics.stdev(own), rel=1e-9))


def test_one_value_and_none(spark):
    one = moments.moments(spark.createDataFrame([(None, 5.0, "a")], SCHEMA), "v")
    assert tuple(moments.merged(one).select("n", "mean", moments.deviation()).first()) == (1, 5.0, None)
    none = moments.merged(moments.moments(spark.createDataFrame([], SCHEMA), "v", ("k",)), ("k",))
    assert none.count() == 0
    flagged = quality.flag_outliers(spark.createDataFrame([(None, 5.0, "a")], SCHEMA), "v", stored=one)
    assert [r.is_anomaly for r in flagged.collect()] == [False]


def test_refresh_reads_and_replaces_its_months_only(spark, frame, folder):
    path = folder("moments")
    first = rows(moments.refresh(spark, path, frame, "v"))
    assert {r[:2] for r in map(tuple, moments.refresh(spark, path, frame, "v").collect())} >= {(2023, 1), (None, None)}
    # Later only March is passed; the other months are gone from the history, and stay in the table.
    march = frame.filter(F.month("timestamp") == 3)
    assert rows(moments.refresh(spark, path, march, "v", [(2023, 3)])) == first
    doubled = march.unionByName(march)
    again = {r[:2]: r[2] for r in rows(moments.refresh(spark, path, doubled, "v", [(2023, 3)]))}
    was = {r[:2]: r[2] for r in first}
    assert again == {**was, (2023, 3): 2 * was[2023, 3]}
    # A month that is empty now, one that never was, and the rows without a time.
    left = moments.refresh(spark, path, frame.limit(0), "v", [(2023, 3), (2031, 1), (None, None)])
    assert {r[:2] for r in rows(left)} == was.keys() - {(2023, 3), (None, None)}


def test_months_as_ranges(frame):
    found = frame.filter(in_months(frame, "timestamp", [(2023, 12), (2024, 1), (2023, 3), (None, None)]))
    expected = frame.filter("(year(timestamp), month(timestamp)) in ((2023, 12), (2024, 1), (2023, 3)) or timestamp is null")
    assert rows(found) == rows(expected) and found.count() > 100
    assert frame.filter(in_months(frame, "timestamp", [])).count() == 0
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert text.count(">=") == 2, "December and January are one range"


def test_incremental_limits_need_no_old_bronze(spark, folder):
    """The second run finds the folders of the first months deleted and still flags by all months."""
    power = staging.bronze_public_power(spark, "/root/testdata/sf0.001")
    back = F.make_ym_interval(F.lit(0), (F.col("record_id").cast("long") % 3).cast("int"))
    power = power.withColumn("timestamp", F.col("timestamp") - back).withColumns({"year": F.year("timestamp"), "month": F.month("timestamp")})
    expected = rows(silver.silver_public_power(power, utc(2024, 1, 31)).filter("year = 2024").select("business_key", "is_anomaly"))
    path, root = folder("bronze"), folder("lake")
    tables.overwrite_table(power, path, ("year", "month"))
    bronze = {"public_power": spark.read.parquet(path)}
    old = {"public_power": bronze["public_power"].filter("year = 2023")}
    lakehouse.build_silver(spark, old, root, utc(2024, 1, 31), "b1", old)
    folder_2023 = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/year=2023")
    folder_2023.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder_2023, True)
    left = spark.read.schema(power.schema).parquet(path)
    lakehouse.build_silver(spark, {"public_power": left}, root, utc(2024, 1, 31), "b2", {"public_power": left})
    found = spark.read.parquet(f"{root}/silver_public_power").filter("year = 2024").select("business_key", "is_anomaly")
    assert rows(found) == expected and any(flag for _, flag in expected)
