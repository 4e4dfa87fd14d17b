import json
from datetime import date

import pytest
from helpers import rows, utc
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.sources import landing, payloads, windows

T0 = 1704067200


def _bronze(spark, kind, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "payload string").withColumns(
        {"country": F.lit("de"), "ingestion_date": F.lit(utc(2024, 1, 2))}
    )
    good, rejects = payloads.validate_payloads(payloads.parse_payloads(df, kind), kind)
    return payloads.to_bronze(good, kind, "b1"), rejects


def test_public_power(spark):
    payload = {
        "unix_seconds": [T0, T0 + 900, T0 + 1800],
        "production_types": [
            {"name": "Solar", "data": [1.5, None]},
            {"name": "Nuclear", "data": [3, 4, 5, 6]},
            {"data": [1]},
            {"name": "Load"},
        ],
    }
    bronze, rejects = _bronze(spark, "public_power", json.dumps(payload))
    assert rejects.isEmpty()
    assert rows(bronze, "production_type", "unix_seconds", "electricity_generated") == [
        ("Nuclear", T0, 3.0),
        ("Nuclear", T0 + 900, 4.0),
        ("Nuclear", T0 + 1800, 5.0),
        ("Solar", T0, 1.5),
        ("Solar", T0 + 900, None),
    ]
    assert bronze.select("record_id").distinct().count() == 5
    assert bronze.filter(F.unix_seconds("timestamp") != F.col("unix_seconds")).isEmpty()
    assert [f.name for f in bronze.schema] == schemas.BRONZE["public_power"].names


def test_no_times_is_valid_and_empty(spark):
    bronze, rejects = _bronze(spark, "public_power", '{"production_types":[{"name":"Solar","data":[1]}]}')
    assert bronze.isEmpty() and rejects.isEmpty()


def test_rejects(spark):
    texts = ("{}", "[]", "null", "not json", "[1,2]", '{"unix_seconds":[1]}', '{"unix_seconds":[],"production_types":[]}')
    bronze, rejects = _bronze(spark, "public_power", *texts)
    assert bronze.isEmpty()
    reasons = {r.payload: r.reject_reason for r in rejects.collect()}
    assert set(reasons) == set(texts)
    assert reasons["{}"] == "empty payload" and reasons["not json"] == "not an object"
    assert reasons['{"unix_seconds":[1]}'] == "missing production_types"


def test_price_units(spark):
    def units(unit):
        body = {"unix_seconds": [1, 2], "price": [61.3, -2.75], **unit}
        bronze, _ = _bronze(spark, "price", json.dumps(body))
        return [r[1] for r in rows(bronze, "unix_seconds", "electricity_unit")]

    assert units({"unit": "EUR / MWh"}) == ["EUR / MWh"] * 2
    assert units({"unit": ["EUR/MWh", ""]}) == ["EUR/MWh"] * 2
    assert units({}) == ["EUR/MWh"] * 2
    assert units({"unit": ""}) == ["EUR/MWh"] * 2
    assert units({"unit": ["X"]}) == ["X"]


def test_price_is_rounded_half_up(spark):
    bronze, _ = _bronze(spark, "price", '{"unix_seconds":[1],"price":[1.23455],"unit":"x"}')
    assert str(bronze.first().electricity_price) == "1.2346"


def test_installed_power(spark):
    series = [{"name": "Solar gross", "data": [0.0, 0.4]}, {"name": "Wind onshore", "data": [7310.25]}]
    bronze, _ = _bronze(spark, "installed_power", json.dumps({"time": ["04.2011", "05.2011"], "production_types": series}))
    assert rows(bronze, "time_period", "production_type", "installed_capacity", F.col("timestamp").cast("string")) == [
        ("04.2011", "Solar gross", 0.0, "2011-04-01 00:00:00"),
        ("05.2011", "Solar gross", 0.4, "2011-05-01 00:00:00"),
    ]
    bad, _ = _bronze(spark, "installed_power", json.dumps({"time": ["04.2011", "13.2011"], "production_types": series}))
    assert bad.isEmpty()
    short, _ = _bronze(spark, "installed_power", '{"time":["1.2011"],"production_types":[{"name":"Wind","data":[1]}]}')
    assert short.count() == 1
    half, rejects = _bronze(spark, "installed_power", '{"time":["04.2011"]}')
    assert half.isEmpty() and rejects.isEmpty()


def test_unknown_endpoint(spark):
    with pytest.raises(ValueError, match="unknown endpoint"):
        payloads.to_bronze(spark.range(1), "load", "b")
    with pytest.raises(ValueError):
        landing.landing_schema("load")


def test_ingest_appends_and_reports(spark, folder):
    source, target = folder("landing"), folder("bronze")
    lines = [
        json.dumps({"country": "de", "payload_date": "2024-01-01", "unix_seconds": [T0], "production_types": [{"name": "Solar", "data": [None]}]}),
        json.dumps({"country": "at", "payload_date": "2024-01-01", "unix_seconds": [T0], "production_types": [{"name": "Solar", "data": [2.0]}]}),
        json.dumps({"country": "at", "payload_date": "2024-01-01"}),
        "broken",
    ]
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(source)
    for batch in ("b1", "b2"):
        counts = landing.ingest(spark, source, "public_power", target, batch, utc(2024, 1, 2))
        assert counts == {"rows": 2, "missing": 1, "rejects": 2}
    stored = spark.read.parquet(target)
    assert stored.count() == 4 and stored.select("record_id").distinct().count() == 4
    assert stored.filter("ingestion_date is null").isEmpty()
    assert spark.read.parquet(f"{target}_rejects").count() == 4


def test_date_spine(spark):
    assert [r.day for r in windows.date_spine(spark, date(2024, 2, 28), date(2024, 3, 1)).collect()] == [
        date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1),
    ]
    clamped = windows.date_spine(spark, date(2024, 2, 28), date(2024, 3, 1), utc(2024, 2, 29, 5), until_yesterday=True)
    assert [r.day for r in clamped.collect()] == [date(2024, 2, 28)]
    assert windows.date_spine(spark, date(2024, 3, 1), date(2024, 2, 28)).isEmpty()


def test_interval_bounds():
    assert windows.interval_bounds(utc(2024, 1, 1, 0, 7, 30), 15) == (utc(2023, 12, 31, 23, 45), utc(2024, 1, 1, 0, 0))
    assert windows.interval_bounds(utc(2024, 1, 1, 10, 45), "15") == (utc(2024, 1, 1, 10, 30), utc(2024, 1, 1, 10, 45))


def test_missing_slots(spark):
    data = [("a", T0), ("a", T0 + 600), ("a", T0 + 3600), ("b", T0 + 1800)]
    df = spark.createDataFrame(data, "k string, s long").select("k", F.timestamp_seconds("s").alias("timestamp"))
    got = windows.missing_slots(df, utc(2024, 1, 1), utc(2024, 1, 1, 1, 30), 30, ("k",))
    assert rows(got, "k", F.unix_seconds("slot") - T0) == [("a", 1800), ("b", 0), ("b", 3600)]
    assert "CartesianProduct" not in got._jdf.queryExecution().executedPlan().toString()
