"""Payloads with unknown, missing and retyped fields."""

from helpers import rows, utc
from pyspark.sql import functions as F

from gridlake.sources import drift

TEXTS = [
    '{"unix_seconds":[1,2],"production_types":[{"name":"a","data":[1,2.5]},7,{"name":"b","unit":"MW","data":null}],"x":{"a":[1]}}',
    '{"unix_seconds":["1"],"production_types":[],"x":null}',
    '{"production_types":"none","odd name.[]":1}',
    "{}",
    "[1]",
    "nope",
    '{"x":1,"x":2}',
    "",
    None,
]


def payloads(spark, texts=TEXTS):
    data = [(i, utc(2024, 1, 1 + i), t) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "id int, ingestion_date timestamp, payload string")


def test_unknown_fields_are_kept_as_they_came(spark, folder):
    path = folder()
    drift.with_unknown(payloads(spark), "public_power").write.parquet(path)
    kept = spark.read.parquet(path)
    assert rows(kept.filter("unknown IS NULL"), "id") == [(i,) for i in range(4, 9)]
    found = kept.select("id", F.inline("unknown")).withColumn("value", F.to_json("value"))
    assert {tuple(r) for r in found.select("id", "field", "item", "value").collect()} == {
        (0, "x", None, '{"a":[1]}'),
        (0, "production_types[].unit", 2, '"MW"'),
        (1, "x", None, "null"),
        (2, "odd name.[]", None, "1"),
    }


def test_report(spark):
    found = {r.field: (r.status, r.given, r.missing, r.type) for r in drift.report(payloads(spark), "public_power").collect()}
    assert found == {
        "unix_seconds": ("retyped", 2, 2, "ARRAY<VARIANT>"),
        "production_types": ("retyped", 3, 1, "VARIANT"),
        "production_types[].name": ("known", 2, 0, "STRING"),
        "production_types[].data": ("known", 2, 0, "ARRAY<DECIMAL(21,1)>"),
        "production_types[].unit": ("unknown", 1, None, "STRING"),
        "x": ("unknown", 2, None, "OBJECT<a: ARRAY<BIGINT>>"),
        "odd name.[]": ("unknown", 1, None, "BIGINT"),
    }
    seen = drift.report(payloads(spark), "public_power").filter("field = 'x'").select(F.day("first_seen"), F.day("last_seen"))
    assert rows(seen) == [(1, 2)]


def test_nothing_to_read(spark):
    for texts in ([], ["[]", None]):
        found = drift.report(payloads(spark, texts), "price").collect() if texts else drift.report(payloads(spark).limit(0), "price").collect()
        assert {(r.field, r.status, r.given, r.missing, r.type) for r in found} == {
            (f, "known", 0, 0, None) for f in ("unix_seconds", "price", "unit")
        }


def test_a_price_unit_has_two_forms(spark):
    texts = ['{"unix_seconds":[1],"price":[1.5],"unit":"EUR"}', '{"unix_seconds":[1],"price":[null],"unit":"EUR"}']
    assert {r.status for r in drift.report(payloads(spark, texts), "price").collect()} == {"known"}
    texts = ['{"unix_seconds":[1],"price":[1.5],"unit":["EUR"]}']
    assert {r.status for r in drift.report(payloads(spark, texts), "price").collect()} == {"known"}
    texts = ['{"unix_seconds":[1],"price":["1.5"],"unit":{"a":1}}']
    assert rows(drift.report(payloads(spark, texts), "price").filter("status = 'retyped'"), "field") == [("price",), ("unit",)]


def test_streams_keep_unknown_fields(spark, folder):
    path, out = folder("landed"), folder("kept")
    payloads(spark).write.parquet(path)
    stream = spark.readStream.schema(payloads(spark).schema).parquet(path)
    kept = drift.with_unknown(stream, "public_power").select("id", F.size("unknown").alias("n"))
    query = kept.writeStream.format("parquet").option("checkpointLocation", folder("state")).trigger(availableNow=True).start(out)
    query.awaitTermination()
    assert rows(spark.read.schema("id int, n int").parquet(out).filter("n > 0")) == [(0, 2), (1, 1), (2, 1)]
