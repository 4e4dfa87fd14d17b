import json

from helpers import rows
from pyspark.sql import functions as F

from gridlake.streaming import jobs

T0 = 1704067200
DDL = "timestamp timestamp, k string, v int, t int, month int"


def _files(spark, path, *batches):
    for batch in batches:
        df = spark.createDataFrame(batch, "s long, k string, v int, t int")
        df.select(F.timestamp_seconds(F.col("s") + T0).alias("timestamp"), "k", "v", "t", F.lit(1).alias("month")).coalesce(1).write.mode("append").parquet(path)


def _stream(spark, path):
    from pyspark.sql.types import StructType

    return jobs.table_stream(spark, path, StructType.fromDDL(DDL))


def test_second_run_sees_only_new_files(spark, folder):
    source, sink, progress = folder("in"), folder("out"), folder("progress")
    _files(spark, source, [(0, "a", 1, 1)])
    jobs.run_to_files(_stream(spark, source), sink, progress)
    jobs.run_to_files(_stream(spark, source), sink, progress)
    assert spark.read.parquet(sink).count() == 1
    _files(spark, source, [(60, "b", 1, 1)])
    jobs.run_to_files(_stream(spark, source), sink, progress)
    assert rows(spark.read.parquet(sink), "k") == [("a",), ("b",)]


def test_late_older_row_does_not_win(spark, folder):
    source, sink, progress = folder("in"), folder("out"), folder("progress")
    for batch in ([(0, "a", 1, 5), (0, "b", 1, 1)], [(0, "a", 2, 3), (0, "b", 2, 2)]):
        _files(spark, source, batch)
        jobs.run_to_upsert(_stream(spark, source), sink, progress, ("k",), ("month",), ("t",))
    assert rows(spark.read.parquet(sink), "k", "v") == [("a", 1), ("b", 2)]


def test_duplicates_within_the_watermark(spark, folder):
    source, sink = folder("in"), folder("out")
    _files(spark, source, [(0, "a", 1, 1), (0, "a", 2, 1), (60, "a", 3, 1)])
    first = jobs.first_arrivals(_stream(spark, source), ("timestamp", "k"))
    jobs.run_to_files(first, sink, folder("progress"))
    assert spark.read.parquet(sink).count() == 2


def test_updated_windows_replace_stored_ones(spark, folder):
    source, sink, progress = folder("in"), folder("out"), folder("progress")
    for batch in ([(0, "a", 1, 1)], [(600, "a", 3, 1), (1900, "a", 7, 1)]):
        _files(spark, source, batch)
        rows_in = _stream(spark, source).withColumn("electricity_generated", F.col("v").cast("double"))
        totals = jobs.half_hour_totals(rows_in, ("k",))
        jobs.run_to_upsert(totals, sink, progress, ("k", "timestamp_30min"), ("year", "month"), ("data_points_count",), "update")
    got = rows(spark.read.parquet(sink), F.unix_seconds("timestamp_30min") - T0, "total_electricity_produced", "data_points_count")
    assert got == [(0, 4.0, 2), (1800, 7.0, 1)]


def test_a_small_batch_rewrites_one_day(spark, folder):
    source, sink, progress = folder("in"), folder("out"), folder("progress")
    day = 86400

    def stamps():
        return {f.split("day=")[1].split("/")[0]: f for f in spark.read.parquet(sink).inputFiles()}

    for batch in ([(0, "a", 1, 1), (day, "a", 1, 1), (2 * day, "a", 1, 1)], [(day + 60, "a", 5, 2)]):
        before = stamps() if batch[0][1] == "a" and len(batch) == 1 else None
        _files(spark, source, batch)
        dated = _stream(spark, source).withColumn("day", F.dayofmonth("timestamp"))
        jobs.run_to_upsert(dated, sink, progress, ("timestamp", "k"), ("month", "day"), ("t",))
    after = stamps()
    assert {d for d in after if after[d] != before[d]} == {"2"} and spark.read.parquet(sink).count() == 4


def test_second_sinks_hold_the_rest(spark, folder):
    source = folder("in")
    _files(spark, source, [(0, "a", 1, 1), (0, "b", -1, 1)])
    rows_in = _stream(spark, source).withColumn("electricity_generated", F.col("v").cast("double"))
    sink = folder("held")
    jobs.run_to_files(jobs.quarantined(rows_in), sink, folder("progress"))
    assert rows(spark.read.parquet(sink), "k", F.array_join("failed_rules", ",")) == [("b", "positive_value")]


def test_expectations_warn_or_drop(spark, folder):
    source = folder("in")
    _files(spark, source, [(0, "a", 1, 1), (0, "b", -1, 1)])
    rows_in = _stream(spark, source).withColumn("electricity_generated", F.col("v").cast("double"))
    for policy, expected in (("drop", 1), ("warn", 2)):
        sink = folder("out")
        jobs.run_to_files(jobs.expected_only(rows_in, policy), sink, folder("progress"))
        assert spark.read.parquet(sink).count() == expected


def test_landed_json(spark, folder):
    source, sink = folder("in"), folder("out")
    body = {"country": "de", "payload_date": "2024-01-01", "ingestion_date": "2024-01-01T00:00:00Z", "unix_seconds": [0], "price": [1.5], "unit": "EUR/MWh"}
    spark.createDataFrame([(json.dumps(body),), ("broken",)], "value string").write.text(source)
    stream = jobs.bronze_stream(jobs.landing_stream(spark, source, "price"), "price", "b")
    jobs.run_to_files(stream, sink, folder("progress"))
    assert rows(spark.read.parquet(sink), "unix_seconds", F.col("electricity_price").cast("double")) == [(0, 1.5)]
