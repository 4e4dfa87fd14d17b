"""The landing register and gold from changed rows."""

import json

import pytest
from helpers import rows, utc
from pyspark.sql import functions as F

from gridlake.operators import merge
from gridlake.plans import lakehouse
from gridlake.sources import landing, staging, tables

NOW = utc(2024, 1, 31)


@pytest.fixture()
def landed(spark, folder):
    """A landing folder, a function that puts a file there, and one that ingests and returns (rows, rejects) so far."""
    root, bronze, register = folder("landing"), folder("bronze"), folder("register")
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def put(name, *payloads):
        out = files.create(path(f"{root}/{name}"), True)
        out.write(bytearray("".join(json.dumps(p) + "\n" for p in payloads), "utf-8"))
        out.close()

    def ingest(batch):
        counts = landing.ingest_new(spark, root, "public_power", bronze, register, batch, NOW)
        found = spark.read.parquet(bronze).select("unix_seconds", "electricity_generated", "ingestion_batch_id")
        rejected = f"{bronze}_rejects"
        n = spark.read.parquet(rejected).count() if tables.table_exists(spark, rejected) else 0
        return counts, rows(found), n

    return put, ingest, (root, bronze, register)


def payload(second, value):
    return {"country": "de", "unix_seconds": [second], "production_types": [{"name": "Solar", "data": [value]}]}


def test_files_are_ingested_once(landed):
    put, ingest, _ = landed
    put("a.json", payload(900, 1.0), {"country": "de"})
    counts, found, rejects = ingest("b1")
    assert counts == {"rows": 1, "missing": 0, "rejects": 1, "files": 1} and found == [(900, 1.0, "b1")] and rejects == 1
    assert ingest("b2") == ({"rows": 0, "missing": 0, "rejects": 0, "files": 0}, found, 1)
    put("b.json", payload(1800, 2.0))
    assert ingest("b3")[1] == [(1800, 2.0, "b3"), (900, 1.0, "b1")]
    # Replaced by a longer one: new content, so it counts again.
    put("b.json", payload(1800, 2.5), payload(2700, 3.0))
    counts, found, _ = ingest("b4")
    assert counts["files"] == 1 and counts["rows"] == 2 and len(found) == 4


@pytest.mark.parametrize("reached", ["begun", "bronze", "rejects"])
def test_a_batch_that_was_cut_off(spark, landed, monkeypatch, reached):
    """The process ends after the register's first note, after the bronze rows, or after the rejects; nothing is lost or doubled."""
    put, ingest, (root, bronze, register) = landed
    put("0.json", payload(0, 0.5))
    ingest("b0")
    put("a.json", payload(900, 1.0), payload(1800, None), {"country": "at"})

    class Ended(Exception):
        pass

    append, steps = tables.append_table, []

    def until(df, path, *more):
        steps.append(path)
        if len(steps) > {"begun": 1, "bronze": 2, "rejects": 3}[reached]:
            raise Ended
        append(df, path, *more)

    monkeypatch.setattr(tables, "append_table", until)
    with pytest.raises(Ended):
        ingest("b1")
    monkeypatch.setattr(tables, "append_table", append)
    put("later.json", payload(2700, 4.0))
    counts, found, rejects = ingest("b2")
    assert counts["files"] == 2 and rejects == 1
    assert found == [(0, 0.5, "b0"), (1800, None, "b1"), (2700, 4.0, "b2"), (900, 1.0, "b1")]
    ids = [r.record_id for r in spark.read.parquet(bronze).collect()]
    assert len(set(ids)) == 4 and ingest("b3")[0]["files"] == 0


def _bronze(spark, sf_dir):
    power, price = staging.bronze_public_power(spark, sf_dir), staging.bronze_price(spark, sf_dir)
    back = F.make_ym_interval(F.lit(0), (F.dayofmonth("timestamp") % 3).cast("int"))
    return {
        "public_power": power.withColumn("timestamp", F.col("timestamp") - back),
        "price": price.withColumn("timestamp", F.col("timestamp") - back),
        "installed_power": staging.bronze_installed_power(spark, sf_dir),
    }


def _content(spark, path, condition="true"):
    frame = spark.read.parquet(path).filter(condition).drop("created_at", "updated_at")
    return rows(frame.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in sorted(frame.dtypes)]))


def test_changes_equal_a_full_build(spark, sf_dir, folder):
    """Late production, a corrected price and a corrected value; the facts of the month without changes may even be gone."""
    root, whole = folder("root"), folder("whole")
    bronze = _bronze(spark, sf_dir)
    lakehouse.run(spark, bronze, root, NOW, "b1")
    later = F.col("ingestion_date") + F.expr("interval 1 day")
    november = F.month("timestamp") == 11
    power = bronze["public_power"].filter(~november & (F.xxhash64("record_id") % 7 == 0))
    power = power.withColumns({"electricity_generated": F.col("electricity_generated") + 1000, "ingestion_date": later})
    price = bronze["price"].filter(~november & (F.xxhash64("record_id") % 5 == 0))
    price = price.withColumns({"electricity_price": (F.col("electricity_price") * 2).cast("decimal(10,4)"), "ingestion_date": later})
    kept = _content(spark, f"{root}/gold_fact_power_30min_agg")
    lakehouse.build_silver(spark, {"public_power": power, "price": price}, root, NOW, "b2", note_changes=True)
    for table in ("gold_fact_power", "gold_fact_power_30min_agg", "silver_public_power", "silver_price"):
        tables.delete_folder(spark, f"{root}/{table}/year=2023/month=11")
    counts = lakehouse.gold_from_changes(spark, root, NOW)
    both = {k: bronze[k].unionByName(v) for k, v in (("public_power", power), ("price", price))}
    lakehouse.run(spark, bronze | both, whole, NOW, "b1")
    for table in ("gold_fact_power", "gold_fact_power_30min_agg"):
        full = spark.read.parquet(f"{whole}/{table}").filter("month <> 11").count()
        assert 0 < counts[table] < full * (1 if table == "gold_fact_power" else 0.9)
        assert _content(spark, f"{root}/{table}") == _content(spark, f"{whole}/{table}", "month <> 11")
    assert kept != _content(spark, f"{root}/gold_fact_power_30min_agg")
    # Nothing new: nothing is noted, nothing is written.
    lakehouse.build_silver(spark, {"public_power": power, "price": price}, root, NOW, "b3", note_changes=True)
    assert lakehouse.gold_from_changes(spark, root, NOW) == {"gold_fact_power": 0, "gold_fact_power_30min_agg": 0}


def test_changes_of_an_upsert(spark, folder):
    path, noted = folder("table"), folder("noted")
    schema = "k string, y int, v int, t int, batch string"

    def put(*values):
        merge.upsert_table(spark, path, spark.createDataFrame(list(values), schema), ("k",), ("y",), ("t",), changes=noted, unnoted=("batch",))
        return rows(spark.read.parquet(noted), "change_type", "k", "v")

    assert put(("a", 1, 1, 1, "x"), ("b", 2, 1, 1, "x")) == [("insert", "a", 1), ("insert", "b", 1)]
    # Newer and equal, newer and different, older, new, and a null value.
    assert put(("a", 1, 1, 1, "y")) == []
    assert put(("a", 1, 5, 2, "z"), ("b", 2, 9, 0, "z"), ("c", 1, None, 1, "z")) == [("insert", "c", None), ("update", "a", 5)]
