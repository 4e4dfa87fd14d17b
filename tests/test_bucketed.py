"""Bucketed tables: upserts, what is shuffled, read and written."""

import random
import uuid

import pytest
from helpers import rows, utc
from pyspark.sql import functions as F

from gridlake.operators import bucketed
from gridlake.sources import tables

SCHEMA = "k long, day int, at timestamp, value double"
KEYS, BY, NEWEST = ("k", "day"), ("day",), ("at",)


@pytest.fixture()
def name(folder):
    return f"bucketed_{uuid.uuid4().hex}", folder("bucketed")


def made(spark, name, data, buckets=4):
    bucketed.create(spark.createDataFrame(data, SCHEMA), name[0], KEYS, BY, NEWEST, buckets, name[1])


def put(spark, name, data, schema=SCHEMA):
    return bucketed.upsert(spark, name[0], spark.createDataFrame(data, schema), KEYS, BY, NEWEST)


def test_newest_rows_win_also_with_null_keys(spark, name):
    made(spark, name, [(1, 1, utc(2024, 1, 1), 1.0), (1, 1, utc(2024, 1, 2), 2.0), (None, 1, utc(2024, 1, 1), 3.0), (2, 2, None, 4.0)])
    batch = [(1, 1, utc(2024, 1, 1), 9.0), (None, 1, utc(2024, 1, 1), 8.0), (2, 2, utc(2023, 1, 1), 7.0), (3, 3, utc(2024, 1, 1), 6.0)]
    want = [(1, 1, utc(2024, 1, 2).replace(tzinfo=None), 2.0), (2, 2, None, 7.0), (3, 3, None, 6.0), (None, 1, None, 8.0)]
    for _ in range(2):
        put(spark, name, batch)
        assert rows(bucketed.read(spark, name[0]), "k", "day", "value") == sorted(
            [(k, d, v) for k, d, _, v in want], key=lambda t: tuple((v is not None, str(v)) for v in t)
        )
    assert put(spark, name, []).count() == 0
    assert bucketed.read(spark, name[0]).count() == 4


def test_columns_are_added_and_kept(spark, name):
    made(spark, name, [(1, 1, utc(2024, 1, 1), 1.0), (2, 1, utc(2024, 1, 1), 2.0), (3, 2, utc(2024, 1, 1), 3.0)])
    put(spark, name, [(1, 1, utc(2024, 1, 2), "x")], "k long, day int, at timestamp, note string")
    assert rows(bucketed.read(spark, name[0]), "k", "value", "note") == [(1, 1.0, "x"), (2, 2.0, None), (3, 3.0, None)]


def test_against_a_plain_dictionary(spark, name):
    rng = random.Random(3)
    state = {}

    def batch(n):
        found = [(rng.choice([None, *range(40)]), rng.randint(1, 5), utc(2024, 1, rng.randint(1, 28)), rng.random()) for _ in range(n)]
        return list({(k, d, t): (k, d, t, v) for k, d, t, v in found}.values())

    def apply(data):
        newest = {}
        for k, d, t, v in data:
            newest[k, d] = max(newest.get((k, d), (t, v)), (t, v), key=lambda x: x[0])
        for key, (t, v) in newest.items():
            if key not in state or t >= state[key][0]:
                state[key] = t, v

    for i in range(3):
        data = batch(60)
        made(spark, name, data) if i == 0 else put(spark, name, data)
        apply(data)
        found = {(r.k, r.day): r.value for r in bucketed.read(spark, name[0]).collect()}
        assert found == {key: v for key, (_, v) in state.items()}


@pytest.mark.parametrize("buckets", [3, 32])
def test_stored_rows_are_not_shuffled(spark, name, buckets):
    """Also where the session plans more, or fewer, shuffle partitions than there are buckets."""
    rows_ = spark.range(0, 5000).select(F.col("id").alias("k"), (F.col("id") % 2).cast("int").alias("day"), F.lit(utc(2024, 1, 1)).alias("at"), F.lit(1.0).alias("value"))
    bucketed.create(rows_, name[0], KEYS, BY, NEWEST, buckets, name[1])
    stored = spark.table(name[0]).filter("day = 1")
    arriving = bucketed._keyed(rows_.filter("day = 1"), KEYS)
    merged = bucketed.merged(stored, arriving, NEWEST)
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "Bucketed: true" in final and "PartitionFilters: [isnotnull(day" in final
    # One shuffle, of the arriving rows: it stands after the scan of the stored ones.
    assert final.count("- Exchange ") == 1 and f", {buckets})" in final.split("- Exchange ")[1]
    assert "FileScan" not in final.split("- Exchange ")[1]


def test_one_file_a_bucket_and_other_partitions_stay(spark, name):
    data = [(k, k % 2, utc(2024, 1, 1), 1.0) for k in range(400)]
    made(spark, name, data)

    def files(day):
        frame = spark.read.parquet(f"{name[1]}/day={day}").select(F.input_file_name().alias("f")).distinct()
        return {r.f for r in frame.collect()}

    untouched = files(0)
    put(spark, name, [(k, 1, utc(2024, 1, 2), 2.0) for k in range(1, 400, 2)])
    assert files(0) == untouched and len(files(1)) == 4 and len(untouched) == 4
    assert tables.table_exists(spark, name[1])
    assert bucketed.read(spark, name[0]).agg(F.sum("value")).first()[0] == 600.0


def test_bucket_count():
    assert [bucketed.bucket_count(b, 100) for b in (0, 1, 100, 101)] == [1, 1, 1, 2]
