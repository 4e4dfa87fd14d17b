"""Joins to what was valid then, and gap ranges, against plain searches."""

import random
from datetime import date, timedelta

import pytest
from helpers import rows, utc
from pyspark.sql import functions as F

from gridlake.operators.asof import as_of_join
from gridlake.plans import gold
from gridlake.sources import windows


def plain(points, history, ended, extend_first):
    out = []
    for i, k, at in points:
        found = None
        own = sorted(((f, t or utc(2999, 1, 1), v) for key, f, t, v in history if key == k and f and (t is None or f < t)), key=lambda x: x[:2])
        if k is not None and at is not None:
            for j, (begin, end, value) in enumerate(own):
                upper = min([end] * ended + [b for b, _, _ in own[j + 1 :]][:1] or [utc(2999, 1, 1)])
                if (begin <= at or (extend_first and j == 0)) and at < upper:
                    found = value
        out.append((i, k, at, found))
    return sorted(out, key=str)


@pytest.mark.parametrize("bucket", ["day", "month", "year"])
@pytest.mark.parametrize("extend_first", [False, True])
def test_as_of_join_against_search(spark, bucket, extend_first):
    rng = random.Random(3)
    when = lambda: utc(2023, 11, 1) + timedelta(hours=rng.randint(0, 24 * 120))
    points = [(i, rng.choice(["a", "b", "c", None]), rng.choice([None] + [when()] * 9)) for i in range(600)]
    points += [(600 + i, "a", t) for i, t in enumerate((utc(2024, 1, 1), utc(2023, 12, 31, 23, 59), utc(2022, 5, 5), utc(2026, 1, 1)))]
    history = [("a", utc(2024, 1, 1), utc(2024, 2, 1), 1), ("a", utc(2024, 2, 10), None, 2), ("a", utc(2024, 2, 20), utc(2024, 2, 20), 9)]
    history += [("b", utc(2023, 11, 20), None, 3), ("b", utc(2023, 12, 24), None, 4), (None, utc(2023, 1, 1), None, 5), ("b", None, None, 6)]
    left = spark.createDataFrame(points, "i int, k string, at timestamp").withColumn("v", F.lit("old"))
    right = spark.createDataFrame(history, "k string, f timestamp, t timestamp, v int")
    got = as_of_join(left, right, ("k",), "at", ("v",), "f", "t", bucket, extend_first)
    in_utc = [(r.i, r.k, r.at and r.at.astimezone(utc(2024, 1, 1).tzinfo), r.v) for r in got.collect()]
    assert sorted(in_utc, key=str) == plain(points, history, True, extend_first)
    # Without a stated end a row holds until the next one.
    got = as_of_join(left, right.filter("v <> 9"), ("k",), "at", ("v",), "f", None, bucket, extend_first)
    in_utc = [(r.i, r.k, r.at and r.at.astimezone(utc(2024, 1, 1).tzinfo), r.v) for r in got.collect()]
    open_ended = [(k, f, None, v) for k, f, _, v in history if v != 9]
    assert sorted(in_utc, key=str) == plain(points, open_ended, False, extend_first)


def test_nothing_to_join(spark):
    left = spark.createDataFrame([], "k string, at timestamp")
    right = spark.createDataFrame([("a", date(2024, 1, 1), 1)], "k string, f date, v int")
    assert as_of_join(left, right, ("k",), "at", ("v",), "f").columns == ["k", "at", "v"]
    assert as_of_join(left, right, ("k",), "at", ("v",), "f").count() == 0
    one = spark.createDataFrame([("a", utc(2024, 1, 5))] * 2, "k string, at timestamp")
    assert [r.v for r in as_of_join(one, right.limit(0), ("k",), "at", ("v",), "f").collect()] == [None, None]
    assert [r.v for r in as_of_join(one, right, ("k",), "at", ("v",), "f").collect()] == [1, 1]


def test_a_hot_series_is_dealt_to_many_tasks(spark):
    """The window is partitioned by key and bucket, not by key alone, and no range join is planned."""
    rows_ = spark.range(1000).select(F.lit("hot").alias("k"), (F.lit(utc(2020, 1, 1)) + F.make_dt_interval(days=F.col("id").cast("int"))).alias("at"))
    history = spark.createDataFrame([("hot", date(2019, 1, 1), 1), ("hot", date(2021, 1, 1), 2)], "k string, f date, v int")
    joined = as_of_join(rows_, history, ("k",), "at", ("v",), "f")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    windowed = [line for line in plan.splitlines() if "Window" in line and "windowspecdefinition" in line]
    assert windowed and all("_bucket" in line for line in windowed)
    assert sorted(r["count"] for r in joined.groupBy("v").count().collect()) == [366, 634]


def test_facts_keep_their_rows_and_old_names(spark):
    power = spark.createDataFrame([(utc(2024, 1, d), t, "de") for d in (1, 10, 25) for t in ("Wind", None)], "timestamp timestamp, production_type string, country string")
    dim = spark.createDataFrame(
        [("w", "Wind", "de", "x", date(2024, 1, 5), date(2024, 1, 20)), ("w", "Wind", "de", "y", date(2024, 1, 20), None)],
        "production_type_id string, production_plant_name string, country string, energy_category string, effective_date date, expiry_date date",
    )
    found = gold.with_plant_as_of(power, dim, ("energy_category",))
    assert [r[1:] for r in rows(found.select(F.dayofmonth("timestamp"), F.dayofmonth("timestamp"), "production_type_id", "energy_category"))] == [
        (1, None, None), (1, "w", "x"), (10, None, None), (10, "w", "x"), (25, None, None), (25, "w", "y"),
    ]


def test_gap_ranges_expand_to_missing_slots(spark):
    rng = random.Random(5)
    start, end = utc(2024, 1, 1), utc(2024, 1, 3)
    held = [(rng.choice("ab"), start + timedelta(minutes=rng.randint(-600, 4000)), 1) for _ in range(150)]
    held += [("late", utc(2025, 1, 1), 1), (None, start, 1), ("none", None, 1)] + held[:20]
    df = spark.createDataFrame(held, "k string, timestamp timestamp, v int")
    ranges = windows.gap_ranges(df, start, end, 30, ("k",))
    assert ranges.columns == ["k", "gap_from", "gap_to", "missing"]
    slots = ranges.select("k", F.explode(F.expr("sequence(gap_from, gap_to - interval 30 minutes, interval 30 minutes)")).alias("slot"))
    expected = windows.missing_slots(df.filter("k is not null"), start, end, 30, ("k",))
    assert rows(slots.filter("k is not null")) == rows(expected)
    by = {r.k: r for r in ranges.filter("k in ('late', 'none')").collect()}
    assert by["late"].missing == by["none"].missing == 96
    assert ranges.filter("k is null").first().missing == 95
    # No two ranges of a series touch.
    assert ranges.join(ranges.select("k", F.col("gap_to").alias("gap_from")), ["k", "gap_from"]).count() == 0
    assert windows.gap_ranges(df.limit(0), start, end, 30, ("k",)).count() == 0
