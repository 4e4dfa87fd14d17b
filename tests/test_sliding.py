"""A baseline window that moves, against one computed anew."""

import random
from datetime import timedelta

import pytest
from helpers import utc
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.operators.quantiles import log_cell
from gridlake.plans import baseline
from gridlake.plans.sliding import SlidingBaseline, _moves
from gridlake.sources import tables
from gridlake.workspace import materialise

KEYS = list(baseline.SLOT_KEYS)
NUMBERS = [f"baseline_{m}_production" for m in ("avg", "median", "p25", "p75", "std")] + ["underperformance_threshold_severe"]


def half_hours(spark, seed, first, days):
    """Few slots with many values: near ones that share a cell, equal ones, negative ones, missing ones."""
    rng, out = random.Random(seed), []
    for day in range(days):
        for type_id in ("a", "b"):
            for minutes in (0, 30, 720):
                at = first + timedelta(days=day, minutes=minutes)
                value = rng.choice([None, 5.0, 5.0, 1000 + rng.random() / 1000, -3.25, rng.random() * 1e6, float("nan"), 0.0])
                out.append((type_id, at, value, at.hour, minutes % 60))
    return spark.createDataFrame(out, "production_type_id string, timestamp_30min timestamp, avg_electricity_produced double, hour int, minute_interval_30 int")


@pytest.fixture(scope="module")
def dim(spark):
    return materialise(schemas.empty_table(spark, schemas.DIM_PRODUCTION_TYPE), "dim")


def compare(sliding, agg, dim, as_of):
    expected = baseline.performance_baseline(agg.withColumn("avg_electricity_produced", F.nanvl("avg_electricity_produced", F.lit(None).cast("double"))), dim, as_of, days=sliding.days, min_observations=1)
    want = {tuple(r[k] for k in KEYS): r for r in expected.collect()}
    got = {tuple(r[k] for k in KEYS): r for r in sliding.baseline(dim, as_of, min_observations=1).collect()}
    assert got.keys() == want.keys() and len(got) > 5
    for key, row in want.items():
        assert got[key].historical_observations == row.historical_observations
        for name in NUMBERS:
            assert got[key][name] == (None if row[name] is None else pytest.approx(row[name], rel=1e-7, abs=1e-6)), (key, name)


def test_moving_windows_equal_new_ones(spark, folder, dim):
    """Forward by one day and by more, beyond the old window, and back; the window that was left behind is gone."""
    agg = materialise(half_hours(spark, 1, utc(2024, 1, 1), 150), "agg")
    sliding = SlidingBaseline(spark, folder("sliding"), days=40)
    for as_of in (utc(2024, 3, 1), utc(2024, 3, 2, 17), utc(2024, 3, 20), utc(2024, 5, 25), utc(2024, 2, 20)):
        sliding.advance(agg, as_of, None if as_of == utc(2024, 3, 1) else utc(2024, 5, 1))
        compare(sliding, agg, dim, as_of)
    assert len(tables.folder_names(spark, sliding.state_path)) == 1


def test_late_and_changed_days(spark, folder, dim):
    """Days inside the window that change, vanish or arrive late are put right, in the changed months only."""
    agg = materialise(half_hours(spark, 2, utc(2024, 1, 1), 75), "agg")
    sliding = SlidingBaseline(spark, folder("sliding"), days=50)
    sliding.advance(agg, utc(2024, 3, 1))
    other = half_hours(spark, 3, utc(2024, 2, 5), 30)
    changed = materialise(agg.filter(F.col("timestamp_30min") < F.lit(utc(2024, 2, 5))).unionByName(other), "agg")
    sliding.advance(changed, utc(2024, 3, 3), since=utc(2024, 2, 5))
    compare(sliding, changed, dim, utc(2024, 3, 3))
    # The same again, with nothing new, changes nothing.
    before = sorted(map(tuple, sliding._state().collect()), key=str)
    sliding.advance(changed, utc(2024, 3, 3), since=utc(2024, 2, 5))
    assert sorted(map(tuple, sliding._state().collect()), key=str) == before


def test_a_run_that_was_cut_off(spark, folder, dim):
    agg = materialise(half_hours(spark, 4, utc(2024, 1, 1), 60), "agg")
    sliding = SlidingBaseline(spark, folder("sliding"), days=30)
    sliding.advance(agg, utc(2024, 2, 10))
    sliding._mark(True)
    tables.overwrite_table(sliding._cells().limit(3).checkpoint(), sliding.cells_path, ("year", "month"))
    sliding.advance(agg, utc(2024, 2, 12), since=utc(2024, 2, 1))
    compare(sliding, agg, dim, utc(2024, 2, 12))
    assert not tables.table_exists(spark, sliding.mark_path)


def test_only_days_that_move_are_read(spark, folder):
    """Of a window of 90 days, a step of one day reads the cells of the first, the last and the changed month."""
    agg = materialise(half_hours(spark, 5, utc(2024, 1, 1), 120), "agg")
    sliding = SlidingBaseline(spark, folder("sliding"))
    sliding.advance(agg, utc(2024, 4, 10))
    delete = spark._jvm.org.apache.hadoop.fs.Path
    for month in (2, 3):
        path = delete(f"{sliding.cells_path}/year=2024/month={month}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    before = sliding._state().agg(F.sum("n")).first()[0]
    sliding.advance(agg, utc(2024, 4, 11), since=utc(2024, 4, 1))
    assert sliding._state().agg(F.sum("n")).first()[0] == before == 6 * 90 + 2


def test_ranges_of_units():
    rng = random.Random(6)
    for _ in range(200):
        old, new = sorted(rng.sample(range(30), 2)), sorted(rng.sample(range(30), 2))
        held = dict.fromkeys(range(old[0], old[1] + 1), 1)
        for first, last, sign in _moves(*old, *new):
            for unit in range(first, last + 1):
                held[unit] = held.get(unit, 0) + sign
        assert {u for u, n in held.items() if n} == set(range(new[0], new[1] + 1)) and set(held.values()) <= {0, 1}


def test_huge_values_count_as_missing(spark, folder, dim):
    agg = half_hours(spark, 7, utc(2024, 1, 1), 20)
    huge = agg.withColumn("avg_electricity_produced", F.when(F.col("avg_electricity_produced") == 5, 1e300).otherwise(F.col("avg_electricity_produced")))
    sliding = SlidingBaseline(spark, folder("sliding"), days=15)
    sliding.advance(huge, utc(2024, 1, 18))
    compare(sliding, huge.withColumn("avg_electricity_produced", F.when(F.col("avg_electricity_produced") < 1e10, F.col("avg_electricity_produced"))), dim, utc(2024, 1, 18))


def test_missing_values_have_no_cell(spark):
    assert spark.createDataFrame([(0.0,)], "x double").select(log_cell(F.col("x"))).first()[0] == 0
