import pytest
from helpers import rows, utc
from pyspark.sql import functions as F

from gridlake.operators import series
from gridlake.plans import baseline, gold, lakehouse, silver
from gridlake.sources import staging
from gridlake.workspace import materialise

NOW = utc(2024, 1, 31)


@pytest.fixture(scope="module")
def bronze(spark, sf_dir):
    return {
        "public_power": staging.bronze_public_power(spark, sf_dir),
        "price": staging.bronze_price(spark, sf_dir),
        "installed_power": staging.bronze_installed_power(spark, sf_dir),
    }


@pytest.fixture(scope="module")
def lake(spark, bronze):
    from gridlake.workspace import scratch_path

    root = scratch_path(spark, "run")
    return root, lakehouse.run(spark, bronze, root, NOW, "b1")


def test_run_twice_gives_the_same_tables(spark, bronze, lake):
    root, counts = lake
    def content():
        return {
            t: rows(spark.read.parquet(f"{root}/{t}").drop("created_at", "updated_at", "silver_batch_id"))
            for t in ("silver_public_power", "silver_price", "silver_installed_power", "gold_dim_production_type", "gold_fact_power")
        }

    before = content()
    assert lakehouse.run(spark, bronze, root, NOW, "b2") == counts
    assert content() == before


def test_incremental_run_equals_a_full_one(spark, bronze):
    """Two deliveries, the second with only its months rebuilt, against one delivery of everything."""
    from gridlake.workspace import scratch_path

    parts, whole = scratch_path(spark, "parts"), scratch_path(spark, "whole")
    cut = F.lit(utc(2024, 1, 15))
    moved = {k: v for k, v in bronze.items() if k != "public_power"}
    later = bronze["public_power"].withColumn("timestamp", F.col("timestamp") + F.expr("interval 20 days"))
    early, late = later.filter(F.col("ingestion_date") < cut), later.filter(F.col("ingestion_date") >= cut)
    lakehouse.run(spark, {**moved, "public_power": early}, parts, NOW, "b1")
    lakehouse.build_silver(spark, {"public_power": late, "price": bronze["price"].limit(0)}, parts, NOW, "b2")
    counts = lakehouse.build_gold(spark, parts, NOW, since=utc(2024, 2, 4).date())
    lakehouse.run(spark, {**moved, "public_power": later}, whole, NOW, "b1")
    for table in ("gold_fact_power", "gold_fact_power_30min_agg"):
        assert rows(spark.read.parquet(f"{parts}/{table}")) == rows(spark.read.parquet(f"{whole}/{table}"))
    everything = spark.read.parquet(f"{whole}/gold_fact_power")
    assert counts["gold_fact_power"]["rows"] == everything.filter("month = 2").count() < everything.count()


def test_first_load_shuffles_once_by_key(spark, bronze):
    """One exchange deduplicates; storing the frame adds none by key."""
    from gridlake.plans import silver

    frame = silver.silver_public_power(bronze["public_power"], NOW)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_since_reads_only_new_folders(spark, bronze, folder):
    """Where bronze lies in folders by month, an incremental run prunes the older ones."""
    path = folder("bronze")
    dated = bronze["public_power"].withColumns({"year": F.year("timestamp"), "month": F.month("timestamp")})
    dated.write.partitionBy("year", "month").parquet(path)
    new = lakehouse._from_day(spark.read.parquet(path), utc(2024, 1, 1).date())
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and new.count() == dated.count()
    assert lakehouse._from_day(spark.read.parquet(path), utc(2024, 2, 1).date()).count() == 0


def test_shuffle_setting_comes_back(spark, bronze):
    from gridlake.session import planned_bytes, sized_shuffles

    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sized_shuffles(spark, 1 << 40) as count:
        assert count == 16_385 and spark.conf.get("spark.sql.shuffle.partitions") == "16385"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert 0 < planned_bytes(bronze["public_power"]) < 1 << 40


def test_six_reports(spark, lake):
    frames = lakehouse.report_frames(spark, lake[0], as_of=NOW)
    assert len(frames) == 6 and not frames["daily_growth"].isEmpty()
    days = [(r.year, r.month, r.day, r.production_type) for r in frames["daily_production_trend"].collect()]
    assert days == sorted(days)
    growth = [(r.production_date, r.daily_production) for r in frames["daily_growth"].collect()]
    assert growth == sorted(growth, key=lambda x: (-x[0].toordinal(), -(x[1] if x[1] is not None else float("-inf"))))


def test_counts_of_silver_writes(lake):
    counts = lake[1]["silver_public_power"]
    assert counts["total_records"] == counts["valid_records"] + counts["invalid_records"] > 0


def test_views(spark, lake):
    names = lakehouse.publish_views(spark, lake[0], "t_")
    assert len(names) == 7 and not spark.sql("SELECT * FROM t_gold_fact_power WHERE month = 1").isEmpty()


def test_no_fan_out(spark, lake):
    root, counts = lake
    power = spark.read.parquet(f"{root}/silver_public_power")
    fact = spark.read.parquet(f"{root}/gold_fact_power")
    assert counts["gold_fact_power"]["rows"] == power.count() == fact.select("record_id").distinct().count()
    assert fact.filter("production_type_id is null").isEmpty()
    agg = spark.read.parquet(f"{root}/gold_fact_power_30min_agg")
    total = fact.agg(F.sum("electricity_produced")).first()[0]
    assert agg.agg(F.sum("total_electricity_produced")).first()[0] == pytest.approx(total)
    assert agg.select("record_id").distinct().count() == agg.count()


def test_reports(spark, lake):
    frames = lakehouse.report_frames(spark, lake[0])
    assert all(not f.isEmpty() for f in frames.values())
    wind = frames["wind_price_analysis"].select("production_type").distinct()
    assert rows(wind) == [("Wind offshore",), ("Wind onshore",)]


def test_history_does_not_multiply_reports(spark, lake):
    from gridlake.plans import reports

    root, _ = lake
    fact = spark.read.parquet(f"{root}/gold_fact_power")
    dim = spark.read.parquet(f"{root}/gold_dim_production_type")
    old = dim.withColumns({"active_flag": F.lit(False), "expiry_date": F.lit(NOW.date())})
    both = materialise(dim.unionByName(old), "dim")
    assert rows(reports.daily_trend(fact, both)) == rows(reports.daily_trend(fact, dim))


def test_partition_and_column_pruning(spark, lake):
    plan = (
        spark.read.parquet(f"{lake[0]}/gold_fact_power")
        .filter("year = 2024 and month = 1 and country = 'de'")
        .select("electricity_produced")
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "EqualTo(country,de)" in plan
    assert "ReadSchema: struct<electricity_produced:double,country:string>" in plan


def test_recent_skips_old_folders(spark, lake):
    from gridlake.sources.windows import recent

    stored = spark.read.parquet(f"{lake[0]}/gold_fact_power")
    plan = recent(stored, NOW, "timestamp", by_month=True, days=3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "make_date(year" in plan
    assert recent(stored, NOW, "timestamp", by_month=True, days=3).count() == recent(stored, NOW, "timestamp", days=3).count()


def test_fact_is_built_without_shuffling_rows(spark, lake):
    root = lake[0]
    power, price = spark.read.parquet(f"{root}/silver_public_power"), spark.read.parquet(f"{root}/silver_price")
    dim = spark.read.parquet(f"{root}/gold_dim_production_type")
    plan = gold.fact_power(power, price, dim, NOW)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = gold.fact_power(power, price, dim, NOW)
        assert "BroadcastHashJoin" not in shuffled._jdf.queryExecution().executedPlan().toString()
        assert rows(shuffled) == rows(spark.read.parquet(f"{root}/gold_fact_power").select(*shuffled.columns))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64m")


def test_shuffle_size(spark):
    from gridlake.session import size_shuffles

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 1000) == int(before)
        assert size_shuffles(spark, 100 << 40) == 1_638_401 and size_shuffles(spark, 1 << 40) == 1_638_401
        spark.conf.set("spark.sql.shuffle.partitions", before)
        assert size_shuffles(spark, 1 << 40) == 16_385
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _power(spark, *minutes):
    data = [(f"2024-03-01 10:{m:02d}:00", 1.0) for m in minutes]
    return spark.createDataFrame(data, "t string, electricity_generated double").select(
        F.col("t").cast("timestamp").alias("timestamp"), "electricity_generated", F.lit("de").alias("country")
    )


def test_price_by_hour_or_exact(spark):
    power = _power(spark, 0, 15, 30, 45)
    price = _power(spark, 0).select("timestamp", "country", F.lit(50).cast("decimal(10,4)").alias("electricity_price"))
    assert gold.with_price(power, price, "exact").filter("electricity_price = 50").count() == 1
    assert gold.with_price(power, price, "hour").filter("electricity_price = 50").count() == 4
    finer = _power(spark, 0, 30).select("timestamp", "country", F.minute("timestamp").cast("decimal(10,4)").alias("electricity_price"))
    joined = gold.with_price(power, finer, "hour")
    assert joined.count() == 4 and joined.filter("electricity_price = 15").count() == 4


def test_single_row_has_no_volatility(spark):
    fact = _power(spark, 5).select(
        "timestamp", "country", F.lit("id").alias("production_type_id"),
        F.col("electricity_generated").alias("electricity_produced"), F.lit(1.0).alias("electricity_price"),
    )
    row = gold.fact_power_30min(fact, NOW).first()
    assert row.production_volatility is None and row.data_points_count == 1


def test_dedup_on_raw_keeps_distinct_series(spark):
    data = [(f"{i}", t, 1.0) for i, t in enumerate(["Fossil gas", "Fossil hard coal", "Fossil oil"])]
    bronze = spark.createDataFrame(data, "record_id string, production_type string, electricity_generated double").select(
        "*", F.lit(NOW).alias("timestamp"), F.lit(NOW).alias("ingestion_date"), F.lit("DE ").alias("country"), F.lit("s").alias("source_system")
    )
    assert silver.silver_public_power(bronze, NOW, taxonomy_name="coarse").count() == 3
    assert silver.silver_public_power(bronze, NOW, taxonomy_name="coarse", dedup_on="standardized").count() == 1


def test_lags_across_a_gap(spark):
    data = [(s * 1800, float(s)) for s in range(60) if s != 10]
    df = spark.createDataFrame(data, "s long, v double").select(
        F.timestamp_seconds("s").alias("timestamp_30min"), "v", F.lit("a").alias("k")
    )
    got = df.select("v", series.lag_slots("v", ("k",), 48).alias("n"), series.lag_time("v", ("k",), 86400).alias("t")).collect()
    found = {r.v: (r.n, r.t) for r in got}
    assert found[58.0] == (9.0, None)
    assert found[59.0] == (11.0, 11.0)


def test_rolling_skips_missing(spark):
    df = spark.createDataFrame([(0, 1.0), (1, None), (2, 3.0)], "s long, v double").select(
        F.timestamp_seconds(F.col("s") * 1800).alias("timestamp_30min"), "v", F.lit("a").alias("k")
    )
    got = df.select("timestamp_30min", series.rolling_rows("v", ("k",), 2).alias("m")).orderBy("timestamp_30min").collect()
    assert [r.m for r in got] == [1.0, 1.0, 3.0]


def test_underperformance(spark):
    """Ten equal Mondays and one collapse: only the collapse is reported."""
    values = [100.0, 102.0, 98.0, 101.0, 99.0, 100.0, 102.0, 98.0, 101.0, 99.0, 10.0]
    data = [(i * 7 * 86400 + 1704706200, v) for i, v in enumerate(values)]
    agg = spark.createDataFrame(data, "s long, avg_electricity_produced double").select(
        F.timestamp_seconds("s").alias("timestamp_30min"), "avg_electricity_produced",
        F.lit("id").alias("production_type_id"), F.lit("de").alias("country"),
        F.hour(F.timestamp_seconds("s")).alias("hour"), F.lit(30).alias("minute_interval_30"),
    )
    dim = spark.createDataFrame(
        [("id", "Wind", "Renewable", "Mixed", True)],
        "production_type_id string, production_plant_name string, energy_category string, controllability_type string, active_flag boolean",
    )
    now = utc(2024, 3, 18, 12)
    base = baseline.performance_baseline(agg, dim, now, min_observations=2)
    assert base.select("season").distinct().count() == 2
    low = baseline.underperformance(agg, base, dim, now, hours=24 * 90)
    # The collapse came after the baseline's midnight, so it doesn't hide itself in it.
    assert rows(low, "performance_status", "actual_production") == [("Severe", 10.0)]
    fixed = base.withColumns(
        {"underperformance_threshold_severe": F.lit(50.0), "underperformance_threshold_moderate": F.lit(98.5), "baseline_avg_production": F.lit(100.0)}
    )
    got = rows(baseline.underperformance(agg, fixed, dim, now, hours=24 * 90), "performance_status", "actual_production")
    assert ("Severe", 10.0) in got and ("Moderate", 98.0) in got and len(got) == 3
    recent = baseline.underperformance(agg, fixed, dim, utc(2024, 3, 18, 12), hours=4)
    assert rows(recent, "performance_status") == [("Severe",)]
    assert recent.first().deviation_pct == pytest.approx(-90.0)
