"""Whole runs over table folders: bronze to silver, silver to gold, and both."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.functions import keys, timeslots
from gridlake.operators import merge, moments, quality
from gridlake.operators.joins import anti_join, semi_join
from gridlake.plans import baseline, gold, reports, silver
from gridlake.session import planned_bytes, sized_shuffles
from gridlake.sources import tables
from gridlake.sources.windows import in_months, in_months_from
from gridlake.workspace import materialise

MONTHLY = ("year", "month")
FLAGGED = ("public_power", "price")  # kinds with an outlier flag

TABLES = (
    "silver_public_power",
    "silver_price",
    "silver_installed_power",
    "gold_dim_production_type",
    "gold_fact_power",
    "gold_fact_power_30min_agg",
    "gold_performance_baseline",
)


def build_silver(
    spark: SparkSession,
    bronze: dict[str, DataFrame],
    root: str,
    as_of: datetime,
    batch_id: str,
    history: dict[str, DataFrame] | None = None,
    whole: bool = False,
    note_changes: bool = False,
) -> dict[str, dict]:
    """Upsert the three silver tables; only the months found in the bronze frames are rewritten.

    For an incremental run pass just the new rows as `bronze` and all of them as `history`: the
    outlier limits then come from the history. Its moments are stored by month next to the silver tables;
    of the history only the months of the new rows are read, all of it at the first time or with `whole`.
    Running it again changes nothing. Returns total, valid and invalid rows that arrived in each table.

    With `note_changes` the rows that the run inserts or updates are noted in `changes_<kind>`, for `gold_from_changes`.
    """
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "GMT", "Z"):
        raise ValueError("business keys hold times as text: set the session time zone to UTC, see session.prepare")
    counts = {}
    build = {
        "public_power": silver.silver_public_power,
        "price": silver.silver_price,
        "installed_power": silver.silver_installed_power,
    }
    for kind, rows in bronze.items():
        if note_changes:
            tables.delete_folder(spark, f"{root}/changes_{kind}")
        if rows.isEmpty():
            continue
        stored = None
        if kind in FLAGGED and kind in (history or {}):
            touched = None if whole else _months_of(rows)
            stored = moments.refresh(spark, f"{root}/moments_{kind}", history[kind], schemas.MEASURE[kind], touched)
        frame = build[schemas.known_kind(kind)](rows, as_of, batch_id, moments=stored)
        # The frame holds one row per key, so nothing is left to deduplicate before it is stored.
        with sized_shuffles(spark, planned_bytes(rows)):
            arrived = merge.upsert_table(
                spark,
                f"{root}/silver_{kind}",
                frame,
                ("business_key",),
                MONTHLY,
                silver.NEWEST,
                unique=True,
                changes=f"{root}/changes_{kind}" if note_changes else None,
                unnoted=("silver_batch_id", "processing_timestamp"),
            )
        counts[f"silver_{kind}"] = quality.validity_counts(arrived).first().asDict()
    return counts


def _months_of(rows: DataFrame) -> list[tuple]:
    """The months that occur, one short row each."""
    return [tuple(r) for r in rows.select(F.year("timestamp"), F.month("timestamp")).distinct().collect()]


def build_gold(
    spark: SparkSession,
    root: str,
    as_of: datetime,
    price_join: str = "hour",
    slot_mode: str = "floor",
    since: date | None = None,
) -> dict[str, dict]:
    """Dimension (with history), 15-minute fact and half-hour fact; returns the counts of each write.

    The fact is silver plus two lookups: with small lookup tables its rows are not shuffled at all.

    `since` limits the facts to the months from that date on: only those folders are read and
    replaced. A month that has lost all its rows keeps its old fact; leave `since` out then.
    """
    with sized_shuffles(spark, tables.folder_bytes(spark, *[f"{root}/{t}" for t in TABLES[:3]])):
        return _build_gold(spark, root, as_of, price_join, slot_mode, since)


def _update_dim(spark: SparkSession, root: str, months, as_of: datetime) -> dict:
    """The dimension with the types of the months that `months` leaves over; returns the counts of the write."""
    power = spark.read.parquet(f"{root}/silver_public_power")
    installed = spark.read.parquet(f"{root}/silver_installed_power")
    dim_path = f"{root}/gold_dim_production_type"
    known = tables.table_exists(spark, dim_path)
    # History keeps what no longer arrives, so an update only needs the types of the new months.
    incoming = gold.dim_production_type([months(power) if known else power, installed], as_of)
    if known:
        stored = spark.read.schema(schemas.DIM_PRODUCTION_TYPE).parquet(dim_path)
        incoming = materialise(merge.scd2_merge(stored, incoming, as_of), "dim")
    return tables.checked_write(incoming, dim_path)


def gold_from_changes(spark: SparkSession, root: str, as_of: datetime) -> dict[str, int]:
    """Bring dimension and facts up to date from what the last `build_silver(note_changes=True)` changed.

    Only production rows that changed, or whose hourly price did, are joined and written anew, and only the half hours
    they lie in are computed again; of all tables the months of the changes are read. Returns the number of fact rows
    and half hours that were replaced. The baseline follows by `SlidingBaseline.advance`.
    """
    changed = {}
    for kind in ("public_power", "price"):
        path = f"{root}/changes_{kind}"
        if tables.table_exists(spark, path):
            changed[kind] = spark.read.parquet(path)
    touched = sorted({m for rows in changed.values() for m in _months_of(rows)}, key=str)
    if not touched:
        return {"gold_fact_power": 0, "gold_fact_power_30min_agg": 0}

    def months(df: DataFrame) -> DataFrame:
        return df.filter(in_months(df, "timestamp", touched))

    _update_dim(spark, root, months, as_of)
    dim = spark.read.schema(schemas.DIM_PRODUCTION_TYPE).parquet(f"{root}/gold_dim_production_type")
    power, price = (months(spark.read.parquet(f"{root}/silver_{kind}")) for kind in ("public_power", "price"))
    series = ("timestamp", "raw_type", "country")
    wanted = [rows.select(*series) for kind, rows in changed.items() if kind == "public_power"]
    if "price" in changed:
        hours = changed["price"].select(timeslots.hour_start(F.col("timestamp")).alias("_hour"), "country").distinct()
        met = power.withColumn("_hour", timeslots.hour_start(F.col("timestamp"))).join(hours, ["_hour", "country"], "left_semi")
        wanted.append(met.select(*series))
    wanted = materialise(reduce(DataFrame.unionByName, wanted).distinct().withColumn("record_id", keys.hashed_key(*map(F.col, series))), "wanted")

    # Rows of the changed keys: what the fact holds now, and what it will hold.
    fact_path, agg_path = f"{root}/gold_fact_power", f"{root}/gold_fact_power_30min_agg"
    stored = months(spark.read.schema(schemas.FACT_POWER).parquet(fact_path))
    ids = wanted.select("record_id")
    new = materialise(gold.fact_power(semi_join(power, wanted.select(*series), series), price, dim, as_of), "fact")
    slot = timeslots.half_hour_slot(F.col("timestamp")).alias("timestamp_30min")
    by = ("production_type_id", "country", "timestamp_30min")
    gone = semi_join(stored, ids, ("record_id",)).select("production_type_id", "country", slot)
    slots = materialise(gone.unionByName(new.select("production_type_id", "country", slot)).distinct(), "slots")
    fact = materialise(anti_join(stored, ids, ("record_id",)).unionByName(new), "fact")
    tables.overwrite_partitions(fact, fact_path, MONTHLY, rebalance=False)

    own = semi_join(fact.withColumn("timestamp_30min", slot), slots, by)
    agg = materialise(gold.fact_power_30min(own, as_of), "half_hours")
    held = months(spark.read.schema(schemas.FACT_POWER_30MIN).parquet(agg_path))
    merged = materialise(anti_join(held, slots, by).unionByName(agg), "half_hours")
    tables.overwrite_partitions(merged, agg_path, MONTHLY)
    return {"gold_fact_power": new.count(), "gold_fact_power_30min_agg": agg.count()}


def _build_gold(spark, root, as_of, price_join, slot_mode, since) -> dict[str, dict]:
    only = None if since is None else in_months_from(since)

    def months(df: DataFrame) -> DataFrame:
        return df if only is None else df.filter(only)

    power = spark.read.parquet(f"{root}/silver_public_power")
    price = spark.read.parquet(f"{root}/silver_price")

    counts = {"gold_dim_production_type": _update_dim(spark, root, months, as_of)}
    dim = spark.read.schema(schemas.DIM_PRODUCTION_TYPE).parquet(f"{root}/gold_dim_production_type")

    fact_path = f"{root}/gold_fact_power"
    fact = gold.fact_power(months(power), months(price), dim, as_of, price_join, slot_mode)
    without_price = F.count_if(F.col("electricity_price").isNull())
    counts["gold_fact_power"] = tables.checked_write(
        fact, fact_path, MONTHLY, only, rebalance=False, without_price=without_price
    )
    agg = gold.fact_power_30min(months(spark.read.parquet(fact_path)), as_of)
    agg_path = f"{root}/gold_fact_power_30min_agg"
    counts["gold_fact_power_30min_agg"] = tables.checked_write(agg, agg_path, MONTHLY, only)
    typical = baseline.performance_baseline(spark.read.parquet(agg_path), dim, as_of)
    counts["gold_performance_baseline"] = tables.checked_write(typical, f"{root}/gold_performance_baseline")
    return counts


def publish_views(spark: SparkSession, root: str, prefix: str = "") -> list[str]:
    """Temporary views over all tables of `root`, for SQL users; returns their names."""
    names = []
    for table in TABLES:
        if tables.table_exists(spark, f"{root}/{table}"):
            spark.read.parquet(f"{root}/{table}").createOrReplaceTempView(f"{prefix}{table}")
            names.append(f"{prefix}{table}")
    return names


def report_frames(spark: SparkSession, root: str, country: str = "de", as_of: datetime | None = None) -> dict[str, DataFrame]:
    """The standard reports over the tables of `root`; with `as_of` also those that look back from a time."""
    fact = spark.read.parquet(f"{root}/gold_fact_power")
    agg = spark.read.parquet(f"{root}/gold_fact_power_30min_agg")
    dim = spark.read.schema(schemas.DIM_PRODUCTION_TYPE).parquet(f"{root}/gold_dim_production_type")
    frames = {
        "daily_production_trend": reports.daily_trend(fact, dim, country),
        "underperformance_prediction": reports.underperformance_features(agg, dim, country),
        "wind_price_analysis": reports.wind_price(fact, dim, country),
        "capacity_utilisation": reports.capacity_utilisation(agg, dim, spark.read.parquet(f"{root}/silver_installed_power")),
    }
    if as_of is not None:
        typical = spark.read.parquet(f"{root}/gold_performance_baseline")
        frames["daily_growth"] = reports.daily_growth(fact, dim, as_of, by_country=True)
        frames["underperformance"] = baseline.underperformance(agg, typical, dim, as_of)
    return frames


def run(
    spark: SparkSession,
    bronze: dict[str, DataFrame],
    root: str,
    as_of: datetime,
    batch_id: str,
    since: date | None = None,
) -> dict[str, dict]:
    """Bronze to silver to gold in one go; returns the counts of each write.

    `since` makes it incremental: of `bronze` only the months from that date on are processed, and gold reads and
    replaces those months only. Outlier limits come from all of it, by the moments that earlier runs stored for
    each month. Where bronze lies in folders of year and month the older ones aren't read.
    """
    new = bronze if since is None else {kind: _from_day(rows, since.replace(day=1)) for kind, rows in bronze.items()}
    counts = build_silver(spark, new, root, as_of, batch_id, bronze, whole=since is None)
    return counts | build_gold(spark, root, as_of, since=since)


def _from_day(rows: DataFrame, start: date) -> DataFrame:
    later = rows.filter(F.col("timestamp") >= F.lit(start).cast("timestamp"))
    return later.filter(in_months_from(start)) if {"year", "month"} <= set(rows.columns) else later
