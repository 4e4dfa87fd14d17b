"""Upserts, inserts, snapshot differences and dimension history on plain tables."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.operators.dedup import keep_latest
from gridlake.operators.joins import anti_join, same_keys
from gridlake.sources import tables
from gridlake.workspace import materialise


def upsert(target: DataFrame, source: DataFrame, keys: tuple[str, ...], *newest_first: str) -> DataFrame:
    """Rows of `source` replace those of `target` with the same keys; the rest stays.

    The newest source row of a key wins. Applying the same source twice changes nothing.
    """
    newest = keep_latest(source, keys, *newest_first)
    return anti_join(target, newest, keys).unionByName(newest)


def insert_absent(target: DataFrame, source: DataFrame, keys: tuple[str, ...], *newest_first: str) -> DataFrame:
    """`target` plus the newest source row of each key it does not hold yet."""
    return target.unionByName(anti_join(keep_latest(source, keys, *newest_first), target, keys))


def _one_of(folders: list, columns: tuple[str, ...]) -> Column:
    """Whether the partition columns equal one of the given rows.

    Folders that share all values but the last become one list, so a backfill over thousands of folders
    makes a flat condition and not one as deep as their number.
    """
    lists: dict[tuple, list] = {}
    for row in folders:
        lists.setdefault(tuple(row[c] for c in columns[:-1]), []).append(row[columns[-1]])
    last, matches = F.col(columns[-1]), []
    for head, values in lists.items():
        present = [v for v in values if v is not None]
        fits = last.isin(*present) if present else F.lit(False)
        if len(present) < len(values):
            fits = fits | last.isNull()
        matches.append(reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(columns, head)], fits))
    return F.exists(F.array(*matches), lambda m: m) if len(matches) > 100 else reduce(Column.__or__, matches, F.lit(False))


def upsert_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: tuple[str, ...],
    partition_by: tuple[str, ...],
    newest_first: tuple[str, ...],
    incremental: bool = True,
    unique: bool = False,
    changes: str | None = None,
    unnoted: tuple[str, ...] = (),
) -> DataFrame:
    """Upsert into a partitioned table, rewriting only the partitions the source touches; returns the rows that arrived.

    The partition columns must follow from the keys (year and month of a key timestamp). With
    `incremental` a stored row newer than the source row survives, so late batches do no harm. Of rows
    that are equally new the arriving one wins: bronze that is processed again replaces what it gave before.

    No column is lost. One that the source lacks keeps its stored value, also in rows that are updated; one
    that the table lacks becomes NULL in stored rows. `unique` says that the source holds one row per key already.

    `changes` names a folder that gets what the upsert changed, as `table_diff` of the touched partitions; a row that
    differs in the `unnoted` columns only (load times, batch names) has not changed.
    """
    newest = source if unique else keep_latest(source, keys, *newest_first)
    if not tables.table_exists(spark, path):
        tables.overwrite_table(newest, path, partition_by)
        newest = spark.read.schema(newest.schema).parquet(path)
        if changes:
            tables.overwrite_table(newest.drop(*unnoted).select(F.lit("insert").alias("change_type"), "*"), changes)
        return newest
    newest = arrived = materialise(newest, "upsert")
    # One short row per touched folder, far fewer than the driver lists anyway. As literals they
    # prune the scan to just those folders.
    touched = newest.select(*partition_by).distinct().collect()
    stored = tables.stored_rows(spark, path, newest.schema).filter(_one_of(touched, partition_by))
    lacking = [c for c in stored.columns if c not in newest.columns]
    if lacking:
        # Looked up by key; one row a key on both sides.
        known = stored.select(*keys, *lacking)
        newest = newest.join(known, same_keys(newest, known, keys), "left").select(*[newest[c] for c in newest.columns], *[known[c] for c in lacking])
    if incremental:
        arriving = tables.unite(stored.withColumn("_arriving", F.lit(False)), newest.withColumn("_arriving", F.lit(True)))
        merged = keep_latest(arriving, keys, *newest_first, "_arriving").drop("_arriving")
    else:
        merged = tables.unite(anti_join(stored, newest, keys), newest)
    if changes:
        merged = materialise(merged, "merged")
        columns = [c for c in merged.columns if c not in unnoted]
        before = tables.unite(stored, merged.limit(0)).select(*columns)
        tables.overwrite_table(table_diff(before, merged.select(*columns), keys), changes)
    tables.overwrite_partitions(merged, path, partition_by)
    return arrived


def table_diff(old: DataFrame, new: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows that differ between two snapshots, as `change_type` insert, update or delete.

    An update carries the new values, a delete the last known ones.
    """
    columns = old.columns
    left = old.select(F.struct(*columns).alias("before"), *[F.col(k).alias(k) for k in keys])
    right = new.select(F.struct(*columns).alias("after"), *[F.col(k).alias(k) for k in keys])
    joined = left.join(right, same_keys(left, right, keys), "full_outer").select("before", "after")
    change = (
        F.when(F.col("before").isNull(), "insert")
        .when(F.col("after").isNull(), "delete")
        .when(~F.col("before").eqNullSafe(F.col("after")), "update")
    )
    return (
        joined.withColumn("change_type", change)
        .filter(F.col("change_type").isNotNull())
        .select("change_type", F.coalesce("after", "before").alias("_row"))
        .select("change_type", "_row.*")
    )


# Columns that keep the history of a dimension row.
VALIDITY = ("effective_date", "expiry_date", "active_flag", "created_at", "updated_at")


def scd2_merge(
    dim: DataFrame,
    incoming: DataFrame,
    as_of: datetime,
    keys: tuple[str, ...] = ("production_plant_name", "country"),
    close_missing: bool = False,
) -> DataFrame:
    """New state of a type-2 dimension.

    A changed row is closed as of `as_of` and opened with its new attributes; a new key is opened;
    a key that no longer arrives stays open unless `close_missing`. Closed rows never change.
    Both sides hold one row per key, so the join has no hot key.
    """
    attributes = [c for c in dim.columns if c not in (*keys, *VALIDITY)]
    active = dim.filter("active_flag")
    left = active.select(F.struct(*dim.columns).alias("old"), *keys)
    right = incoming.select(F.struct(*keys, *attributes).alias("new"), *keys)
    joined = left.join(right, same_keys(left, right, keys), "full_outer").select("old", "new")

    def all_of(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{a}") for a in attributes])

    differs = ~all_of("old").eqNullSafe(all_of("new"))
    ends = differs & (F.col("new").isNotNull() | F.lit(close_missing))
    closing = {"expiry_date": F.lit(as_of.date()), "active_flag": F.lit(False), "updated_at": F.lit(as_of)}
    opening = {
        "effective_date": F.lit(as_of.date()),
        "expiry_date": F.lit(None),
        "active_flag": F.lit(True),
        "created_at": F.lit(as_of),
        "updated_at": F.lit(None),
    }

    def row(side: str, changed: dict[str, Column]) -> Column:
        return F.struct(
            *[
                (changed[f.name].cast(f.dataType) if f.name in changed else F.col(f"{side}.{f.name}")).alias(f.name)
                for f in dim.schema.fields
            ]
        )

    kept = F.when(F.col("old").isNotNull(), F.when(ends, row("old", closing)).otherwise(row("old", {})))
    opened = F.when(F.col("new").isNotNull() & (F.col("old").isNull() | differs), row("new", opening))
    current = joined.select(F.explode(F.array_compact(F.array(kept, opened))).alias("_row")).select("_row.*")
    return dim.filter(~F.col("active_flag")).unionByName(current)
