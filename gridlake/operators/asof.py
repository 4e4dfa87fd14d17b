"""Joins to what was valid at the time of a row.

A range join would compare every row with every interval of its key, and a window over a whole series would put a hot
series into one task. Here intervals are dealt to the calendar buckets they touch, rows to the one they lie in; both are
united and one window pass per key and bucket carries the last interval forward. No task sorts more of a series than one
bucket.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.workspace import materialise


def intervals(history: DataFrame, keys: tuple[str, ...], valid_from: str, valid_to: str | None = None, extend_first: bool = False) -> DataFrame:
    """`history` with `_from` and `_to` (exclusive, NULL: open): a row is valid until its own end or the next row of its key.

    Of rows that begin together the last one by end counts; empty intervals are left out. With `extend_first` the first
    row of a key is valid for all earlier times as well (`_from` is NULL). History is small: a few rows per key.
    """
    start = F.col(valid_from).cast("timestamp")
    end = F.col(valid_to).cast("timestamp") if valid_to else F.lit(None).cast("timestamp")
    series = Window.partitionBy(*keys).orderBy("_from", F.asc_nulls_last("_to"))
    found = history.filter(reduce(Column.__and__, [F.col(k).isNotNull() for k in (*keys, valid_from)]))
    found = found.withColumns({"_from": start, "_to": end}).filter("_to is null or _from < _to")
    found = found.withColumns({"_next": F.lead("_from").over(series), "_first": F.row_number().over(series) == 1})
    found = found.withColumn("_to", F.least("_to", "_next")).filter("_to is null or _from < _to")
    return found.withColumn("_from", F.when(~(F.col("_first") & F.lit(extend_first)), F.col("_from"))).drop("_next", "_first")


def as_of_join(
    rows: DataFrame,
    history: DataFrame,
    keys: tuple[str, ...],
    time: str,
    columns: tuple[str, ...],
    valid_from: str,
    valid_to: str | None = None,
    bucket: str = "month",
    extend_first: bool = False,
) -> DataFrame:
    """Every row of `rows` with the `columns` of the history row of its keys that was valid at `time`, else NULL.

    Intervals are half-open: a row at the moment of a change gets the new values. The number of rows is unchanged; rows
    without a key or time keep NULL.
    """
    span = rows.agg(F.min(time).alias("first"), F.max(time).alias("last")).first()
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in (*keys, time)])
    value = F.struct(*[F.col(c) for c in columns])
    valid = intervals(history, keys, valid_from, valid_to, extend_first)
    valid = materialise(valid.select(*keys, "_from", "_to", value.alias("_valid")), "intervals")
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row")
    at = F.col(time).cast("timestamp")
    asked = rows.select(row, *keys, at.alias("_at"), F.date_trunc(bucket, at).alias("_bucket"), F.lit(None).cast(valid.schema["_valid"].dataType).alias("_valid"))
    if span.first is None:
        united = asked.withColumn("_found", F.col("_valid"))
    else:
        # From the bucket an interval begins in, or the first one that has rows, to the last one it reaches.
        low, high = (F.date_trunc(bucket, F.lit(t).cast("timestamp")) for t in (span.first, span.last))
        begin = F.greatest(F.date_trunc(bucket, "_from"), low)
        last = F.least(F.date_trunc(bucket, F.col("_to") - F.expr("interval 1 microsecond")), high)
        step = {"day": "interval 1 day", "month": "interval 1 month", "year": "interval 1 year"}[bucket]
        dealt = valid.filter(begin <= last).withColumn("_bucket", F.explode(F.sequence(begin, last, F.expr(step))))
        # Where an interval ends without a next one, an empty value takes over.
        marks = dealt.select(*keys, "_bucket", F.explode(F.array(
            F.struct(F.greatest("_from", "_bucket").alias("_at"), F.lit(1).alias("_order"), F.col("_valid")),
            F.struct(F.col("_to").alias("_at"), F.lit(0).alias("_order"), F.lit(None).cast(valid.schema["_valid"].dataType).alias("_valid")),
        )).alias("_m")).select(*keys, "_bucket", "_m.*").filter(F.col("_at").isNotNull())
        empty = F.lit(None).cast(asked.schema["_row"].dataType).alias("_row")
        marks = marks.select(empty, *keys, "_at", "_bucket", F.struct("_valid").alias("_mark"), "_order")
        points = asked.filter(known).select("_row", *keys, "_at", "_bucket", F.lit(None).cast(marks.schema["_mark"].dataType).alias("_mark"), F.lit(2).alias("_order"))
        so_far = Window.partitionBy(*keys, "_bucket").orderBy("_at", "_order").rowsBetween(Window.unboundedPreceding, 0)
        carried = marks.unionByName(points).withColumn("_found", F.last("_mark", ignorenulls=True).over(so_far)["_valid"])
        united = carried.filter(F.col("_row").isNotNull()).select("_row", "_found")
        united = united.unionByName(asked.filter(~known).select("_row", F.col("_valid").alias("_found")))
    kept = [c for c in rows.columns if c not in columns]
    return united.select(*[F.col(f"_row.`{c}`") for c in kept], *[F.col(f"_found.`{c}`") for c in columns])
