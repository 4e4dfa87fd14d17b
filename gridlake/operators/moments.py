"""Moments kept by month: number, mean and sum of squared deviations, mergeable without the rows.

The limits of the outlier flag come from the whole history. Instead of scanning it on every run, its moments are stored by
month; a run replaces those of the months it touches, reading these months only, and merges the few stored rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions.measures import present
from gridlake.operators.joins import lookup_join
from gridlake.sources import tables
from gridlake.sources.windows import in_months
from gridlake.workspace import materialise

MONTHLY = ("year", "month")


def moments(df: DataFrame, measure: str, by: tuple[str, ...] = ()) -> DataFrame:
    """`by, n, mean, m2` of the values that are present; a group without any has no row."""
    value = present(F.col(measure)).cast("double")
    n = F.count(value)
    found = df.groupBy(*by).agg(n.alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * n).alias("m2"))
    return found.filter("n > 0")


def merged(parts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Moments of the union of the parts: the spread within them plus that of their means around the common one.

    `parts` should be a stored table: it is read twice.
    """
    center = [F.sum("n").alias("_n"), F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("_mean")]
    if by:
        centered = lookup_join(parts, materialise(parts.groupBy(*by).agg(*center), "centers"), by, "inner", null_safe=True)
    else:
        total = parts.agg(F.struct(*center).alias("_c")).scalar()
        centered = parts.withColumn("_c", total).select("*", "_c.*")
    spread = F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("_mean"), 2)
    return centered.groupBy(*by).agg(F.sum("n").alias("n"), F.first("_mean").alias("mean"), F.sum(spread).alias("m2"))


def deviation() -> Column:
    """Sample deviation; NULL below two values."""
    return F.sqrt(F.when(F.col("n") > 1, F.col("m2") / (F.col("n") - 1)))


def refresh(
    spark: SparkSession, path: str, history: DataFrame, measure: str, months: list[tuple] | None = None, ts: str = "timestamp"
) -> DataFrame:
    """Bring the stored monthly moments up to date with `history` and return them.

    Only the given months, as (year, month), are read and replaced; all of them if `months` is None or nothing is stored
    yet. Rows without a time make up a month (None, None). Doing it again changes nothing.
    """
    whole = months is None or not tables.table_exists(spark, path)
    rows = history if whole else history.filter(in_months(history, ts, months))
    dated = rows.select(F.year(ts).alias("year"), F.month(ts).alias("month"), measure)
    found = moments(dated, measure, MONTHLY)
    if not whole:
        # A month that has lost all its values must not keep its old moments.
        asked = spark.createDataFrame(months, "year int, month int")
        found = lookup_join(asked, materialise(found, "moments"), MONTHLY, "left", null_safe=True).fillna(0, ["n"])
        found = found.select(*MONTHLY, "n", "mean", "m2")
    write = tables.overwrite_table if whole else tables.overwrite_partitions
    write(found.coalesce(1), path, MONTHLY, rebalance=False)
    return spark.read.schema(found.schema).parquet(path).filter("n > 0").select(*MONTHLY, "n", "mean", "m2")
