"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: tuple[str | Column, ...], *newest_first: str) -> DataFrame:
    """The row of each key that sorts last by `newest_first`; name enough columns for a total order.

    `row_number() = 1` lets Spark drop all but one row per key in every map task already
    (WindowGroupLimit), so a key with a huge number of copies costs no more than others after
    the shuffle.
    """
    order = [F.col(c).desc_nulls_last() for c in newest_first]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
