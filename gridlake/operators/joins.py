"""Joins against small derived tables, and null-safe key matching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same_keys(left: DataFrame, right: DataFrame, keys: tuple[str, ...]) -> Column:
    """Equality on all keys where NULL equals NULL."""
    return reduce(Column.__and__, [left[k].eqNullSafe(right[k]) for k in keys])


def lookup_join(
    rows: DataFrame, table: DataFrame, keys: tuple[str, ...], how: str = "left", null_safe: bool = False
) -> DataFrame:
    """Join many rows to a table that is expected, but not known, to be small.

    `table` should be a stored one (a gold table, or `materialise` of something derived): the
    planner then decides on its true size. Below the broadcast threshold the rows are not shuffled
    at all; above it both sides are, and AQE splits the partition of a hot key. There is no
    broadcast hint, and the result is the same either way.
    """
    if not null_safe:
        return rows.join(table, list(keys), how)
    renamed = table.withColumnsRenamed({k: f"_{k}" for k in keys})
    condition = reduce(Column.__and__, [rows[k].eqNullSafe(renamed[f"_{k}"]) for k in keys])
    return rows.join(renamed, condition, how).drop(*[f"_{k}" for k in keys])


def anti_join(left: DataFrame, right: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows of `left` whose keys do not occur in `right`."""
    return _by_presence(left, right, keys, "left_anti")


def semi_join(left: DataFrame, right: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows of `left` whose keys occur in `right`, each once."""
    return _by_presence(left, right, keys, "left_semi")


def _by_presence(left: DataFrame, right: DataFrame, keys: tuple[str, ...], how: str) -> DataFrame:
    wanted = right.select(*[F.col(k).alias(f"_{k}") for k in keys])
    condition = reduce(Column.__and__, [left[k].eqNullSafe(wanted[f"_{k}"]) for k in keys])
    return left.join(wanted, condition, how)
