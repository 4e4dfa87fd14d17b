"""Exact quartiles and moments per group, for groups of any size.

Spark's exact `percentile` keeps every distinct value of a group in one task, and a window over
the group sorts all its rows in one task. Neither holds when one production type has a third of
all rows. Here a quantile is found by narrowing: rows are counted in ordered cells (combined
map-side, so any group spreads over all tasks), the cells that hold the wanted ranks are picked
from the small table of counts, and only the rows inside those cells are looked at again. What is
sorted within one task is a table of counts, never the rows themselves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions.measures import present
from gridlake.workspace import materialise

# First cells: this many per power of two, i.e. a relative width of 0.3 %.
CELLS_PER_OCTAVE = 256
# Later cells: this many equal parts of the range of a first cell.
CELLS_PER_STEP = 1 << 20
# A cell with no more rows than this is resolved by its distinct values.
EXACT_ROWS = 1_000_000

_LARGEST = 1.7976931348623157e308


def log_cell(x: Column) -> Column:
    """Cell number that never decreases with `x`; 0 is its own cell."""
    size = F.least(F.abs(x), F.lit(_LARGEST))
    cell = F.floor(F.log2(size) * CELLS_PER_OCTAVE) + 1100 * CELLS_PER_OCTAVE
    return F.when(x == 0, F.lit(0).cast("bigint")).otherwise(F.when(x < 0, -cell).otherwise(cell))


def _cell_counts() -> list[Column]:
    return [F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")]


def _before(keys: tuple[str, ...], order: str) -> Column:
    """Number of rows in earlier cells."""
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(window), F.lit(0))


def _holding(cells: DataFrame) -> DataFrame:
    """Cells that hold at least one wanted rank, with just those ranks."""
    inside = F.filter("_ranks", lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_n")))
    return cells.withColumn("_ranks", inside).filter(F.size("_ranks") > 0)


def _within(rows: DataFrame, cells: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Rows that lie in one of the cells, with the bounds of the cell. A few cells per group."""
    bounds = cells.select(
        *[F.col(k).alias(f"_k_{k}") for k in by],
        F.col("_lo").alias("_from"),
        F.col("_hi").alias("_to"),
        F.col("_before").alias("_start"),
        "_ranks",
        "_total",
    )
    inside = F.col("_x").between(F.col("_from"), F.col("_to"))
    matches = reduce(Column.__and__, [rows[k].eqNullSafe(bounds[f"_k_{k}"]) for k in by])
    return rows.join(bounds, matches & inside).drop(*[f"_k_{k}" for k in by])


def _narrowed(rows: DataFrame, cells: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Cut each cell into equal parts and keep those that hold a wanted rank."""
    part = F.floor((F.col("_x") - F.col("_from")) / (F.col("_to") - F.col("_from")) * CELLS_PER_STEP)
    keys = (*by, "_from")
    counts = (
        _within(rows, cells, by)
        .groupBy(*keys, part.alias("_cell"))
        .agg(*_cell_counts(), F.first("_start").alias("_start"), F.first("_ranks").alias("_ranks"), F.first("_total").alias("_total"))
    )
    return _holding(counts.withColumn("_before", F.col("_start") + _before(keys, "_cell"))).drop("_from", "_start", "_cell")


def _resolved(rows: DataFrame, cells: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Wanted ranks of small cells, by counting their distinct values."""
    keys = (*by, "_from")
    counts = (
        _within(rows, cells, by)
        .groupBy(*keys, "_x")
        .agg(F.count(F.lit(1)).alias("_n"), F.first("_start").alias("_start"), F.first("_ranks").alias("_ranks"), F.first("_total").alias("_total"))
    )
    values = _holding(counts.withColumn("_before", F.col("_start") + _before(keys, "_x")))
    return values.select(*by, F.explode("_ranks").alias("_rank"), F.col("_x").alias("_value"), "_total")


def group_statistics(
    df: DataFrame,
    by: tuple[str, ...],
    value: str,
    probabilities: tuple[float, ...] = (0.25, 0.75),
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """Per group: `observations`, `mean`, `deviation` (sample) and one `q<percent>` per probability.

    Quantiles interpolate linearly between neighbours. Missing values (NULL, NaN) are left out; a
    group without any value has no row. For the whole frame use a plain aggregate.
    """
    if not by:
        raise ValueError("group_statistics needs at least one group column")
    rows = df.select(*by, present(F.col(value)).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    first = materialise(
        rows.groupBy(*by, log_cell(F.col("_x")).alias("_cell")).agg(
            *_cell_counts(), F.avg("_x").alias("_mean"), F.var_pop("_x").alias("_var")
        ),
        "cells",
    )
    group = Window.partitionBy(*by)
    total = F.sum("_n").over(group)
    first = first.withColumns(
        {
            "_total": total,
            "_center": F.sum(F.col("_n") * F.col("_mean")).over(group) / total,
            "_before": _before(by, "_cell"),
        }
    )
    # Within-cell spread plus spread of the cell means: stable, unlike sums of squares.
    spread = F.sum(F.col("_n") * (F.col("_var") + F.pow(F.col("_mean") - F.col("_center"), 2)))
    moments = first.groupBy(*by).agg(
        F.sum("_n").alias("observations"),
        F.first("_center").alias("mean"),
        F.sqrt(F.try_divide(spread, F.sum("_n") - 1)).alias("deviation"),
    )
    if not probabilities:
        return moments

    positions = [F.lit(p) * (F.col("_total") - 1) for p in probabilities]
    ranks = F.array_distinct(F.array(*[edge(p).cast("bigint") for p in positions for edge in (F.floor, F.ceil)]))
    cells = _holding(first.withColumn("_ranks", ranks)).drop("_cell", "_mean", "_var", "_center")

    found = []
    while True:
        cells = materialise(cells, "cells")
        # A cell of equal values needs no further look.
        found.append(
            cells.filter(F.col("_lo") == F.col("_hi")).select(
                *by, F.explode("_ranks").alias("_rank"), F.col("_lo").alias("_value"), "_total"
            )
        )
        cells = cells.filter(F.col("_lo") < F.col("_hi"))
        largest = cells.agg(F.max("_n")).first()[0]
        if largest is None:
            break
        if largest <= exact_rows:
            found.append(_resolved(rows, cells, by))
            break
        cells = _narrowed(rows, cells, by)

    def at(edge) -> list[Column]:
        return [F.max(F.when(F.col("_rank") == edge(p), F.col("_value"))) for p in positions]

    def interpolated(low: Column, high: Column, p: Column) -> Column:
        share = F.first(p - F.floor(p))
        return low + (high - low) * share

    quantiles = [
        interpolated(low, high, p).alias(f"q{round(prob * 100)}")
        for prob, p, low, high in zip(probabilities, positions, at(F.floor), at(F.ceil))
    ]
    values = reduce(DataFrame.unionByName, found).groupBy(*by).agg(*quantiles)
    other = values.withColumnsRenamed({k: f"_k_{k}" for k in by})
    matches = reduce(Column.__and__, [moments[k].eqNullSafe(other[f"_k_{k}"]) for k in by])
    return moments.join(other, matches).drop(*[f"_k_{k}" for k in by])
