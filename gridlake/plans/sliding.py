"""Seasonal baselines that move with their window instead of being computed anew.

Half hours are counted in cells of nearly equal values, per slot and day, and stored by month. The window of the last days
is the sum of its days: when it moves, the cells of days that enter are added and those of days that leave subtracted, so a
run reads these days only. What can be added can be subtracted without drift, because counts are whole numbers and sums are
decimals: of the distances of the values (rounded to ten digits) from the edge of their cell, and of their squares.

Moments follow from the sums; as distances within a cell are small, nothing cancels out. A quantile is found in the cell
that holds its rank: a cell whose sums say that all its values are equal (with one value they are) gives it at once, and
only the others are looked up among the days again.

Values of 10^10 and more count as missing.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlake.functions.measures import present
from gridlake.operators.quantiles import CELLS_PER_OCTAVE, log_cell
from gridlake.plans.baseline import MODERATE, SEVERE, SLOT_KEYS, slots, with_thresholds
from gridlake.sources import tables
from gridlake.sources.windows import in_months_from
from gridlake.workspace import materialise

MONTHLY = ("year", "month")
VALUE, DISTANCE, SQUARE = "decimal(20,10)", "decimal(18,10)", "decimal(38,20)"
PROBABILITIES = (0.25, 0.5, 0.75)


def _unit(day: datetime) -> int:
    """Number of the half hour that opens a day. The rest of a day is the next unit: a window ends with an opening."""
    return 2 * (day.date() - datetime(1970, 1, 1).date()).days


def day_cells(agg: DataFrame) -> DataFrame:
    """Half hours counted by slot, unit and cell; those without a value are in the cell NULL."""
    ts, value = F.col("timestamp_30min"), present(F.col("avg_electricity_produced")).try_cast(VALUE)
    rows = slots(agg).select(
        *SLOT_KEYS,
        *[F.year(ts).alias("year"), F.month(ts).alias("month")],
        (2 * F.unix_date(F.to_date(ts)) + (ts > F.date_trunc("day", ts)).cast("int")).cast("long").alias("unit"),
        F.when(value.isNotNull(), log_cell(value.cast("double"))).alias("cell"),
        value.alias("x"),
    )
    distance = (F.col("x") - _edge(F.col("cell"))).cast(DISTANCE)
    rows = rows.withColumn("d", distance)
    return rows.groupBy(*SLOT_KEYS, *MONTHLY, "unit", "cell").agg(*_sums(F.lit(1), F.col("d"), F.col("d") * F.col("d")))


def _edge(cell: Column) -> Column:
    """The value that distances in a cell are taken from: its edge nearer to zero, with ten digits."""
    size = F.pow(F.lit(2.0), (F.abs(cell) - 1100 * CELLS_PER_OCTAVE) / CELLS_PER_OCTAVE)
    return F.when(cell == 0, F.lit(0)).otherwise(F.signum(cell) * size).cast(VALUE)


def _sums(n: Column, d: Column, dd: Column) -> list[Column]:
    return [
        F.sum(n).cast("long").alias("n"),
        F.coalesce(F.sum(d), F.lit(0)).cast("decimal(38,10)").alias("d"),
        F.coalesce(F.sum(dd), F.lit(0)).cast(SQUARE).alias("dd"),
    ]


def _window(cells: DataFrame, low: int, high: int) -> DataFrame:
    return cells.filter(F.col("unit").between(low, high))


def _signed(cells: DataFrame, sign: int) -> DataFrame:
    return cells.select(*SLOT_KEYS, "cell", *[(F.col(c) if sign > 0 else F.negative(c)).alias(c) for c in ("n", "d", "dd")])


def _total(parts: list[DataFrame]) -> DataFrame:
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    return united.groupBy(*SLOT_KEYS, "cell").agg(*_sums(F.col("n"), F.col("d"), F.col("dd"))).filter("n <> 0 or d <> 0 or dd <> 0")


class SlidingBaseline:
    """The stored cells and the stored window below one folder."""

    def __init__(self, spark: SparkSession, root: str, days: int = 90):
        self.spark, self.days = spark, days
        self.cells_path, self.state_path, self.mark_path = (f"{root}/baseline_{n}" for n in ("cells", "window", "unfinished"))

    def advance(self, agg: DataFrame, as_of: datetime, since: datetime | None = None) -> None:
        """Bring cells and window up to the midnight before `as_of`, forward or back.

        `agg` are the half hours; with `since` only its months from that time on have changed and are read. A run that was
        cut off leaves a mark, and the next one adds the window up anew from the cells of all of `agg`.
        """
        high = _unit(as_of)
        low = high - 2 * self.days
        before = self._bounds()
        if before is None or tables.table_exists(self.spark, self.mark_path):
            self._mark(True)
            tables.overwrite_table(day_cells(agg), self.cells_path, MONTHLY)
            self._store([_signed(_window(self._cells(), low, high), 1)], low, high)
        else:
            was_low, was_high = before
            self._mark(True)
            fresh, stored = agg, self._cells()
            if since is not None:
                start = since.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
                only = in_months_from(since.date())
                fresh, stored = agg.filter(F.col("timestamp_30min") >= F.lit(start)), stored.filter(only)
                fresh = fresh.filter(only) if set(MONTHLY) <= set(agg.columns) else fresh
            fresh = materialise(day_cells(fresh), "cells")
            # What has changed within the old window, then what leaves and what enters it.
            parts = [_signed(_window(fresh, was_low, was_high), 1), _signed(_window(stored, was_low, was_high), -1)]
            changes = materialise(_total(parts), "changes")
            if since is None:
                tables.overwrite_table(fresh, self.cells_path, MONTHLY)
            else:
                tables.overwrite_partitions(fresh, self.cells_path, MONTHLY)
            cells, parts = self._cells(), [self._state(), changes]
            for first, last, sign in _moves(was_low, was_high, low, high):
                parts.append(_signed(_window(cells, first, last).filter(_months_between(first, last)), sign))
            self._store(parts, low, high)
        self._mark(False)

    def baseline(self, dim: DataFrame, as_of: datetime, min_observations: int = 10, moderate: float = MODERATE, severe: float = SEVERE) -> DataFrame:
        """What `performance_baseline` gives for the window, from the sums."""
        state = self._state()
        group = Window.partitionBy(*SLOT_KEYS)
        n, d, dd = (F.col(c).cast("double") for c in ("n", "d", "dd"))
        cells = state.withColumns({"_n": F.when(F.col("cell").isNotNull(), n), "_mean": _edge(F.col("cell")).cast("double") + d / n})
        cells = cells.withColumn("_center", F.try_divide(F.sum(F.col("_n") * F.col("_mean")).over(group), F.sum("_n").over(group)))
        # Spread within the cells and spread of their means.
        spread = F.sum(F.greatest(dd - d * d / n, F.lit(0.0)) + F.col("_n") * F.pow(F.col("_mean") - F.col("_center"), 2))
        moments = cells.groupBy(*SLOT_KEYS).agg(
            F.max("_center").alias("baseline_avg_production"),
            F.sqrt(F.when(F.sum("_n") > 1, spread / (F.sum("_n") - 1))).alias("baseline_std_production"),
            F.sum("n").alias("historical_observations"),
        )
        moments = moments.filter(F.col("historical_observations") >= min_observations)
        named = {0.25: "p25", 0.5: "median", 0.75: "p75"}
        found = self._quantiles(state).withColumnsRenamed({f"q{p}": f"baseline_{named[p]}_production" for p in PROBABILITIES})
        return with_thresholds(moments.join(found, list(SLOT_KEYS), "left"), dim, as_of, moderate, severe)

    def _quantiles(self, state: DataFrame) -> DataFrame:
        group = Window.partitionBy(*SLOT_KEYS)
        earlier = group.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        ranked = state.filter("cell is not null").withColumns(
            {"_total": F.sum("n").over(group), "_before": F.coalesce(F.sum("n").over(earlier), F.lit(0))}
        )
        positions = {p: F.lit(p) * (F.col("_total") - 1) for p in PROBABILITIES}
        ranks = F.array_distinct(F.array(*[edge(p).cast("long") for p in positions.values() for edge in (F.floor, F.ceil)]))
        inside = F.filter(ranks, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("n")))
        holding = ranked.withColumn("_ranks", inside).filter(F.size("_ranks") > 0)
        # Equal distances and only those have a mean whose square is the mean of the squares.
        mean = (F.col("d") / F.col("n")).cast(DISTANCE)
        n = F.col("n").cast("decimal(10,0)")
        equal = ((mean * n).cast("decimal(38,10)") == F.col("d")) & ((mean * mean * n).cast(SQUARE) == F.col("dd"))
        holding = materialise(holding.withColumn("_value", F.when(equal, _value(mean))), "holding")
        known = holding.filter("_value is not null").select(*SLOT_KEYS, "_total", F.explode("_ranks").alias("_rank"), "_value")
        # The second look: the days of the window, only where a cell holds different values.
        mixed = holding.filter("_value is null").select(*SLOT_KEYS, "cell", "_total", "_before", "_ranks")
        low, high = self._bounds()
        days = _window(self._cells(), low, high).filter(_months_between(low, high))
        look = days.join(mixed, [*SLOT_KEYS, "cell"]).groupBy(*SLOT_KEYS, "cell", "_total", "_before", "_ranks", _value((F.col("d") / F.col("n")).cast(DISTANCE)).alias("_value")).agg(F.sum("n").alias("n"))
        in_cell = Window.partitionBy(*SLOT_KEYS, "cell").orderBy("_value").rowsBetween(Window.unboundedPreceding, -1)
        look = look.withColumn("_before", F.col("_before") + F.coalesce(F.sum("n").over(in_cell), F.lit(0)))
        seen = look.withColumn("_rank", F.explode(F.filter("_ranks", lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("n")))))
        values = known.unionByName(seen.select(*SLOT_KEYS, "_total", "_rank", "_value"))

        def at(edge, p: Column) -> Column:
            return F.max(F.when(F.col("_rank") == edge(p), F.col("_value")))

        picked = [
            (at(F.floor, p) + (at(F.ceil, p) - at(F.floor, p)) * F.first(p - F.floor(p))).alias(f"q{name}") for name, p in positions.items()
        ]
        return values.groupBy(*SLOT_KEYS).agg(*picked)

    def _cells(self) -> DataFrame:
        return self.spark.read.parquet(self.cells_path)

    def _state(self) -> DataFrame:
        return self.spark.read.parquet(self._newest()).drop("low", "high")

    def _newest(self) -> str:
        """Folder of the current window: each one is written whole, next to the one before."""
        names = tables.folder_names(self.spark, self.state_path)
        return f"{self.state_path}/{max(names)}" if names else ""

    def _bounds(self) -> tuple[int, int] | None:
        path = self._newest()
        if not path:
            return None
        low, high = path.rsplit("/", 1)[1].split("_")[1:]
        return int(low), int(high)

    def _store(self, parts: list[DataFrame], low: int, high: int) -> None:
        names = tables.folder_names(self.spark, self.state_path)
        number = int(max(names).split("_")[0]) + 1 if names else 0
        tables.overwrite_table(_total(parts), f"{self.state_path}/{number:09d}_{low}_{high}")
        for name in names:
            tables.delete_folder(self.spark, f"{self.state_path}/{name}")

    def _mark(self, unfinished: bool) -> None:
        if unfinished:
            tables.overwrite_table(self.spark.range(1), self.mark_path)
        else:
            tables.delete_folder(self.spark, self.mark_path)


def _value(distance: Column) -> Column:
    return (_edge(F.col("cell")) + distance).cast("double")


def _moves(was_low: int, was_high: int, low: int, high: int) -> list[tuple[int, int, int]]:
    """Ranges of units to add (1) and to subtract (-1) when one window becomes another."""
    if low > was_high or high < was_low:
        return [(was_low, was_high, -1), (low, high, 1)]
    moves = [(was_high + 1, high, 1), (high + 1, was_high, -1), (low, was_low - 1, 1), (was_low, low - 1, -1)]
    return [(a, b, sign) for a, b, sign in moves if a <= b]


def _months_between(low: int, high: int) -> Column:
    """The months that a range of units touches, on the partition columns."""
    first, last = (datetime(1970, 1, 1) + timedelta(days=u // 2) for u in (low, high))
    return (F.col("year") * 12 + F.col("month")).between(first.year * 12 + first.month, last.year * 12 + last.month)
