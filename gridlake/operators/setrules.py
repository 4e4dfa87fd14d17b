"""Rules over sets of rows next to rules over single rows: unique keys, references to another table, fresh groups.

All rules of a table are measured together: each row is sent to a cell for every rule over sets (its key) and to one
cell for all row rules, and cells are added up map-side first. A key that holds a third of all rows is then one cell for
each task, and the rows are read once however many rules there are. Everything after that works on the stored cells.
Counters of `observe` are not used for this: a map task that is repeated after an executor is lost counts its rows twice
there.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.operators.joins import same_keys
from gridlake.workspace import materialise


@dataclass(frozen=True)
class Row:
    """Holds for every row; an unknown outcome counts as failed."""

    name: str
    condition: Column


@dataclass(frozen=True)
class Unique:
    """No two rows share these columns, NULL being a value like others. Failed are the rows beyond the first of a key."""

    name: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Reference:
    """The columns, named alike on both sides, occur in `table`. A key with a NULL part is not checked."""

    name: str
    columns: tuple[str, ...]
    table: DataFrame


@dataclass(frozen=True)
class Fresh:
    """The latest time of each group is at most `limit` before `as_of`. Checked and failed are groups; later times pass."""

    name: str
    columns: tuple[str, ...]
    time: str
    as_of: datetime
    limit: timedelta


Rule = Row | Unique | Reference | Fresh


@dataclass(frozen=True)
class Findings:
    """`report` has (rule, kind, checked, failed, passed), one row a rule; `offenders` (rule, key, rows, latest) for each
    key that breaks a rule over sets, the key as JSON text of its columns."""

    report: DataFrame
    offenders: DataFrame


def _cells(df: DataFrame, row_rules: list[Row], set_rules: list[Rule]) -> DataFrame:
    """One row for each rule over sets and key, and one (rule -1) for all row rules."""
    columns = list(dict.fromkeys(c for rule in set_rules for c in rule.columns))
    times = list(dict.fromkeys(rule.time for rule in set_rules if isinstance(rule, Fresh)))

    def cell(at: int, used: tuple[str, ...] = (), time: str | None = None) -> Column:
        # Columns a rule does not use are NULL, so that all cells have one type.
        key = [F.when(F.lit(c in used), F.col(f"`{c}`")).alias(f"key{i}") for i, c in enumerate(columns)]
        seen = F.col(f"`{time}`").cast("timestamp") if time else F.lit(None).cast("timestamp")
        failed = [(~F.coalesce(r.condition, F.lit(False)) if at < 0 else F.lit(False)).cast("long").alias(f"failed{i}") for i, r in enumerate(row_rules)]
        return F.struct(F.lit(at).alias("rule"), *key, seen.alias("seen"), *failed)

    cells = [cell(-1)] + [cell(i, rule.columns, getattr(rule, "time", None)) for i, rule in enumerate(set_rules)]
    sent = df.select(F.inline(F.array(*cells)))
    sums = [F.sum(f"failed{i}").alias(f"failed{i}") for i in range(len(row_rules))]
    grouped = sent.groupBy("rule", *[f"key{i}" for i in range(len(columns))])
    return grouped.agg(F.count(F.lit(1)).alias("rows"), F.max("seen").alias("latest"), *sums).withColumnsRenamed(
        {f"key{i}": f"key_{c}" for i, c in enumerate(columns)}
    )


def _broken(rule: Rule, cells: DataFrame) -> tuple[DataFrame, Column, Column]:
    """Cells of the rule with `bad`, and the aggregates for what was checked and what failed."""
    keys = [F.col(f"`key_{c}`") for c in rule.columns]
    if isinstance(rule, Unique):
        return cells.withColumn("bad", F.col("rows") > 1), F.sum("rows"), F.sum(F.col("rows") - 1)
    if isinstance(rule, Fresh):
        oldest = F.lit(rule.as_of - rule.limit)
        return cells.withColumn("bad", F.col("latest").isNull() | (F.col("latest") < oldest)), F.count(F.lit(1)), F.count_if("bad")
    complete = cells.filter(reduce(Column.__and__, [k.isNotNull() for k in keys]))
    known = rule.table.select(*[F.col(f"`{c}`").alias(f"key_{c}") for c in rule.columns]).distinct().withColumn("known", F.lit(True))
    joined = complete.join(known, same_keys(complete, known, tuple(f"key_{c}" for c in rule.columns)), "left")
    found = joined.select(*[complete[f"`{c}`"] for c in complete.columns], known["known"].isNull().alias("bad"))
    return found, F.sum("rows"), F.sum(F.when(F.col("bad"), F.col("rows")))


def check(df: DataFrame, rules: list[Rule]) -> Findings:
    """Measure all rules on `df` in one pass. An empty table passes every rule with nothing checked."""
    names = [rule.name for rule in rules]
    if not rules or len(set(names)) < len(names):
        raise ValueError(f"rules need names of their own: {names}")
    row_rules = [rule for rule in rules if isinstance(rule, Row)]
    set_rules = [rule for rule in rules if not isinstance(rule, Row)]
    cells = materialise(_cells(df, row_rules, set_rules), "cells")

    def line(rule: Rule, frame: DataFrame, checked: Column, failed: Column) -> DataFrame:
        counts = frame.agg(F.coalesce(checked, F.lit(0)).alias("checked"), F.coalesce(failed, F.lit(0)).alias("failed"))
        label = [F.lit(rule.name).alias("rule"), F.lit(type(rule).__name__.lower()).alias("kind")]
        return counts.select(*label, "checked", "failed", (F.col("failed") == 0).alias("passed"))

    report = [line(r, cells.filter("rule = -1"), F.sum("rows"), F.sum(f"failed{i}")) for i, r in enumerate(row_rules)]
    offenders = []
    for i, rule in enumerate(set_rules):
        found, checked, failed = _broken(rule, cells.filter(F.col("rule") == i))
        report.append(line(rule, found, checked, failed))
        key = F.to_json(
            F.struct(*[F.col(f"`key_{c}`").alias(c) for c in rule.columns]),
            {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"},
        )
        offenders.append(found.filter("bad").select(F.lit(rule.name).alias("rule"), key.alias("key"), "rows", "latest"))
    nothing = cells.limit(0).select(F.lit("").alias("rule"), F.lit("").alias("key"), "rows", "latest")
    return Findings(reduce(DataFrame.unionByName, report), reduce(DataFrame.unionByName, offenders, nothing))
