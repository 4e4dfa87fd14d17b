"""Helpers that the operators of this package share."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.workspace import materialise

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Rows that a Python worker receives at a time: texts can be long, and two workers share an executor.
BATCH_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at a time, and let workers of this machine import this package.

    On a cluster the package is installed or passed along like any other; the added path is then of no effect.
    """
    for key, value in BATCH_ROWS.items():
        spark.conf.set(key, value)
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, known]))


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case, everything else as it is. Pure ASCII texts take the faster built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def with_type(df: DataFrame, name: str, kind: str) -> Column:
    """The column `name` cast to `kind`; null if the table has no such column."""
    return (F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast(kind)


def carried(docs: DataFrame, *needed: tuple[str, str]) -> DataFrame:
    """`docs` with each row as one struct, `carried_row`, next to typed copies of the columns an operator needs.

    Whatever else a table holds, no column of it can clash with one that the operator adds.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("carried_row"), *[with_type(docs, name, kind).alias(name) for name, kind in needed])


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components: `(node, root)` for each node of `edges (u, v)`, root being the smallest node reached.

    Alternates the two star operations (link each larger neighbour to the smallest neighbour; then link the smaller
    ones) until no edge changes; the number of rounds grows with the logarithm of the longest path. Each round is
    written to the shared workspace, so that the lineage stays short and a lost executor repeats one round. Window
    functions over a node would gather all its neighbours in one task; minima and joins, which combine before the
    shuffle and split hot keys, do the same work here.
    """
    edges = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), name)
    # First each node is tied to the smallest of its neighbourhood, and what is left of an edge is a tie between two of
    # those. Many edges among the same nodes become few.
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    tied = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("v")), name)
    moved = edges.join(tied.select("u", F.col("v").alias("a")), "u").join(tied.select(F.col("u").alias("v"), F.col("v").alias("b")), "v")
    moved = moved.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current = materialise(tied.unionByName(moved).filter("u <> v").distinct(), name)
    before = None
    while True:
        # Large star: the larger neighbours of a node, and the node, to the smallest of its neighbourhood.
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # Small star: the smaller neighbours of a node, and the node, to the smallest of them.
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        current = materialise(small.filter("u <> v").distinct(), name)
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())

