"""Reading and writing table folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, DecimalType, MapType, StringType, StructType, VariantType

# What a sort holds for each row besides the row: its length, and its entry in an array that doubles when it is full.
SORT_ENTRY = 52
_VARYING = ArrayType | MapType | StructType | StringType | BinaryType | VariantType | DecimalType


def read_table(
    spark: SparkSession, path: str, schema: StructType | None = None, format: str = "parquet", merge: bool = False
) -> DataFrame:
    """Scan a table folder. `merge` unites the columns of files written by different versions."""
    reader = spark.read.format(format)
    if schema is not None:
        reader = reader.schema(schema)
    elif merge:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder is there, on whatever file system the path names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the finished tables below a folder: those with the mark that Spark leaves after the last file."""
    if not table_exists(spark, path):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [status.getPath().getName() for status in found if status.isDirectory()]
    return sorted(n for n in names if table_exists(spark, f"{path}/{n}/_SUCCESS"))


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folder_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes stored below the paths that exist."""
    total = 0
    for path in paths:
        if table_exists(spark, path):
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
            total += files.getContentSummary(folder).getLength()
    return total


def _writer(df: DataFrame, mode: str, partition_by: tuple[str, ...], rebalance: bool = True):
    """Rows of one partition value are spread over as many tasks as their size needs (rebalance
    splits hot values), so neither a flood of small files nor one giant task comes out. Rows that
    were read from a table of the same partitions lie right already and need no such shuffle."""
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("compression", "snappy")
    return writer.partitionBy(*partition_by) if partition_by else writer


def append_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Add rows; new columns are allowed, readers unite them with `merge`."""
    _writer(df, "append", partition_by).parquet(path)


def overwrite_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), rebalance: bool = True) -> None:
    """Replace the whole table."""
    _writer(df, "overwrite", partition_by, rebalance).option("partitionOverwriteMode", "static").parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: tuple[str, ...], rebalance: bool = True) -> None:
    """Replace only the partitions that occur in `df`."""
    _writer(df, "overwrite", partition_by, rebalance).option("partitionOverwriteMode", "dynamic").parquet(path)


def save_as_table(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> None:
    """Create or replace a catalogue table from `df`."""
    _writer(df, "overwrite", partition_by).saveAsTable(name)


def stored_rows(spark: SparkSession, path: str, newer: StructType) -> DataFrame:
    """All rows and columns of a table to which `newer` rows are to be added; shared columns have the types of `newer`.

    The files may have been written with different columns: their footers are united, in parallel.
    """
    own = spark.read.option("mergeSchema", "true").parquet(path).schema
    types = {f.name: f for f in newer.fields}
    return spark.read.schema(StructType([types.get(f.name, f) for f in own.fields])).parquet(path)


def unite(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both frames by column name; columns missing on one side become NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def observed(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, Observation]:
    """`df` with counters that fill while it is written: no extra pass for logging."""
    observation = Observation(name)
    columns = {"rows": F.count(F.lit(1)), **metrics}
    return df.observe(observation, *[c.alias(k) for k, c in columns.items()]), observation


def checked_write(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    only: Column | None = None,
    rebalance: bool = True,
    **metrics: Column,
) -> dict:
    """Overwrite, then compare the rows written with the rows read back (parquet footers only).

    With `only`, a condition on the partition columns that all rows of `df` meet, just the
    partitions in `df` are replaced and just those matching the condition are counted.
    """
    # Counted in the stage that writes: a map task that is repeated before a shuffle would count its rows twice.
    if partition_by and rebalance:
        df, rebalance = df.hint("rebalance", *partition_by), False
    watched, observation = observed(df, "write", **metrics)
    stored = df.sparkSession.read.schema(df.schema)
    if only is None:
        overwrite_table(watched, path, partition_by, rebalance)
        found = stored.parquet(path).count()
    else:
        overwrite_partitions(watched, path, partition_by, rebalance)
        found = stored.parquet(path).filter(only).count()
    counts = dict(observation.get)
    if found != counts["rows"]:
        raise RuntimeError(f"{path}: wrote {counts['rows']} rows but read {found}")
    return counts


def _value_bytes(value: Column, kind: DataType) -> Column:
    """Bytes of a value in a row in memory, beyond the eight that each field takes."""
    if isinstance(kind, StructType):
        parts = [_value_bytes(value.getField(f.name), f.dataType) for f in kind.fields]
        return sum(parts, F.lit(8 * (len(parts) + 1 + len(parts) // 64)).cast("long"))
    if isinstance(kind, ArrayType):
        inner = F.array_size(value).cast("long") * 8
        if isinstance(kind.elementType, _VARYING):
            inner = F.aggregate(value, inner, lambda total, x: total + _value_bytes(x, kind.elementType))
        return F.coalesce(16 + inner, F.lit(0))
    if isinstance(kind, MapType):
        keys, values = F.map_keys(value), F.map_values(value)
        return _value_bytes(keys, ArrayType(kind.keyType)) + _value_bytes(values, ArrayType(kind.valueType))
    if isinstance(kind, StringType | BinaryType | VariantType):
        text = value.cast("string") if isinstance(kind, VariantType) else value
        return F.coalesce(F.octet_length(text) + 7, F.lit(0)).cast("long")
    return F.lit(16 if isinstance(kind, DecimalType) and kind.precision > 18 else 0).cast("long")


def sort_memory(table: DataFrame) -> int:
    """Bytes that sorting all rows takes, as rows are held unpacked. One pass over the columns of varying width."""
    row = _value_bytes(F.struct("*"), table.schema) + SORT_ENTRY
    return table.agg(F.sum(row)).first()[0] or 0


def compact_table(
    spark: SparkSession,
    source: str,
    target: str,
    cluster_by: tuple[str, ...],
    spread: str,
    partition_by: tuple[str, ...] = (),
    file_bytes: int = 256 << 20,
    sort_bytes: int = 1 << 30,
) -> int:
    """Rewrite a table into files of about `file_bytes`, ordered by `cluster_by` so that min/max statistics prune.

    A task sorts what it writes. Stored rows can be many times larger in memory, so there are also enough ranges
    for each to be sorted in about `sort_bytes`; files of rows that compress well are then smaller than `file_bytes`.
    The range also covers a hash of `spread`: a single hot value of the cluster columns can then
    still be cut into several files. With `partition_by` the folders of the table are kept: they lead the
    range, so a file belongs to one folder or, at the edge of a range, to two. Returns the number of ranges.
    """
    table = spark.read.option("mergeSchema", "true").parquet(source)
    files = max(1, -(-folder_bytes(spark, source) // file_bytes), -(-sort_memory(table) // sort_bytes))
    columns = [F.col(c) for c in (*partition_by, *cluster_by)]
    ordered = table.repartitionByRange(files, *columns, F.xxhash64(spread)).sortWithinPartitions(*columns)
    writer = ordered.write.mode("overwrite").option("compression", "snappy").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)
    return files
