"""Catalogue tables stored in buckets of their business key, and upserts that leave the stored side unshuffled.

A table is cut by partition columns and, within each, by a hash of its key. An upsert sends only the arriving rows
over the network: bucket n of the stored rows and the arriving rows of bucket n meet in one task, which also writes
bucket n again. The key is one text column of the table, in which NULL parts are visible, since Spark can't use buckets
for keys that are compared null-safely. Keys are unique, so no bucket is hot. Only partitions that the arriving rows touch are read and replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.operators.dedup import keep_latest
from gridlake.operators.merge import _one_of
from gridlake.workspace import materialise

BUCKET = "bucket_key"


def bucket_count(stored_bytes: int, file_bytes: int = 256 << 20) -> int:
    """Buckets for files of about `file_bytes` in a partition that will hold `stored_bytes`."""
    return max(1, -(-stored_bytes // file_bytes))


def _keyed(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """`df` with the exact text of its key, the same in every session."""
    exact = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "timeZone": "UTC"}
    return df.withColumn(BUCKET, F.to_json(F.struct(*[F.col(k) for k in keys]), exact))


def create(
    df: DataFrame,
    name: str,
    keys: tuple[str, ...],
    partition_by: tuple[str, ...],
    newest_first: tuple[str, ...],
    buckets: int,
    path: str | None = None,
) -> None:
    """A new table `name` with the newest row of each key; fails if there is one. With `path` the files lie there.

    Rows are dealt to tasks as they are to buckets, so a partition has one file a bucket.
    """
    dealt = _keyed(keep_latest(df, keys, *newest_first), keys).repartition(buckets, BUCKET)
    writer = dealt.write.format("parquet").mode("error").partitionBy(*partition_by).bucketBy(buckets, BUCKET).sortBy(BUCKET)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def read(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a table as they were given."""
    return spark.table(name).drop(BUCKET)


def merged(stored: DataFrame, arriving: DataFrame, newest_first: tuple[str, ...]) -> DataFrame:
    """The rows of both, one row a key: the newer one, and the arriving one of equally new rows.

    Both hold one row a key and `bucket_key`. NULL is older than any time. Columns that the arriving rows lack keep their
    stored value.
    """
    old = stored.select(F.struct(*stored.columns).alias("old"), BUCKET)
    new = arriving.select(F.struct(*arriving.columns).alias("new"), BUCKET)
    joined = old.join(new, BUCKET, "full_outer").select("old", "new")

    def age(side: str) -> Column:
        fields = [f for c in newest_first for f in (F.col(f"{side}.{c}").isNotNull(), F.col(f"{side}.{c}"))]
        return F.struct(*[f.alias(f"a{i}") for i, f in enumerate(fields)])

    stays = F.col("new").isNull() | (F.col("old").isNotNull() & (age("old") > age("new")))

    def value(column: str) -> Column:
        if column not in arriving.columns:
            return F.col(f"old.`{column}`")
        return F.when(stays, F.col(f"old.`{column}`")).otherwise(F.col(f"new.`{column}`"))

    return joined.select(*[value(c).alias(c) for c in stored.columns])


def upsert(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    keys: tuple[str, ...],
    partition_by: tuple[str, ...],
    newest_first: tuple[str, ...],
) -> DataFrame:
    """Upsert into a table of `create`, replacing only the partitions the source touches; returns the rows that arrived.

    The partition columns must follow from the keys. A stored row that is newer stays; of rows equally new the arriving
    one wins, so applying a batch twice changes nothing. Columns that are new to the table are added to it, NULL in the
    rows it holds. An empty source changes nothing. Readers should not read a partition while it is replaced.
    """
    arrived = materialise(_keyed(keep_latest(source, keys, *newest_first), keys), "arrived")
    known = spark.table(name).columns
    added = [f"`{f.name}` {f.dataType.simpleString()}" for f in arrived.schema.fields if f.name not in known]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(added)})")
    # One short row a touched partition; as literals they prune the scan.
    touched = arrived.select(*partition_by).distinct().collect()
    if touched:
        stored = spark.table(name)
        types = {f.name: f.dataType for f in stored.schema.fields}
        arriving = arrived.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in arrived.columns])
        rows = merged(stored.filter(_one_of(touched, partition_by)), arriving, newest_first)
        before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            rows.write.insertInto(name, overwrite=True)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    return arrived.drop(BUCKET)
