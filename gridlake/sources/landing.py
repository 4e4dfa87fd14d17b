"""Landed payload files to bronze tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from gridlake import schemas
from gridlake.operators.joins import anti_join
from gridlake.sources import payloads, tables
from gridlake.workspace import scratch_path


def landing_schema(kind: str) -> StructType:
    """Envelope and payload of one landed JSON object, and room for an unreadable line."""
    merged = StructType(schemas.ENVELOPE.fields + schemas.PAYLOAD[schemas.known_kind(kind)].fields)
    return merged.add(schemas.CORRUPT, StringType())


def read_landing(spark: SparkSession, path: str | list[str], kind: str) -> DataFrame:
    """Landed files, one JSON object per line; an unreadable line is kept in the corrupt column."""
    return (
        spark.read.schema(landing_schema(kind))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .json(path)
    )


def ingest(
    spark: SparkSession, landing_dir: str, kind: str, bronze_path: str, batch_id: str, as_of: datetime
) -> dict:
    """Validate, flatten and append one landing folder; rejects go next to the bronze table.

    Returns the counts of the write. The landed text is read and parsed once, into a staged table with
    the rejects in a folder of their own; both results come from there.
    """
    return _ingest(spark, [landing_dir], kind, bronze_path, batch_id, as_of)


def _ingest(
    spark: SparkSession, paths: list[str], kind: str, bronze_path: str, batch_id: str, as_of: datetime, again: bool = False
) -> dict:
    """`again` says that an earlier try of the same batch may have got as far as the bronze table or the rejects."""
    checked = payloads.check_payloads(read_landing(spark, paths, kind), kind)
    checked = checked.withColumn("rejected", F.col("reject_reason").isNotNull())
    staged = scratch_path(spark, "checked")
    checked.write.partitionBy("rejected").parquet(staged)
    checked = spark.read.schema(checked.schema).parquet(staged)
    rows = payloads.to_bronze(payloads.usable(checked.filter("not rejected").drop("rejected")), kind, batch_id, as_of=as_of)
    rows = _not_in(spark, bronze_path, rows, batch_id, "record_id") if again else rows
    measure = F.col(schemas.MEASURE[kind])
    rows, written = tables.observed(rows, f"ingest_{kind}", missing=F.count_if(measure.isNull()))
    tables.append_table(rows, bronze_path)
    failed = checked.filter("rejected").drop("rejected")
    stamped = failed.withColumns({"ingestion_batch_id": F.lit(batch_id), "rejected_at": F.lit(as_of)})
    reject_path = f"{bronze_path.rstrip('/')}_rejects"
    if again:
        stamped = _not_in(spark, reject_path, stamped, batch_id, "ingestion_batch_id")
    rejects = stamped.count()
    if rejects:
        tables.append_table(stamped, reject_path)
    return {**written.get, "rejects": rejects}


def _not_in(spark: SparkSession, path: str, rows: DataFrame, batch_id: str, key: str) -> DataFrame:
    """Rows whose key the table doesn't hold for that batch yet. An append is seen as a whole or not at all."""
    if not tables.table_exists(spark, path):
        return rows
    held = spark.read.schema(rows.schema).parquet(path).filter(F.col("ingestion_batch_id") == batch_id)
    return anti_join(rows, held.select(key).distinct(), (key,))


# One row for each landed file and step: path, bytes and time of change tell a file that was replaced from the old one.
REGISTER = "path string, length long, modified timestamp, batch_id string, at timestamp, done boolean"
_FILE = ("path", "length", "modified")


def landed_files(spark: SparkSession, landing_dir: str) -> DataFrame:
    """Path, length and time of the landed files; their content isn't read."""
    return spark.read.format("binaryFile").load(landing_dir).select("path", "length", F.col("modificationTime").alias("modified"))


def ingest_new(
    spark: SparkSession, landing_dir: str, kind: str, bronze_path: str, register_path: str, batch_id: str, as_of: datetime
) -> dict:
    """`ingest`, but each landed file once only, however often and with whatever batch it is called.

    A register keeps the files of every batch, before the parse as begun and after the write as done. A batch that was
    begun and not done is finished first, under its own name: rows of it that are there already are not written again. A
    file that was replaced (other length or time) counts as a new one. Returns the counts and the number of files.
    """
    register = spark.read.schema(REGISTER).parquet(register_path) if tables.table_exists(spark, register_path) else spark.createDataFrame([], REGISTER)
    finished = register.filter("done")
    begun = anti_join(register.filter("not done"), finished, (*_FILE, "batch_id")).distinct()
    totals = {"rows": 0, "missing": 0, "rejects": 0, "files": 0}
    # A few short rows for each file that is to be read: the driver lists all files anyway.
    for batch, found in _by_batch(begun):
        _add(totals, _registered(spark, found, kind, bronze_path, register_path, batch, as_of, again=True))
    new = anti_join(landed_files(spark, landing_dir), register, _FILE).collect()
    if new:
        _add(totals, _registered(spark, new, kind, bronze_path, register_path, batch_id, as_of))
    return totals


def _by_batch(begun: DataFrame) -> list[tuple[str, list]]:
    batches: dict[str, list] = {}
    for row in begun.orderBy("at", "batch_id").collect():
        batches.setdefault(row.batch_id, []).append(row)
    return list(batches.items())


def _add(totals: dict, counts: dict) -> None:
    for name, n in counts.items():
        totals[name] += n


def _registered(spark, files: list, kind: str, bronze_path: str, register_path: str, batch_id: str, as_of: datetime, again: bool = False) -> dict:
    def note(done: bool) -> None:
        rows = [(f.path, f.length, f.modified, batch_id, as_of, done) for f in files]
        tables.append_table(spark.createDataFrame(rows, REGISTER).coalesce(1), register_path)

    if not again:
        note(False)
    # The time stands in for a missing ingestion date and is part of the record ids: a repeated batch keeps its own.
    began = files[0].at if again else as_of
    counts = _ingest(spark, [f.path for f in files], kind, bronze_path, batch_id, began, again)
    note(True)
    return {**counts, "files": len(files)}
