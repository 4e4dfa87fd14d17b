"""Payloads whose fields change: keep what the layout does not know, and report it.

A payload is read as VARIANT next to the typed arrays. Fields that the layout lacks, of the object and of the objects in
its arrays, are kept as they came. The report counts all fields by name, with the type that holds all their values:
unknown ones, and those of the layout that are missing or come with another type. Keeping is a narrow step inside the
task that read the file, on streams too; the report groups by field with partial aggregates, so a field that is in every
payload costs one row a task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake import schemas

_FIELD = "array<struct<field:string,item:int,value:variant>>"

# Types, as VARIANT names them, that a column of the layout reads without loss.
_NUMBER = r"BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\)|VOID"
_READS = {T.LongType: "BIGINT|VOID", T.DoubleType: _NUMBER, T.DecimalType: _NUMBER, T.StringType: "STRING|VOID", T.StructType: "OBJECT<.*>|VOID"}
# Fields that have a second form by design.
_ALSO = {"unit": "ARRAY<STRING>|ARRAY<VOID>"}


def _pattern(kind: T.DataType) -> str:
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<({_pattern(kind.elementType)})>|VOID"
    return _READS[type(kind)]


def known_fields(kind: str) -> dict[str, str]:
    """The fields of a layout, those in arrays of objects as `array[].field`, with a pattern of the types they may have."""
    known = {}
    for field in schemas.PAYLOAD[schemas.known_kind(kind)].fields:
        known[field.name] = "|".join(filter(None, [_pattern(field.dataType), _ALSO.get(field.name)]))
        if isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StructType):
            known |= {f"{field.name}[].{inner.name}": _pattern(inner.dataType) for inner in field.dataType.elementType.fields}
    return known


def _object(value: Column) -> Column:
    """The fields of an object as a map; NULL for anything else."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def _entries(value: Column, name: Callable[[Column], Column], item: Column) -> Column:
    found = F.transform(F.map_entries(_object(value)), lambda e: F.struct(name(e["key"]).alias("field"), item.alias("item"), e["value"].alias("value")))
    return F.coalesce(found, F.array().cast(_FIELD))


def _fields(payload: Column, kind: str) -> Column:
    """All fields of a payload: name, position in the array for those of array elements, value. NULL if it is no object."""
    parts = [_entries(payload, lambda key: key, F.lit(None).cast("int"))]
    for name in sorted({f.split("[]")[0] for f in known_fields(kind) if "[]." in f}):
        items = F.coalesce(F.try_variant_get(payload, f"$.{name}", "array<variant>"), F.array().cast("array<variant>"))

        prefix = F.lit(f"{name}[].")
        parts.append(F.flatten(F.transform(items, lambda item, i: _entries(item, lambda key: F.concat(prefix, key), i))))
    return F.when(_object(payload).isNotNull(), F.concat(*parts))


def with_unknown(df: DataFrame, kind: str, column: str = "payload") -> DataFrame:
    """Add `unknown`, an array of (field, item, value) with the fields of the payload that its layout lacks.

    A field of the objects in an array is called `array[].field`, and `item` is the position of its object. The array is
    empty if the layout knows all fields, and NULL for text that is no JSON object; a payload that names a field twice
    counts as none.
    """
    known = list(known_fields(kind))
    found = _fields(F.try_parse_json(F.col(f"`{column}`")), kind)
    return df.withColumn("unknown", F.filter(found, lambda e: ~e["field"].isin(known)))


def report(df: DataFrame, kind: str, time: str = "ingestion_date", column: str = "payload") -> DataFrame:
    """One row a field: status, times it was given and missing, the type that holds all values, first and last time seen.

    The status is `unknown` for a field that the layout lacks, `retyped` for one with values that its column can't read,
    `known` otherwise. Missing are the payloads, or array elements, that are objects without the field; it is counted
    for fields of the layout. Payloads that are no object are left out: rejects report them.
    """
    known = known_fields(kind)
    payload = F.try_parse_json(F.col(f"`{column}`"))
    found = df.select(F.col(f"`{time}`").alias("seen"), F.explode(_fields(payload, kind)).alias("f")).select("seen", "f.*")
    patterns = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    values = found.groupBy("field").agg(
        F.count(F.lit(1)).alias("given"),
        F.schema_of_variant_agg("value").alias("type"),
        F.min("seen").alias("first_seen"),
        F.max("seen").alias("last_seen"),
    )
    # How many objects there are that a field could be in.
    objects = df.select(payload.alias("payload")).filter(_object(F.col("payload")).isNotNull())
    parts = [F.struct(F.lit("").alias("part"), F.lit(1).alias("n"))]
    for name in sorted({k.split("[]")[0] for k in known if "[]." in k}):
        inside = F.filter(F.try_variant_get("payload", f"$.{name}", "array<variant>"), lambda v: _object(v).isNotNull())
        parts.append(F.struct(F.lit(f"{name}[]").alias("part"), F.coalesce(F.size(inside), F.lit(0)).alias("n")))
    sizes = objects.select(F.inline(F.array(*parts))).groupBy("part").agg(F.sum("n").alias("objects"))
    layout = F.array(*[F.struct(F.lit(k).alias("field"), F.lit(k.split(".")[0] if "[]." in k else "").alias("part")) for k in known])
    wanted = df.sparkSession.range(1).select(F.inline(layout)).join(sizes, "part", "left").select("field", "objects")
    joined = values.join(wanted, "field", "full_outer")
    status = (
        F.when(~F.col("field").isin(list(known)), "unknown")
        .when(F.col("type").isNotNull() & ~F.rlike("type", F.concat(F.lit("^("), patterns[F.col("field")], F.lit(")$"))), "retyped")
        .otherwise("known")
    )
    given = F.coalesce("given", F.lit(0))
    missing = F.when(F.col("field").isin(list(known)), F.coalesce("objects", F.lit(0)) - given)
    return joined.select("field", status.alias("status"), given.alias("given"), missing.alias("missing"), "type", "first_seen", "last_seen")
