"""Repeatable keys made from business columns, so that a re-run gives the same ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stands for NULL inside a key. Plain `concat_ws` would drop the part and let keys collide.
NULL_PART = "<null>"


def joined_key(*parts: Column) -> Column:
    """Parts joined by an underscore, NULL parts kept visible."""
    return F.concat_ws("_", *[F.coalesce(part.cast("string"), F.lit(NULL_PART)) for part in parts])


def hashed_key(*parts: Column) -> Column:
    """SHA-256 of `joined_key`."""
    return F.sha2(joined_key(*parts), 256)


def period_key(period: Column, production_type: Column, country: Column, underscored: bool = False) -> Column:
    """Business key of a capacity row; optionally with the spaces of the type replaced."""
    name = F.replace(production_type, F.lit(" "), F.lit("_")) if underscored else production_type
    return joined_key(period, name, country)


def uuid_shaped(text: Column) -> Column:
    """MD5 of `text` in UUID layout, version digit 4 and variant digit a."""
    return F.regexp_replace(
        F.md5(text), r"^(.{8})(.{4})(.{3}).(.{3}).(.{12})$", "$1-$2-4$3-a$4-$5"
    )
