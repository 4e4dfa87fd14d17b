"""Registered queries: the Spark side and the SQL that must give the same rows."""

from registry import bronze, gold, ingest, lifecycle, reports, rules, silver, streams, tables  # noqa: F401
from registry.core import QUERIES, TWINS, twin

# Statements are put together once every module has added its steps.
ORACLES = {name: twin(*parts) for name, parts in TWINS.items()}

__all__ = ["ORACLES", "QUERIES"]
