"""Check queries on the driver's tables, with their SQL equivalents."""

from checks import ingest, lookups, outbound, runs, stores, upserts  # noqa: F401
from checks.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
