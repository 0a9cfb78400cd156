"""Registered queries: every operator on the given tables, beside the SQL that yields the same rows."""

from carelake.catalog.registry import ORACLES, QUERIES

from carelake.catalog import (  # noqa: F401  (registration on import)
    checks, cleansing, history, loading, measures, operations, relational, shielding, streams,
)

__all__ = ["ORACLES", "QUERIES"]
