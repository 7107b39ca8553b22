"""Queries over the driver tables, each with a DuckDB oracle where SQL can express it."""

from . import analysis, etl, families, forecasting, lookups, models, storage  # noqa: F401  (registers queries)
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
