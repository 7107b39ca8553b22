"""Registry of driver-table queries and their DuckDB oracle SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | Callable[[], str] | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with optional oracle SQL."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from ..sources.driver import reset_base
            reset_base()                      # each query builds (and checkpoints) its own base once
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle() if callable(oracle) else oracle
        return fn
    return deco


# ---- SQL helpers for the oracles (DuckDB dialect) -------------------------

def ord_sql(p: str) -> str:
    return f"(({p}) // 100 * 12 + ({p}) % 100 - 1)"


def from_ord_sql(o: str) -> str:
    return f"CAST((({o}) // 12) * 100 + ({o}) % 12 + 1 AS INTEGER)"


def shift_sql(p: str, n: int | str) -> str:
    return from_ord_sql(f"{ord_sql(p)} - ({n})")


def months_sql(lo: int, hi: int, name: str = "PERIODO_TARGET") -> str:
    return (f"(SELECT {from_ord_sql('o')} AS {name} FROM "
            f"(SELECT CAST(range AS INTEGER) AS o FROM range({ord_sql(str(lo))}, {ord_sql(str(hi))} + 1)) r)")


def in_list(values) -> str:
    from ..sources.driver import _sql_lit
    return "(" + ", ".join(_sql_lit(v) for v in values) + ")"
