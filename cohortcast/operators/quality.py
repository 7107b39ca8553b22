"""Data-quality checks (Q1, Q2).

``require`` puts the not-null check inside the plan: the looked-up value is
wrapped in ``coalesce(value, raise_error(...))`` so the check runs inside the
same codegen stage as the join that produced it, with no extra job.
``missing_keys`` is the reporting form (the offending keys as a frame).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require(col: str, what: str | None = None, key: str | None = None) -> Column:
    """Q1 strict: the column itself, failing the task when a value is null.

    ``key`` names the lookup key of the row; the error message carries its value,
    and -- just as important -- the check then references a column of the row.
    When the lookup table is known to be empty the join becomes null literals;
    a check without any column reference could then be moved by the optimizer
    onto rows that an earlier filter removes.
    """
    msg = f"lookup failed: null {what or col}"
    if key is None:
        return F.coalesce(F.col(col), F.raise_error(F.lit(msg)))
    detail = F.concat(F.lit(f"{msg} for {key.strip('`')}="), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    return F.coalesce(F.col(col), F.raise_error(detail))


def require_columns(df: DataFrame, cols, what: str = "") -> DataFrame:
    """Q1 strict on several columns, keeping every other column as is."""
    cols = list(cols)
    return df.select(*[require(c, f"{c} {what}".strip()).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def missing_keys(df: DataFrame, value_col: str, report_cols) -> DataFrame:
    """Q1 report: distinct report columns of rows whose looked-up value is null."""
    return df.where(F.col(value_col).isNull()).select(*report_cols).distinct()


def duplicate_keys(dim: DataFrame, keys) -> DataFrame:
    """Q2: keys that occur more than once in a dimension (they would fan a join out)."""
    keys = list(keys)
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("N_ROWS")).where(F.col("N_ROWS") > 1)
