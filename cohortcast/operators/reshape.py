"""Reshaping (R1-R3, A12): unpivot and pivot with the built-in operators."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import month_key, slot_end_hours, slot_start_hours
from .rollup import hours_span


def unpivot_turns(raw_slots: DataFrame, turns=("TURNO_1", "TURNO_2", "TURNO_3", "TURNO_4")) -> DataFrame:
    """TURNO_1..4 -> (N_TURNO, FRANJA), null turns dropped."""
    return (raw_slots.unpivot(["HORARIO"], list(turns), "N_TURNO", "FRANJA")
                     .where(F.col("FRANJA").isNotNull()))


def slot_hours(raw_slots: DataFrame) -> DataFrame:
    """R1 + X1 + A4: earliest start / latest end per raw slot, joined back to the sheet."""
    turns = unpivot_turns(raw_slots).select("HORARIO", slot_start_hours("FRANJA").alias("HORA_INICIO"),
                                            slot_end_hours("FRANJA").alias("HORA_FIN"))
    return raw_slots.join(hours_span(turns, ["HORARIO"], "HORA_INICIO", "HORA_FIN"), "HORARIO", "left")


def month_columns(columns) -> list[str]:
    """R2: every column whose name contains a digit."""
    return [c for c in columns if re.search(r"\d", c)]


def site_hours(raw: DataFrame, ids=("SEDE", "PERIODO_FRANJA", "FRANJA", "YEAR")) -> DataFrame:
    """R2 + F4 + X2 + X1 + A5: month flags unpivoted, unavailable dropped, hours per (month, site)."""
    months = month_columns(raw.columns)
    long = raw.unpivot(list(ids), [f"`{m}`" for m in months], "MONTH", "FLAG_DISPONIBLE")
    long = long.where(~F.col("FLAG_DISPONIBLE").eqNullSafe(0))
    long = long.select(month_key("YEAR", "MONTH").alias("PERIODO"), "SEDE",
                       slot_start_hours("FRANJA").alias("HORA_INICIAL"), slot_end_hours("FRANJA").alias("HORA_FINAL"))
    return hours_span(long, ["PERIODO", "SEDE"], "HORA_INICIAL", "HORA_FINAL")


def pivot_sum(df: DataFrame, rows, pivot_col: str, values: list, value_col: str) -> DataFrame:
    """Sum of ``value_col`` per ``rows`` x ``pivot_col`` (explicit pivot values), missing -> 0."""
    out = df.groupBy(*rows).pivot(pivot_col, values).agg(F.sum(value_col))
    return out.fillna(0, subset=[str(v) for v in values])
