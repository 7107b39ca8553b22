"""Roll-ups (A1-A7, O4).

Every roll-up is a ``groupBy().agg()`` so Spark aggregates partially on the map
side before the shuffle: a hot site or course collapses to one row per task
before any data moves, which is what keeps a key holding a third of the rows
from landing in one reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.dims import Dims
from . import enrich

CELL = ["PERIODO", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL"]
COURSE = ["PERIODO", "SEDE", "CURSO_ACTUAL"]


def platinum_rollup(classes: DataFrame, keys=CELL) -> DataFrame:
    """A1: one row per cell: classes = row count, students = sum; null keys dropped."""
    return (classes.dropna(subset=list(keys))
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("CANT_CLASES"),
                 F.sum("CANT_MATRICULADOS").cast("long").alias("CANT_ALUMNOS")))


def synthetic_rollup(synthetic: DataFrame, keys=CELL) -> DataFrame:
    """A2: planner rows summed per cell; null keys dropped."""
    return (synthetic.dropna(subset=list(keys))
            .groupBy(*keys)
            .agg(F.sum("CANT_CLASES").cast("long").alias("CANT_CLASES"),
                 F.sum("CANT_ALUMNOS").cast("long").alias("CANT_ALUMNOS")))


def union_rollup(facts: DataFrame, synthetic: DataFrame | None = None, keys=CELL) -> DataFrame:
    """A3 + O4: facts UNION ALL synthetic, summed per cell; null keys kept."""
    cols = list(keys) + ["CANT_CLASES", "CANT_ALUMNOS"]
    u = facts.select(*cols)
    if synthetic is not None:
        u = u.unionByName(synthetic.select(*cols))
    return u.groupBy(*keys).agg(F.sum("CANT_ALUMNOS").cast("long").alias("CANT_ALUMNOS"),
                                F.sum("CANT_CLASES").cast("long").alias("CANT_CLASES"))


def regular_facts(facts: DataFrame, synthetic: DataFrame | None, dims: Dims,
                  include_seasonal: bool = False) -> DataFrame:
    """A3 + J3 (+ F9): the union roll-up with course flags; seasonal courses dropped unless asked."""
    out = enrich.add_flags(union_rollup(facts, synthetic), dims)
    return out if include_seasonal else out.where(F.col("FLAG_ESTACIONAL") == 0)


def course_totals(cells: DataFrame, keys=COURSE) -> DataFrame:
    """Drop the slot, sum classes and students."""
    return cells.groupBy(*keys).agg(F.sum("CANT_CLASES").alias("CANT_CLASES"),
                                    F.sum("CANT_ALUMNOS").alias("CANT_ALUMNOS"))


def hours_span(df: DataFrame, keys, start: str, end: str) -> DataFrame:
    """A4 / A5: earliest start and latest end per key."""
    return df.groupBy(*keys).agg(F.min(start).alias("HORA_MIN"), F.max(end).alias("HORA_MAX"))
