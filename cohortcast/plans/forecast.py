"""Scoring (C9): model output -> cleaned students -> (slot apportionment) -> classes.

The arithmetic is column expressions; the slot family's apportionment is the
window-based ``shares.apportion``.  Models are MLlib pipelines (``plans.model``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Params
from ..functions.scalars import clamp_zero, clean_prediction, denormalise_growth, students_to_classes
from ..operators import shares


def with_classes(df: DataFrame) -> DataFrame:
    """CANT_CLASES_PREDICT from CANT_ALUMNOS_PREDICT, seats and PE."""
    return df.withColumn("CANT_CLASES_PREDICT",
                         students_to_classes("CANT_ALUMNOS_PREDICT", "VAC_ACAD_ESTANDAR", "PE"))


def students_from_prediction(df: DataFrame, prediction: str = "prediction", growth_target: bool = False,
                             base: str = "CANT_ALUMNOS_ANTERIOR", params: Params = DEFAULT) -> DataFrame:
    """X9 (+ X11): raw model output to whole students; growth targets are de-normalised on ``base`` first."""
    p = denormalise_growth(base, prediction) if growth_target else F.col(prediction)
    return df.withColumn("CANT_ALUMNOS_PREDICT", clean_prediction(p, params))


def score_first_level(scored: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """First-level family: students predicted per slot, then classes."""
    return with_classes(students_from_prediction(scored, params=params))


def score_course(scored: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Course family: growth months de-normalise on the predecessor total (X11), others are students."""
    growth = F.col("PERIODO_TARGET") % 100 == F.lit(1)
    growth = growth | (F.col("PERIODO_TARGET") % 100 == F.lit(3))
    p = F.when(growth, F.col("CANT_ALUMNOS_ANTERIOR") * (1 + F.col("prediction"))).otherwise(F.col("prediction"))
    return with_classes(scored.withColumn("CANT_ALUMNOS_PREDICT", clean_prediction(p, params)))


def score_slot(scored_shares: DataFrame, course_forecast: DataFrame) -> DataFrame:
    """Slot family: predicted shares clamped at 0, course forecast apportioned (W4), classes."""
    fac = scored_shares.withColumn("FAC_ALUMNOS_PREDICT", clamp_zero("prediction"))
    return with_classes(shares.apportion(fac, course_forecast))
