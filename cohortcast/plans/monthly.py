"""One model month end to end (C9, C10): fit each family, score the horizon, evaluate, decide.

Each family's model is fitted on the training months before the model month
under the model month's regime (F12, F13, M2); the horizon months are scored
with that model (its feature contract travels with it, so a growth-target
model is always de-normalised, whatever month it scores); the slot family
apportions the course family's forecast over its predicted shares (W4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Params
from ..functions.scalars import clamp_zero
from ..operators import clean, shares
from . import evaluate, forecast, model
from .continuing import FAMILY as COURSE
from .first_level import FAMILY as FIRST
from .slot import FAMILY as SLOT

GATED = (FIRST, SLOT)
KEYS = {FIRST: ["PERIODO_TARGET", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL"],
        COURSE: ["PERIODO_TARGET", "SEDE", "CURSO_ACTUAL"],
        SLOT: ["PERIODO_TARGET", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL"]}


def fit_family(features: DataFrame, family: str, model_period: int, params: Params = DEFAULT, **gbt):
    """Train on months before the model month (from the training start), regime of the model month."""
    spec = model.feature_spec(family, model_period, params)
    train = features.where((F.col("PERIODO_TARGET") < model_period)
                           & (F.col("PERIODO_TARGET") >= params.training_start_period))
    train = clean.seasonal_regime(train, model_period, params)
    return model.fit_layer(train, spec, **gbt), spec


def score_family(fitted, spec, features: DataFrame, family: str, months, params: Params = DEFAULT,
                 course_forecast: DataFrame | None = None) -> DataFrame:
    """Model output -> students (X9, X11) -> [slot: apportionment W4] -> classes."""
    test = features.where(F.col("PERIODO_TARGET").isin([int(m) for m in months]))
    scored = model.score(fitted, test, spec)
    if family == FIRST:
        return forecast.score_first_level(scored, params)
    if family == COURSE:
        growth = spec.target == "PCT_ALUMNOS"
        return forecast.with_classes(forecast.students_from_prediction(scored, growth_target=growth, params=params))
    if course_forecast is None:
        raise ValueError("the slot family needs the course family's forecast")
    fac = scored.withColumn("FAC_ALUMNOS_PREDICT", clamp_zero("prediction"))
    return forecast.with_classes(shares.apportion(fac, course_forecast))


def evaluate_family(predicted: DataFrame, targets: DataFrame, family: str, months,
                    params: Params = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Evaluation rows (J15) and the per-month metrics with the family's mean score and verdict."""
    keys = KEYS[family]
    tgt = targets.where(F.col("PERIODO_TARGET").isin([int(m) for m in months])).select(
        *keys, "CANT_CLASES", "CANT_ALUMNOS")
    cols = [c for c in (*keys, "IDX", "PE", "VAC_ACAD_ESTANDAR", "CANT_ALUMNOS_PREDICT", "CANT_CLASES_PREDICT")
            if c in predicted.columns]
    ev = evaluate.join_target(predicted.select(*cols), tgt, keys)
    per_month = evaluate.metrics(ev, ["PERIODO_TARGET"]).withColumn("TIPO", F.lit(family))
    mean = evaluate.mean_score(evaluate.monthly_scores(ev), (), months).withColumn("TIPO", F.lit(family))
    judged = evaluate.verdict(mean, params)
    if family not in GATED:                    # the course family is written and scored, never gated
        judged = judged.withColumn("verdict", F.lit(None).cast("string"))
    return ev, per_month.join(judged, "TIPO", "left")


def run_month(features: dict, targets: dict, model_period: int, months, params: Params = DEFAULT, **gbt) -> dict:
    """All three families for one model month; returns evaluation rows and metric/verdict frames."""
    out = {}
    preds = {}
    for family in (FIRST, COURSE, SLOT):
        fitted, spec = fit_family(features[family], family, model_period, params, **gbt)
        preds[family] = score_family(fitted, spec, features[family], family, months, params,
                                     course_forecast=preds.get(COURSE))
        out[family] = evaluate_family(preds[family], targets[family], family, months, params)
    return out
