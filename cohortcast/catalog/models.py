"""Queries that fit, keep and judge models.

Predictions of boosted trees have no SQL counterpart; what SQL can say about them (which rows are scored, their actuals,
that a metric stays within a bound, that a reloaded model scores the same) is compared with an oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.periods import ahead_n, period_of_timestamp, shift
from ..operators import clean
from ..plans import continuing, first_level, model, monthly, slot
from ..session import cut_lineage
from ..sources import driver as drv
from .etl import _scratch
from .families import first_level_features_sql
from .forecasting import SK
from .registry import query, shift_sql

P = drv.PARAMS
#: Production settings: trees, and months that are forecast from the model month on.
ITERATIONS, HORIZON = 500, 5
LAST_SQL = "(SELECT MAX(CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER)) FROM lineitem)"


def model_month(spark, sf_dir) -> int:
    """The first of the last HORIZON months that hold facts."""
    last = drv.read(spark, sf_dir, "lineitem").agg(F.max(period_of_timestamp("l_shipdate"))).first()[0]
    return shift(last, HORIZON - 1)


def _first_level(spark, sf_dir):
    dm = drv.dims(spark)
    return cut_lineage(first_level.features(drv.regular(spark, sf_dir, dm), dm, drv.TARGET_RANGE, P))


def _training(f, month: int):
    train, _ = clean.time_split(f, month)
    return clean.seasonal_regime(train.where(F.col("PERIODO_TARGET") >= P.training_start_period), month, P)


@query("train_score", lambda: f"""
SELECT PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, CANT_ALUMNOS, TRUE AS SCORED, TRUE AS RMSE_BOUNDED
  FROM ({first_level_features_sql()}) q
 WHERE PERIODO_TARGET BETWEEN {shift_sql(LAST_SQL, HORIZON - 1)} AND {LAST_SQL}""")
def train_score(spark, sf_dir):
    """M1 + M2 + F12 + F13: 500 trees fitted on the first-level months before the model month, five months scored; each scored row
    with its actual, and whether the horizon's RMSE is at most twice that of the training mean."""
    month = model_month(spark, sf_dir)
    f = _first_level(spark, sf_dir)
    spec = model.feature_spec(first_level.FAMILY, month, P)
    train = _training(f, month)
    fitted = model.fit_layer(train, spec, max_iter=ITERATIONS)
    scored = model.score(fitted, f.where(F.col("PERIODO_TARGET").isin(ahead_n(month, HORIZON))), spec)
    naive = train.agg(F.avg("CANT_ALUMNOS")).first()[0]
    x = cut_lineage(scored.select(*SK, "CANT_ALUMNOS", "prediction", F.lit(naive).alias("naive")))
    rmse = [model.regression_metrics(x, c, "CANT_ALUMNOS").first()["rmse"] for c in ("prediction", "naive")]   # one row each
    return x.select(*SK, "CANT_ALUMNOS", F.col("prediction").isNotNull().alias("SCORED"),
                    F.lit(rmse[0] is not None and rmse[0] <= 2 * rmse[1]).alias("RMSE_BOUNDED"))


REGISTERED_TREES = 20


@query("model_registry", lambda: f"""
SELECT PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, TRUE AS SAME_BY_VERSION, TRUE AS SAME_BY_ALIAS
  FROM ({first_level_features_sql()}) q""")
def model_registry(spark, sf_dir):
    """M3: a model registered under a version and an alias, loaded by both names (digests checked); every feature row scored by
    the fitted and by the loaded models."""
    root, month = _scratch(spark), model_month(spark, sf_dir)
    f = _first_level(spark, sf_dir)
    spec = model.feature_spec(first_level.FAMILY, month, P)
    fitted = model.fit_layer(_training(f, month), spec, max_iter=REGISTERED_TREES)
    model.register(fitted, root, first_level.FAMILY, "v1", month, "champion")
    out = model.score(fitted, f, spec).select(*f.columns, F.col("prediction").alias("fitted"))
    for name, col in (("v1", "SAME_BY_VERSION"), ("champion", "SAME_BY_ALIAS")):
        scored = model.score(model.registered(root, first_level.FAMILY, name, month), out, spec)
        out = scored.select(*out.columns, F.col("prediction").eqNullSafe(F.col("fitted")).alias(col))
    return out.select(*SK, "SAME_BY_VERSION", "SAME_BY_ALIAS")


KEY_SQL = "concat_ws('|', PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, '7')"
BASELINE_SQL = "(CANT_ALUMNOS_LAG_01 + CANT_ALUMNOS_LAG_02 + CANT_ALUMNOS_LAG_03) / CAST(3 AS DOUBLE)"


def _split_sql() -> str:
    return f"""
WITH x AS (SELECT PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, CANT_ALUMNOS, {BASELINE_SQL} AS P,
                  substr(md5({KEY_SQL}), 1, 8) < '33333333' AS HOLDOUT FROM ({first_level_features_sql()}) q),
m AS (SELECT HOLDOUT, COUNT(*) AS n, sqrt(AVG((CANT_ALUMNOS - P) * (CANT_ALUMNOS - P))) AS rmse, AVG(abs(CANT_ALUMNOS - P)) AS mae,
             1 - AVG((CANT_ALUMNOS - P) * (CANT_ALUMNOS - P)) / var_pop(CANT_ALUMNOS) AS r2 FROM x GROUP BY HOLDOUT)
SELECT x.PERIODO_TARGET, x.SEDE, x.CURSO_ACTUAL, x.HORARIO_ACTUAL, x.HOLDOUT, m.n, round(m.rmse, 6) AS rmse, round(m.mae, 6) AS mae,
       round(m.r2, 6) AS r2 FROM x JOIN m ON m.HOLDOUT = x.HOLDOUT"""


@query("holdout_metrics", _split_sql)
def holdout_metrics(spark, sf_dir):
    """M4: every feature row's side of the hold-out split, with that side's RMSE, MAE and R2 of the mean of three lags."""
    f = _first_level(spark, sf_dir)
    mean = (F.col("CANT_ALUMNOS_LAG_01") + F.col("CANT_ALUMNOS_LAG_02") + F.col("CANT_ALUMNOS_LAG_03")) / F.lit(3.0)
    x = model.with_holdout(f, SK).withColumn("P", mean)
    m = model.regression_metrics(x, "P", "CANT_ALUMNOS", ["HOLDOUT"])
    return x.select(*SK, "HOLDOUT").join(F.broadcast(m), "HOLDOUT").select(
        *SK, "HOLDOUT", "n", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")])


#: Trees of each of the three families of ``forecast_evaluate`` (500 in production: some 200 s a family on eight cores).
EVALUATE_TREES = 50


@query("forecast_evaluate")
def forecast_evaluate(spark, sf_dir):
    """C9 + C10 with fitted models: every family trained for one model month, horizon scored (slot family
    apportioned from the course forecast), evaluated per month with the family's verdict."""
    month = model_month(spark, sf_dir)
    dm = drv.dims(spark)
    full = drv.regular(spark, sf_dir, dm, include_seasonal=True)
    reg = full.where(F.col("FLAG_ESTACIONAL") == 0)
    feats = {first_level.FAMILY: cut_lineage(first_level.features(reg, dm, drv.TARGET_RANGE, P)),
             continuing.FAMILY: cut_lineage(continuing.features(full, dm, drv.TARGET_RANGE, P)),
             slot.FAMILY: cut_lineage(slot.features(full, dm, drv.TARGET_RANGE, P))}
    targets = {first_level.FAMILY: first_level.targets(reg, drv.TARGET_RANGE, P),
               continuing.FAMILY: continuing.targets(full, P),
               slot.FAMILY: slot.targets(full, P)}
    res = monthly.run_month(feats, targets, month, ahead_n(month, HORIZON), P, max_iter=EVALUATE_TREES)
    frames = [res[f][1] for f in (first_level.FAMILY, continuing.FAMILY, slot.FAMILY)]
    out = frames[0]
    for fr in frames[1:]:
        out = out.unionByName(fr)
    return out
