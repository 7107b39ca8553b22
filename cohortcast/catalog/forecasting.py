"""Scoring, apportionment, evaluation and comparison over the driver tables.

Forecasts here come from transparent baselines computed from the features
(persistence of the predecessor total, lag averages, last year's shares), so
every step after the model -- clean-up, apportionment, classes, metrics,
verdicts -- has an SQL oracle.  MLlib model fitting is ``train_score``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import clean_prediction, students_to_classes
from ..operators import clean, shares
from ..plans import continuing, evaluate, first_level, forecast, slot
from ..sources import driver as drv
from .families import continuing_features_sql, first_level_features_sql, slot_features_sql
from .registry import query

P = drv.PARAMS
LO, HI = drv.TARGET_RANGE
CK = ["PERIODO_TARGET", "SEDE", "CURSO_ACTUAL"]
SK = CK + ["HORARIO_ACTUAL"]


# ---- Spark building blocks --------------------------------------------------

def _frames(spark, sf_dir, seasonal=True):
    dm = drv.dims(spark)
    return dm, drv.regular(spark, sf_dir, dm, include_seasonal=seasonal)


def course_forecast(cf: DataFrame) -> DataFrame:
    """Persistence baseline: next month's course students = predecessor students (X9 applied)."""
    return cf.select(*CK, "PE", "VAC_ACAD_ESTANDAR", "IDX",
                     clean_prediction("CANT_ALUMNOS_ANTERIOR", P).alias("CANT_ALUMNOS_PREDICT"))


def slot_shares(sf: DataFrame, source: str = "FAC_ALUMNOS_ANTERIOR") -> DataFrame:
    """Share baseline for the slot family: the predecessor's (or last year's) slot share, clamped."""
    return sf.select(*SK, "IDX", "PE", "VAC_ACAD_ESTANDAR",
                     F.greatest(F.coalesce(F.col(source), F.lit(0.0)), F.lit(0.0)).alias("FAC_ALUMNOS_PREDICT"),
                     "CANT_ALUMNOS_ANTERIOR", "CANT_CLASES_ANTERIOR")


_FEATURES: dict = {}


def family_features(spark, sf_dir, family: str) -> DataFrame:
    """Feature layer of a family, materialised once per query (the scorer reads a written layer)."""
    from ..session import cut_lineage
    dm, full = _frames(spark, sf_dir)
    if _FEATURES.get("_base") is not full:        # a new query built a new base: forget old layers
        _FEATURES.clear()
        _FEATURES["_base"] = full
    key = family
    if key not in _FEATURES:
        if family == "continuing":
            f = continuing.features(full, dm, drv.TARGET_RANGE, P)
        elif family == "slot":
            f = slot.features(full, dm, drv.TARGET_RANGE, P, materialize=cut_lineage)
        else:
            f = first_level.features(full.where(F.col("FLAG_ESTACIONAL") == 0), dm, drv.TARGET_RANGE, P)
        _FEATURES[key] = cut_lineage(f)
    return _FEATURES[key]


def slot_forecast_all(spark, sf_dir, source: str = "FAC_ALUMNOS_ANTERIOR") -> DataFrame:
    """Slot forecast, with courses that have no slots as one row without a slot (the data hold a few at small scale)."""
    cf = family_features(spark, sf_dir, "continuing")
    sf = family_features(spark, sf_dir, "slot")
    return forecast.with_classes(shares.apportion(slot_shares(sf, source), course_forecast(cf), missing="report"))


def slot_forecast(spark, sf_dir, source: str = "FAC_ALUMNOS_ANTERIOR") -> DataFrame:
    return slot_forecast_all(spark, sf_dir, source).where("HORARIO_ACTUAL IS NOT NULL")


def slot_targets_in_range(spark, sf_dir) -> DataFrame:
    _dm, full = _frames(spark, sf_dir)
    return (slot.targets(full, P).where(F.col("PERIODO_TARGET").between(LO, HI))
                .select(*SK, "CANT_CLASES", "CANT_ALUMNOS"))


def first_level_forecast(spark, sf_dir, version: str = "v1") -> DataFrame:
    f = family_features(spark, sf_dir, "first")
    raw = F.col("CANT_ALUMNOS_LAG_01") if version == "v1" else (
        (F.col("CANT_ALUMNOS_LAG_01") + F.col("CANT_ALUMNOS_LAG_02") + F.col("CANT_ALUMNOS_LAG_03")) / 3)
    out = f.select(*SK, "IDX", "PE", "VAC_ACAD_ESTANDAR", clean_prediction(raw, P).alias("CANT_ALUMNOS_PREDICT"))
    return forecast.with_classes(out)


def first_level_targets_in_range(spark, sf_dir) -> DataFrame:
    _dm, reg = _frames(spark, sf_dir, seasonal=False)
    return first_level.targets(reg, drv.TARGET_RANGE, P)


# ---- SQL building blocks ------------------------------------------------------

def clean_sql(p: str) -> str:
    g = f"greatest(CAST({p} AS DOUBLE), 0.0)"
    return f"(floor({g}) + CASE WHEN {g} % 1 >= {P.round_up_fraction} THEN 1.0 ELSE 0.0 END)"


def classes_sql(s: str, v: str, pe: str) -> str:
    full = f"floor(({s}) / ({v}))"
    return (f"(CASE WHEN ({s}) > 0 THEN {full} + CASE WHEN ({s}) - {full} * ({v}) >= ({pe}) THEN 1.0 ELSE 0.0 END "
            f"ELSE 0.0 END)")


TIEBREAK_SQL = ("CANT_ALUMNOS_PREDICT DESC NULLS LAST, FAC_ALUMNOS_PREDICT DESC NULLS LAST, "
                "CANT_ALUMNOS_ANTERIOR DESC NULLS LAST, CANT_CLASES_ANTERIOR DESC NULLS LAST, PE DESC NULLS LAST, "
                "VAC_ACAD_ESTANDAR DESC NULLS LAST, IDX DESC NULLS LAST")
G = "PARTITION BY PERIODO_TARGET, SEDE, CURSO_ACTUAL"


def apportion_ctes(cant: str, fac: str, sfx: str = "") -> str:
    """W4 in SQL over CTEs ``cant`` (course forecast) and ``fac`` (slot shares); result CTE ``appo{sfx}``."""
    return f"""
j{sfx} AS (
  SELECT c.PERIODO_TARGET, c.SEDE, c.CURSO_ACTUAL, c.CANT_ALUMNOS_PREDICT, f.HORARIO_ACTUAL, f.IDX, f.PE,
         f.VAC_ACAD_ESTANDAR, f.FAC_ALUMNOS_PREDICT AS FAC0, f.CANT_ALUMNOS_ANTERIOR, f.CANT_CLASES_ANTERIOR
    FROM {cant} c LEFT JOIN {fac} f ON f.PERIODO_TARGET = c.PERIODO_TARGET AND f.SEDE = c.SEDE
                                   AND f.CURSO_ACTUAL = c.CURSO_ACTUAL
   WHERE c.CANT_ALUMNOS_PREDICT >= c.PE),
w1{sfx} AS (SELECT *, CASE WHEN SUM(FAC0) OVER ({G}) = 0 THEN 1.0 ELSE FAC0 END AS FAC_ALUMNOS_PREDICT FROM j{sfx}),
w2{sfx} AS (SELECT *, CANT_ALUMNOS_PREDICT * (FAC_ALUMNOS_PREDICT / SUM(FAC_ALUMNOS_PREDICT) OVER ({G})) AS AMT FROM w1{sfx}),
w3{sfx} AS (SELECT *, floor(AMT) AS Q, AMT - floor(AMT) AS R FROM w2{sfx}),
w4{sfx} AS (SELECT *, round_even(SUM(R) OVER ({G}), 0) AS K,
              ROW_NUMBER() OVER ({G} ORDER BY round(R, 9) DESC NULLS LAST, HORARIO_ACTUAL DESC NULLS LAST, {TIEBREAK_SQL}) AS RNK
         FROM w3{sfx}),
w5{sfx} AS (SELECT *, CASE WHEN HORARIO_ACTUAL IS NULL THEN CANT_ALUMNOS_PREDICT
                       ELSE Q + CASE WHEN RNK <= K THEN 1.0 ELSE 0.0 END END AS CANT FROM w4{sfx}),
v1{sfx} AS (SELECT *, COUNT(*) OVER ({G}) AS N,
              SUM(CASE WHEN CANT < PE THEN CANT ELSE 0.0 END) OVER ({G}) AS LT_TOTAL,
              SUM(CASE WHEN CANT >= PE THEN CANT ELSE 0.0 END) OVER ({G}) AS GT_TOTAL FROM w5{sfx}),
v2{sfx} AS (SELECT *, (N > 1 AND LT_TOTAL <> 0) AS ELIG,
              CASE WHEN GT_TOTAL <> 0 THEN CANT / GT_TOTAL END * LT_TOTAL AS AMT2
         FROM v1{sfx} WHERE N = 1 OR CANT >= PE),
v3{sfx} AS (SELECT *, CASE WHEN ELIG THEN floor(AMT2) END AS Q2, CASE WHEN ELIG THEN AMT2 - floor(AMT2) END AS R2 FROM v2{sfx}),
v4{sfx} AS (SELECT *, round_even(SUM(R2) OVER ({G}), 0) AS K2,
              ROW_NUMBER() OVER ({G} ORDER BY ELIG DESC, round(R2, 9) DESC NULLS LAST, HORARIO_ACTUAL DESC NULLS LAST,
                                 {TIEBREAK_SQL}) AS RNK2
         FROM v3{sfx}),
appo{sfx} AS (
  SELECT PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, IDX, PE, VAC_ACAD_ESTANDAR, FAC_ALUMNOS_PREDICT,
         CANT_ALUMNOS_ANTERIOR, CANT_CLASES_ANTERIOR,
         CANT + CASE WHEN ELIG THEN Q2 + CASE WHEN RNK2 <= K2 THEN 1.0 ELSE 0.0 END ELSE 0.0 END
           AS CANT_ALUMNOS_PREDICT
    FROM v4{sfx})"""


def slot_forecast_ctes(source: str = "FAC_ALUMNOS_ANTERIOR", prefix: str = "") -> str:
    """CTEs cf, sf, cant, fac, j.., appo and ``{prefix}fc`` (slot forecast with classes)."""
    return f"""
cf AS (SELECT * FROM ({continuing_features_sql()}) q),
sf AS (SELECT * FROM ({slot_features_sql()}) q),
cant AS (SELECT PERIODO_TARGET, SEDE, CURSO_ACTUAL, PE, {clean_sql('CANT_ALUMNOS_ANTERIOR')} AS CANT_ALUMNOS_PREDICT
           FROM cf),
fac AS (SELECT PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, IDX, PE, VAC_ACAD_ESTANDAR,
               greatest(COALESCE({source}, 0.0), 0.0) AS FAC_ALUMNOS_PREDICT, CANT_ALUMNOS_ANTERIOR,
               CANT_CLASES_ANTERIOR FROM sf),
{apportion_ctes('cant', 'fac')},
{prefix}fc_all AS (SELECT *, {classes_sql('CANT_ALUMNOS_PREDICT', 'VAC_ACAD_ESTANDAR', 'PE')} AS CANT_CLASES_PREDICT
         FROM appo),
{prefix}fc AS (SELECT * FROM {prefix}fc_all WHERE HORARIO_ACTUAL IS NOT NULL)"""


def slot_targets_sql() -> str:
    from .families import _dims_sql, _not_blackout
    return f"""(WITH {_dims_sql()}, full_ AS MATERIALIZED {drv.regular_sql(include_seasonal=True)}
  SELECT PERIODO AS PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, CAST(CANT_CLASES AS BIGINT) AS CANT_CLASES,
         CAST(CANT_ALUMNOS AS BIGINT) AS CANT_ALUMNOS
    FROM full_ r WHERE FLAG_ESTACIONAL = 0 AND FLAG_INICIAL = 0 AND PERIODO BETWEEN {LO} AND {HI}
     AND {_not_blackout('r', slot.FAMILY, 'target', 'PERIODO')})"""


def first_level_targets_sql() -> str:
    from .families import _dims_sql, _not_blackout
    return f"""(WITH {_dims_sql()}, reg AS MATERIALIZED {drv.regular_sql()}
  SELECT PERIODO AS PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, CAST(CANT_CLASES AS BIGINT) AS CANT_CLASES,
         CAST(CANT_ALUMNOS AS BIGINT) AS CANT_ALUMNOS
    FROM reg r WHERE FLAG_INICIAL = 1 AND PERIODO BETWEEN {LO} AND {HI}
     AND {_not_blackout('r', first_level.FAMILY, 'target', 'PERIODO')})"""


def join_target_sql(fc: str, tgt: str) -> str:
    return f"""
  SELECT COALESCE(f.PERIODO_TARGET, t.PERIODO_TARGET) AS PERIODO_TARGET, COALESCE(f.SEDE, t.SEDE) AS SEDE,
         COALESCE(f.CURSO_ACTUAL, t.CURSO_ACTUAL) AS CURSO_ACTUAL,
         COALESCE(f.HORARIO_ACTUAL, t.HORARIO_ACTUAL) AS HORARIO_ACTUAL,
         CAST(COALESCE(f.IDX, 0) AS INTEGER) AS IDX, f.PE, f.VAC_ACAD_ESTANDAR,
         CAST(COALESCE(f.CANT_ALUMNOS_PREDICT, 0) AS DOUBLE) AS CANT_ALUMNOS_PREDICT,
         CAST(COALESCE(f.CANT_CLASES_PREDICT, 0) AS DOUBLE) AS CANT_CLASES_PREDICT,
         CAST(COALESCE(t.CANT_CLASES, 0) AS INTEGER) AS CANT_CLASES,
         CAST(COALESCE(t.CANT_ALUMNOS, 0) AS INTEGER) AS CANT_ALUMNOS
    FROM {fc} f FULL OUTER JOIN {tgt} t
      ON f.PERIODO_TARGET = t.PERIODO_TARGET AND f.SEDE = t.SEDE AND f.CURSO_ACTUAL = t.CURSO_ACTUAL
     AND f.HORARIO_ACTUAL = t.HORARIO_ACTUAL"""


EVAL_COLUMNS = SK + ["IDX", "PE", "VAC_ACAD_ESTANDAR", "CANT_ALUMNOS_PREDICT", "CANT_CLASES_PREDICT",
                     "CANT_CLASES", "CANT_ALUMNOS"]


# ---- queries ----------------------------------------------------------------

def _apportion_full_sql() -> str:
    return "WITH " + slot_forecast_ctes().lstrip() + "\nSELECT * FROM fc_all"


@query("apportion_full", _apportion_full_sql)
def apportion_full(spark, sf_dir):
    """W4 (F14, J14, W1, W2, W3) + X10: course forecasts apportioned to slots, then classes; a course without slots is
    one row with no slot that holds its students."""
    return slot_forecast_all(spark, sf_dir)


def _apportion_basic_sql() -> str:
    return f"""
WITH sf AS (SELECT * FROM ({slot_features_sql()}) q),
x AS (SELECT PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, FAC_ALUMNOS_LAG_12 AS FAC0,
             CAST(SUM(CANT_ALUMNOS) OVER ({G}) AS DOUBLE) AS TOTAL FROM sf),
w1 AS (SELECT *, CASE WHEN SUM(FAC0) OVER ({G}) = 0 THEN 1.0 ELSE FAC0 END AS FAC_ALUMNOS_PREDICT FROM x),
w2 AS (SELECT *, TOTAL * (FAC_ALUMNOS_PREDICT / SUM(FAC_ALUMNOS_PREDICT) OVER ({G})) AS AMT FROM w1),
w3 AS (SELECT *, floor(AMT) AS Q, AMT - floor(AMT) AS R FROM w2),
w4 AS (SELECT *, round_even(SUM(R) OVER ({G}), 0) AS K,
              ROW_NUMBER() OVER ({G} ORDER BY round(R, 9) DESC NULLS LAST, HORARIO_ACTUAL DESC NULLS LAST,
                                 FAC_ALUMNOS_PREDICT DESC NULLS LAST) AS RNK FROM w3)
SELECT PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, TOTAL, FAC_ALUMNOS_PREDICT,
       Q + CASE WHEN RNK <= K THEN 1.0 ELSE 0.0 END AS CANT_ALUMNOS FROM w4"""


@query("apportion_basic", _apportion_basic_sql)
def apportion_basic(spark, sf_dir):
    """W1 + W2 + O1: each course's actual students split over its slots by last year's shares."""
    dm, full = _frames(spark, sf_dir)
    sf = slot.features(full, dm, drv.TARGET_RANGE, P)
    x = sf.select(*SK, F.col("FAC_ALUMNOS_LAG_12").alias("FAC_ALUMNOS_PREDICT"),
                  F.sum("CANT_ALUMNOS").over(Window.partitionBy(*CK)).cast("double").alias("TOTAL"))
    return shares.apportion_basic(x, total="TOTAL").select(*SK, "TOTAL", "FAC_ALUMNOS_PREDICT", "CANT_ALUMNOS")


def _outer_join_sql() -> str:
    return "WITH " + slot_forecast_ctes().lstrip() + f""",
tgt AS {slot_targets_sql()}
{join_target_sql('fc', 'tgt')}"""


def slot_evaluation(spark, sf_dir, source: str = "FAC_ALUMNOS_ANTERIOR") -> DataFrame:
    fc = slot_forecast(spark, sf_dir, source).select(*SK, "IDX", "PE", "VAC_ACAD_ESTANDAR",
                                                     "CANT_ALUMNOS_PREDICT", "CANT_CLASES_PREDICT")
    return evaluate.join_target(fc, slot_targets_in_range(spark, sf_dir), SK).select(*EVAL_COLUMNS)


@query("outer_join_target", _outer_join_sql)
def outer_join_target(spark, sf_dir):
    """Slot forecast full-outer-joined with slot actuals, missing sides filled."""
    return slot_evaluation(spark, sf_dir)


METRIC_SQL = """
  SELECT AVG(CASE WHEN CANT_CLASES > 0 THEN CAST(IDX AS DOUBLE) END) AS pct_comb,
         CAST(SUM(CASE WHEN CANT_CLASES > 0 THEN IDX END) AS BIGINT) AS total_comb,
         SUM(CASE WHEN NOT (CANT_CLASES_PREDICT = 0 AND CANT_CLASES = 0)
                  THEN greatest(CANT_CLASES - CANT_CLASES_PREDICT, 0.0) END) AS faltante,
         SUM(CASE WHEN NOT (CANT_CLASES_PREDICT = 0 AND CANT_CLASES = 0)
                  THEN greatest(CANT_CLASES_PREDICT - CANT_CLASES, 0.0) END) AS sobrante,
         AVG(CASE WHEN NOT (CANT_CLASES_PREDICT = 0 AND CANT_CLASES = 0)
                  THEN CASE WHEN CANT_CLASES = CANT_CLASES_PREDICT THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END END) AS precision,
         CAST(SUM(CASE WHEN NOT (CANT_CLASES_PREDICT = 0 AND CANT_CLASES = 0) THEN CANT_CLASES END) AS BIGINT)
           AS total_clases,
         CAST(SUM(CASE WHEN NOT (CANT_CLASES_PREDICT = 0 AND CANT_CLASES = 0) THEN CANT_ALUMNOS END) AS BIGINT)
           AS total_alumnos,
         SUM(CASE WHEN NOT (CANT_CLASES_PREDICT = 0 AND CANT_CLASES = 0) THEN CANT_ALUMNOS_PREDICT END)
           AS total_alumnos_predict
    FROM ev"""


def _metrics_sql() -> str:
    return "WITH " + slot_forecast_ctes().lstrip() + f""",
tgt AS {slot_targets_sql()},
ev AS ({join_target_sql('fc', 'tgt')}),
m AS ({METRIC_SQL})
SELECT round(pct_comb, 6) AS pct_comb, total_comb, faltante, sobrante, round(precision, 6) AS precision,
       total_clases, total_alumnos, total_alumnos_predict FROM m"""


@query("metrics_one_row", _metrics_sql)
def metrics_one_row(spark, sf_dir):
    """A9 + F15 + F16 + X12: the eight forecast metrics of the slot family over every target month."""
    m = evaluate.metrics(slot_evaluation(spark, sf_dir))
    return m.withColumn("pct_comb", F.round("pct_comb", 6)).withColumn("precision", F.round("precision", 6))


SCORE_SQL = """
  SELECT PERIODO_TARGET,
         AVG(CASE WHEN CANT_CLASES = CANT_CLASES_PREDICT THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS score
    FROM {ev} WHERE NOT (CANT_CLASES_PREDICT = 0 AND CANT_CLASES = 0) GROUP BY PERIODO_TARGET"""


def _monthly_sql() -> str:
    return "WITH " + slot_forecast_ctes().lstrip() + f""",
tgt AS {slot_targets_sql()},
ev AS ({join_target_sql('fc', 'tgt')}),
ms AS ({SCORE_SQL.format(ev='ev')})
SELECT PERIODO_TARGET, round(score, 6) AS score, round(AVG(score) OVER (), 6) AS mean_score FROM ms"""


@query("monthly_mean_score", _monthly_sql)
def monthly_mean_score(spark, sf_dir):
    """A10 + A11: exact-match score per month and its unweighted mean over months."""
    ms = evaluate.monthly_scores(slot_evaluation(spark, sf_dir))
    # one row per month: the mean is a window over a horizon-sized frame
    out = ms.withColumn("mean_score", F.avg("score").over(Window.partitionBy(F.lit(1))))
    return out.select("PERIODO_TARGET", F.round("score", 6).alias("score"), F.round("mean_score", 6).alias("mean_score"))


def _verdict_sql() -> str:
    th = dict(P.thresholds)
    fl = f"""
fl_base AS (SELECT * FROM ({first_level_features_sql()}) q),
fl_tgt AS {first_level_targets_sql()},
fl_fc1 AS (SELECT PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, IDX, PE, VAC_ACAD_ESTANDAR,
                  {clean_sql('CANT_ALUMNOS_LAG_01')} AS CANT_ALUMNOS_PREDICT FROM fl_base),
fl_fc2 AS (SELECT PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, IDX, PE, VAC_ACAD_ESTANDAR,
                  {clean_sql('(CANT_ALUMNOS_LAG_01 + CANT_ALUMNOS_LAG_02 + CANT_ALUMNOS_LAG_03) / 3')}
                    AS CANT_ALUMNOS_PREDICT FROM fl_base),
fl_c1 AS (SELECT *, {classes_sql('CANT_ALUMNOS_PREDICT', 'VAC_ACAD_ESTANDAR', 'PE')} AS CANT_CLASES_PREDICT FROM fl_fc1),
fl_c2 AS (SELECT *, {classes_sql('CANT_ALUMNOS_PREDICT', 'VAC_ACAD_ESTANDAR', 'PE')} AS CANT_CLASES_PREDICT FROM fl_fc2),
fl_ev1 AS ({join_target_sql('fl_c1', 'fl_tgt')}),
fl_ev2 AS ({join_target_sql('fl_c2', 'fl_tgt')}),"""
    sl = slot_forecast_ctes().lstrip() + """,
fac2 AS (SELECT PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, IDX, PE, VAC_ACAD_ESTANDAR,
                greatest(COALESCE(FAC_ALUMNOS_LAG_12, 0.0), 0.0) AS FAC_ALUMNOS_PREDICT, CANT_ALUMNOS_ANTERIOR,
                CANT_CLASES_ANTERIOR FROM sf),""" + apportion_ctes("cant", "fac2", "_2") + f""",
fc2 AS (SELECT *, {classes_sql('CANT_ALUMNOS_PREDICT', 'VAC_ACAD_ESTANDAR', 'PE')} AS CANT_CLASES_PREDICT FROM appo_2
         WHERE HORARIO_ACTUAL IS NOT NULL),
sl_tgt AS {slot_targets_sql()},
sl_ev1 AS ({join_target_sql('fc', 'sl_tgt')}),
sl_ev2 AS ({join_target_sql('fc2', 'sl_tgt')}),"""
    scores = " UNION ALL ".join(
        f"SELECT '{fam}' AS TIPO, '{ver}' AS VERSION, AVG(score) AS score FROM ({SCORE_SQL.format(ev=ev)}) s"
        for fam, ver, ev in (("inicial_regular", "v1", "fl_ev1"), ("inicial_regular", "v2", "fl_ev2"),
                             ("continuidad_regular_horario", "v1", "sl_ev1"),
                             ("continuidad_regular_horario", "v2", "sl_ev2")))
    return f"""
WITH {fl}
{sl}
means AS ({scores}),
fams AS (SELECT * FROM (VALUES ('inicial_regular', {th['inicial_regular']}),
                               ('continuidad_regular_horario', {th['continuidad_regular_horario']})) v(TIPO, threshold)),
rows_ AS (
  SELECT f.TIPO, f.threshold,
         COALESCE(MAX(CASE WHEN m.VERSION = 'v1' THEN m.score END), 0.0) AS champion_score,
         COALESCE(MAX(CASE WHEN m.VERSION = 'v2' THEN m.score END), 0.0) AS challenger_score
    FROM fams f LEFT JOIN means m ON m.TIPO = f.TIPO GROUP BY f.TIPO, f.threshold)
SELECT TIPO, CAST(threshold AS DOUBLE) AS threshold, round(champion_score, 6) AS champion_score,
       round(challenger_score, 6) AS challenger_score,
       CASE WHEN champion_score >= threshold THEN 'approved' ELSE 'rejected' END AS champion_verdict,
       challenger_score > champion_score AS better,
       CASE WHEN MIN(CASE WHEN challenger_score > champion_score THEN 1 ELSE 0 END) OVER () = 1
            THEN 'approved' ELSE 'rejected' END AS verdict
  FROM rows_"""


@query("verdict_compare", _verdict_sql)
def verdict_compare(spark, sf_dir):
    """C10 + C11 + S13 frame: two baseline versions per family, threshold gate and champion/challenger rule."""
    fam_i, fam_s = first_level.FAMILY, slot.FAMILY
    fl_t = first_level_targets_in_range(spark, sf_dir)
    parts = []
    for ver in ("v1", "v2"):
        ev = evaluate.join_target(first_level_forecast(spark, sf_dir, ver), fl_t, SK)
        parts.append(evaluate.monthly_scores(ev).withColumn("TIPO", F.lit(fam_i)).withColumn("VERSION", F.lit(ver)))
    for ver, src in (("v1", "FAC_ALUMNOS_ANTERIOR"), ("v2", "FAC_ALUMNOS_LAG_12")):
        parts.append(evaluate.monthly_scores(slot_evaluation(spark, sf_dir, src))
                     .withColumn("TIPO", F.lit(fam_s)).withColumn("VERSION", F.lit(ver)))
    scores = parts[0]
    for p in parts[1:]:
        scores = scores.unionByName(p)
    means = evaluate.mean_score(scores, ("TIPO", "VERSION"))
    cmp_ = evaluate.compare(means, "v1", "v2", (fam_i, fam_s))
    champ = evaluate.verdict(means.where(F.col("VERSION") == "v1").drop("VERSION"), P).select(
        "TIPO", "threshold", F.col("verdict").alias("champion_verdict"))
    return (cmp_.join(champ, "TIPO", "left")
                .withColumn("champion_verdict", F.when(F.col("champion_score") >= F.col("threshold"), "approved")
                            .otherwise("rejected"))
                .select("TIPO", "threshold", F.round("champion_score", 6).alias("champion_score"),
                        F.round("challenger_score", 6).alias("challenger_score"), "champion_verdict",
                        "better", "verdict"))


# ---- scalar rules on data ------------------------------------------------------

def _cleanup_sql() -> str:
    return f"""
WITH cf AS (SELECT * FROM ({continuing_features_sql()}) q)
SELECT PERIODO_TARGET, SEDE, CURSO_ACTUAL, PE_ANTERIOR, CANT_ALUMNOS_ANTERIOR, PCT_ALUMNOS_SPLY,
       CASE WHEN PERIODO_TARGET % 100 IN (1, 3)
            THEN {clean_sql('CANT_ALUMNOS_ANTERIOR * (1 + PCT_ALUMNOS_SPLY)')}
            ELSE {clean_sql('CANT_ALUMNOS_LAG_12 * 0.9 - 3')} END AS CANT_ALUMNOS_PREDICT,
       {classes_sql(f"CASE WHEN PERIODO_TARGET % 100 IN (1, 3) THEN {clean_sql('CANT_ALUMNOS_ANTERIOR * (1 + PCT_ALUMNOS_SPLY)')} ELSE {clean_sql('CANT_ALUMNOS_LAG_12 * 0.9 - 3')} END", 'VAC_ACAD_ESTANDAR', 'PE')}
         AS CANT_CLASES_PREDICT
  FROM cf"""


@query("prediction_cleanup", _cleanup_sql)
def prediction_cleanup(spark, sf_dir):
    """X9 + X11 (+ X10): growth output de-normalised in months 1 and 3, clamped, rounded up at .4, classes."""
    dm, full = _frames(spark, sf_dir)
    cf = continuing.features(full, dm, drv.TARGET_RANGE, P)
    scored = cf.withColumn("prediction", F.when(F.col("PERIODO_TARGET") % 100 == 1, F.col("PCT_ALUMNOS_SPLY"))
                           .when(F.col("PERIODO_TARGET") % 100 == 3, F.col("PCT_ALUMNOS_SPLY"))
                           .otherwise(F.col("CANT_ALUMNOS_LAG_12") * 0.9 - 3))
    out = forecast.score_course(scored, P)
    return out.select(*CK, "PE_ANTERIOR", "CANT_ALUMNOS_ANTERIOR", "PCT_ALUMNOS_SPLY", "CANT_ALUMNOS_PREDICT",
                      "CANT_CLASES_PREDICT")


def _classes_sql() -> str:
    return f"""
WITH sf AS (SELECT * FROM ({slot_features_sql()}) q)
SELECT PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, PE_ANTERIOR, CANT_ALUMNOS, VAC_ACAD_ESTANDAR, PE,
       {classes_sql('CAST(CANT_ALUMNOS AS DOUBLE)', 'VAC_ACAD_ESTANDAR', 'PE')} AS CANT_CLASES_PREDICT
  FROM sf"""


@query("students_to_classes", _classes_sql)
def students_to_classes_q(spark, sf_dir):
    """X10 over every slot actual: classes needed for the students under the seats / break-even rule."""
    dm, full = _frames(spark, sf_dir)
    sf = slot.features(full, dm, drv.TARGET_RANGE, P)
    return sf.select(*SK, "PE_ANTERIOR", "CANT_ALUMNOS", "VAC_ACAD_ESTANDAR", "PE",
                     students_to_classes("CANT_ALUMNOS", "VAC_ACAD_ESTANDAR", "PE").alias("CANT_CLASES_PREDICT"))


def _publish_sql() -> str:
    return "WITH " + slot_forecast_ctes().lstrip() + """
SELECT PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, CANT_CLASES_PREDICT, CANT_ALUMNOS_PREDICT
  FROM fc WHERE CANT_CLASES_PREDICT > 0"""


@query("publish_filter", _publish_sql)
def publish_filter(spark, sf_dir):
    """F17 + X8: published slot forecast (at least one class), six columns."""
    return clean.publish(slot_forecast(spark, sf_dir))
