"""Driver-table queries for analyses and legacy reallocation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.periods import shift
from ..operators import rollup, shares
from ..plans import analysis, continuing, evaluate, first_level
from ..session import ensure_checkpoint_dir
from ..sources import driver as drv
from ..sources import ingest
from .families import _continuing_sql
from .forecasting import (EVAL_COLUMNS, SK, classes_sql, clean_sql, first_level_forecast,
                          first_level_targets_in_range, first_level_targets_sql, join_target_sql, slot_forecast, slot_forecast_ctes)
from .families import first_level_features_sql
from .lookups import CELLS_SQL
from .registry import query

P = drv.PARAMS
SITES = sorted(drv.SITE_HOURS)


def _cells(spark, sf_dir):
    return rollup.platinum_rollup(drv.class_rows(spark, sf_dir))


def _pivot_sql() -> str:
    cols = ", ".join(f"CAST(COALESCE(SUM(CASE WHEN SEDE = '{s}' THEN CANT_ALUMNOS END), 0) AS BIGINT) AS \"{s}\""
                     for s in SITES)
    return f"""
SELECT CAST(PERIODO // 100 AS INTEGER) AS YEAR, CAST(PERIODO % 100 AS INTEGER) AS MONTH, {cols}
  FROM {CELLS_SQL} c GROUP BY PERIODO // 100, PERIODO % 100"""


@query("pivot_site_month", _pivot_sql)
def pivot_site_month(spark, sf_dir):
    """A12 + R3: students per (year, month) with one column per site (explicit pivot values), missing -> 0."""
    return analysis.students_by_site_month(_cells(spark, sf_dir), SITES)


def _site_totals_sql() -> str:
    return f"""
SELECT SEDE, PERIODO, CAST(SUM(CANT_CLASES) AS BIGINT) AS CANT_CLASES, CAST(SUM(CANT_ALUMNOS) AS BIGINT) AS CANT_ALUMNOS
  FROM {CELLS_SQL} c GROUP BY SEDE, PERIODO"""


@query("site_totals", _site_totals_sql)
def site_totals(spark, sf_dir):
    """Classes and students per site and month."""
    return analysis.site_totals(_cells(spark, sf_dir))


def _corr_sql() -> str:
    return f"""
WITH c AS {CELLS_SQL},
keys AS (SELECT DISTINCT SEDE, CURSO_ACTUAL, HORARIO_ACTUAL FROM c),
months AS (SELECT DISTINCT PERIODO FROM c),
grid AS (SELECT k.SEDE, k.CURSO_ACTUAL, k.HORARIO_ACTUAL, m.PERIODO, CAST(COALESCE(c.CANT_ALUMNOS, 0) AS DOUBLE) AS V
           FROM keys k CROSS JOIN months m
           LEFT JOIN c ON c.SEDE = k.SEDE AND c.CURSO_ACTUAL = k.CURSO_ACTUAL AND c.HORARIO_ACTUAL = k.HORARIO_ACTUAL
                      AND c.PERIODO = m.PERIODO)
SELECT a.PERIODO AS M1, b.PERIODO AS M2,
       round(CASE WHEN a.PERIODO = b.PERIODO THEN CAST(1 AS DOUBLE) ELSE corr(a.V, b.V) END, 6) AS CORR
  FROM grid a JOIN grid b ON a.SEDE = b.SEDE AND a.CURSO_ACTUAL = b.CURSO_ACTUAL AND a.HORARIO_ACTUAL = b.HORARIO_ACTUAL
 GROUP BY a.PERIODO, b.PERIODO"""


@query("month_correlation", _corr_sql)
def month_correlation(spark, sf_dir):
    """Pearson correlation of students between every pair of months over cell keys, from sums of products."""
    corr = analysis.month_correlation(_cells(spark, sf_dir), ["SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL"])
    return corr.withColumn("CORR", F.round("CORR", 6))


def _first_sql() -> str:
    return _continuing_sql() + """
, ranked AS (SELECT c.*, ROW_NUMBER() OVER (PARTITION BY PERIODO_TARGET, PERIODO, SEDE, CURSO_ACTUAL, IDX
                                             ORDER BY CURSO_ANTERIOR, PE_ANTERIOR) AS RN FROM cand c)
SELECT PERIODO_TARGET, PERIODO, PERIODO_LAG_12, SEDE, CURSO_ANTERIOR, CURSO_ACTUAL, IDX, PE, VAC_ACAD_ESTANDAR,
       PE_ANTERIOR FROM ranked WHERE RN = 1"""


@query("distinct_sorted", _first_sql)
def distinct_sorted(spark, sf_dir):
    """O5 + O6 (+ O2): one candidate per (target, base month, site, course), first under an explicit order."""
    dm = drv.dims(spark)
    full = drv.regular(spark, sf_dir, dm, include_seasonal=True)
    cand = continuing.candidates(full, dm, (shift(drv.TARGET_RANGE[0], 12), drv.TARGET_RANGE[1]), P)
    first = analysis.first_per_key(cand, ["PERIODO_TARGET", "PERIODO", "SEDE", "CURSO_ACTUAL", "IDX"],
                                   ["CURSO_ANTERIOR", "PE_ANTERIOR"])
    return first.orderBy("PERIODO_TARGET", "SEDE", "CURSO_ACTUAL")


def _match_sql() -> str:
    return f"""
WITH fl_base AS (SELECT * FROM ({first_level_features_sql()}) q),
fl_tgt AS {first_level_targets_sql()},
fc1 AS (SELECT PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, IDX, PE, VAC_ACAD_ESTANDAR,
               {clean_sql('CANT_ALUMNOS_LAG_01')} AS CANT_ALUMNOS_PREDICT FROM fl_base),
fc2 AS (SELECT PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, IDX, PE, VAC_ACAD_ESTANDAR,
               {clean_sql('(CANT_ALUMNOS_LAG_01 + CANT_ALUMNOS_LAG_02 + CANT_ALUMNOS_LAG_03) / 3')}
                 AS CANT_ALUMNOS_PREDICT FROM fl_base),
c1 AS (SELECT *, {classes_sql('CANT_ALUMNOS_PREDICT', 'VAC_ACAD_ESTANDAR', 'PE')} AS CANT_CLASES_PREDICT FROM fc1),
c2 AS (SELECT *, {classes_sql('CANT_ALUMNOS_PREDICT', 'VAC_ACAD_ESTANDAR', 'PE')} AS CANT_CLASES_PREDICT FROM fc2),
ev AS (SELECT 'v1' AS VERSION, * FROM ({join_target_sql('c1', 'fl_tgt')}) a
       UNION ALL SELECT 'v2' AS VERSION, * FROM ({join_target_sql('c2', 'fl_tgt')}) b)
SELECT VERSION, round(AVG(CASE WHEN CANT_CLASES = CANT_CLASES_PREDICT THEN CAST(1 AS DOUBLE)
                                  ELSE CAST(0 AS DOUBLE) END), 6) AS MATCH,
       COUNT(CANT_CLASES) AS CANT_CLASES
  FROM ev WHERE NOT (CANT_CLASES = 0 AND CANT_CLASES_PREDICT = 0) GROUP BY VERSION"""


@query("version_match_rate", _match_sql)
def version_match_rate(spark, sf_dir):
    """A13 + S15: evaluation files of two versions written, read back by file name, match rate per version."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cohortcast-{uuid.uuid4().hex}"
    tgt = first_level_targets_in_range(spark, sf_dir)
    for ver in ("v1", "v2"):
        ev = evaluate.join_target(first_level_forecast(spark, sf_dir, ver), tgt, SK).select(*EVAL_COLUMNS)
        ev.write.mode("overwrite").parquet(f"{root}/data_evaluation_{ver}_{first_level.FAMILY}.parquet")
    back = ingest.with_file_version(spark.read.parquet(f"{root}/*.parquet"))
    return analysis.match_rate_by_version(back).withColumn("MATCH", F.round("MATCH", 6))


def _overflow_sql() -> str:
    return "WITH " + slot_forecast_ctes().lstrip() + """,
o1 AS (SELECT *, CASE WHEN CANT_CLASES_PREDICT > 0
                      THEN least(CANT_CLASES_PREDICT * VAC_ACAD_ESTANDAR, CANT_ALUMNOS_PREDICT) ELSE 0.0 END AS NEW_
         FROM fc),
o2 AS (SELECT *, CANT_ALUMNOS_PREDICT - NEW_ AS OVER_,
              CASE WHEN CANT_CLASES_PREDICT > 0 AND CANT_ALUMNOS_PREDICT - NEW_ = 0
                   THEN CANT_CLASES_PREDICT * VAC_ACAD_ESTANDAR - NEW_ ELSE 0.0 END AS SPACE_ FROM o1),
o3 AS (SELECT *, greatest(SUM(OVER_) OVER (PARTITION BY PERIODO_TARGET, SEDE)
                         - SUM(SPACE_) OVER (PARTITION BY PERIODO_TARGET, SEDE), 0.0) AS LEFT_,
               least(SUM(OVER_) OVER (PARTITION BY PERIODO_TARGET, SEDE),
                     SUM(SPACE_) OVER (PARTITION BY PERIODO_TARGET, SEDE))
                 * CASE WHEN SUM(SPACE_) OVER (PARTITION BY PERIODO_TARGET, SEDE) <> 0
                        THEN SPACE_ / SUM(SPACE_) OVER (PARTITION BY PERIODO_TARGET, SEDE) END AS AMT FROM o2),
o4 AS (SELECT *, floor(AMT) AS Q, AMT - floor(AMT) AS R FROM o3),
o5 AS (SELECT *, round_even(SUM(R) OVER (PARTITION BY PERIODO_TARGET, SEDE), 0) AS K,
              ROW_NUMBER() OVER (PARTITION BY PERIODO_TARGET, SEDE ORDER BY round(R, 9) DESC NULLS LAST,
                                 CURSO_ACTUAL DESC NULLS LAST, CANT_ALUMNOS_PREDICT DESC NULLS LAST,
                                 FAC_ALUMNOS_PREDICT DESC NULLS LAST, CANT_ALUMNOS_ANTERIOR DESC NULLS LAST,
                                 CANT_CLASES_ANTERIOR DESC NULLS LAST, PE DESC NULLS LAST,
                                 VAC_ACAD_ESTANDAR DESC NULLS LAST, IDX DESC NULLS LAST,
                                 HORARIO_ACTUAL DESC NULLS LAST) AS RNK FROM o4)
SELECT PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, CANT_CLASES_PREDICT,
       NEW_ + COALESCE(Q + CASE WHEN RNK <= K THEN 1.0 ELSE 0.0 END, 0.0) AS CANT_ALUMNOS_PREDICT,
       LEFT_ AS CANT_ALUMNOS_SIN_CUPO
  FROM o5"""


@query("overflow_realloc", _overflow_sql)
def overflow_realloc(spark, sf_dir):
    """Students capped at classes x seats, overflow spread over free seats per (month, site)."""
    fc = slot_forecast(spark, sf_dir)
    return shares.overflow_reallocation(fc, short="report").select(
        "PERIODO_TARGET", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL", "CANT_CLASES_PREDICT", "CANT_ALUMNOS_PREDICT",
        "CANT_ALUMNOS_SIN_CUPO")
