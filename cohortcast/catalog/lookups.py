"""Driver-table queries for period algebra, lookups, lags and feature pieces (P*, F5-F13, J3-J17, A6-A8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import periods as per
from ..functions.scalars import growth
from ..operators import clean, enrich, lags, rollup
from ..operators.enrich import SUCC
from ..plans import continuing, first_level, slot
from ..sources import driver as drv
from .families import (_continuing_sql, _dims_sql, _first_level_sql, _level_sql, _march_sql, _not_blackout,
                       _prog_sql, _slot_sql)
from .registry import in_list, ord_sql, query, shift_sql

P = drv.PARAMS
LO, HI = drv.TARGET_RANGE
CELL = ["PERIODO", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL"]


def _cells(spark, sf_dir):
    return rollup.platinum_rollup(drv.class_rows(spark, sf_dir))


CELLS_SQL = f"""(SELECT PERIODO, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, COUNT(*) AS CANT_CLASES,
        CAST(SUM(CANT_MATRICULADOS) AS BIGINT) AS CANT_ALUMNOS
   FROM {drv.CLASS_ROWS_SQL} cr GROUP BY PERIODO, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL)"""


# ---- period algebra over data months ---------------------------------------------

def _shift_sql_q() -> str:
    return f"""
WITH m AS (SELECT DISTINCT PERIODO FROM {CELLS_SQL} c)
SELECT PERIODO, {shift_sql('PERIODO', 1)} AS LAG_01, {shift_sql('PERIODO', 12)} AS LAG_12,
       {shift_sql('PERIODO', -1)} AS LEAD_01, {shift_sql('PERIODO', 3)} AS LAG_03 FROM m"""


@query("period_shift", _shift_sql_q)
def period_shift(spark, sf_dir):
    """Months shifted back / forward across year boundaries, for every month with data."""
    m = _cells(spark, sf_dir).select("PERIODO").distinct()
    return m.select("PERIODO", per.shift_period("PERIODO", 1).alias("LAG_01"),
                    per.shift_period("PERIODO", 12).alias("LAG_12"),
                    per.shift_period("PERIODO", -1).alias("LEAD_01"), per.shift_period("PERIODO", 3).alias("LAG_03"))


def _range_sql() -> str:
    return f"""
WITH m AS (SELECT MIN(PERIODO) AS FIRST_P, MAX(PERIODO) AS LAST_P FROM {CELLS_SQL} c)
SELECT m.FIRST_P, m.LAST_P,
       ({ord_sql('m.LAST_P')} - {ord_sql('m.FIRST_P')} + 1) AS N_MONTHS,
       ({ord_sql('m.LAST_P')} - {ord_sql(str(P.training_start_period))} + 1) AS N_TRAINING,
       ({ord_sql('m.LAST_P')} - {ord_sql(str(P.history_start_period))} + 1) AS N_HISTORY,
       {shift_sql('m.LAST_P', 2)} AS LAST3_MIN
  FROM m"""


@query("period_range", _range_sql)
def period_range(spark, sf_dir):
    """P2-P5 + P7 + O3: first / last data month (min, max), month counts of the history and training windows."""
    m = _cells(spark, sf_dir).agg(F.min("PERIODO").alias("FIRST_P"), F.max("PERIODO").alias("LAST_P"))
    return m.select("FIRST_P", "LAST_P",
                    (per.period_ord("LAST_P") - per.period_ord("FIRST_P") + 1).alias("N_MONTHS"),
                    (per.period_ord("LAST_P") - per.to_ord(P.training_start_period) + 1).alias("N_TRAINING"),
                    (per.period_ord("LAST_P") - per.to_ord(P.history_start_period) + 1).alias("N_HISTORY"),
                    per.shift_period("LAST_P", 2).alias("LAST3_MIN"))


def _windows_sql() -> str:
    month = "CAST(q // 12 * 100 + q % 12 + 1 AS INTEGER)"
    def part(kind, first, last, where="TRUE"):  # noqa: E306
        return (f"SELECT '{kind}' AS KIND, {month} AS PERIODO FROM "
                f"(SELECT unnest(generate_series({first}, {last})) AS q FROM x) WHERE {where}")
    history, training = per.to_ord(P.history_start_period), per.to_ord(P.training_start_period)
    parts = [part("last", "o - 2", "o"), part("ahead", "o", "o + 4"), part("all", history, "o"),
             part("training", training, "o"),
             part("seasonal_training", training, "o", f"q % 12 + 1 IN {in_list(P.seasonal_months)}"),
             part("selected_n", "o - 11", "o"), part("selected_all", history, "o"),
             part("horizon", "o", "o + 2"), part("horizon_explicit", "o - 1", "o - 1")]
    return f"""
WITH m AS (SELECT PERIODO, CAST(SUM(CANT_CLASES) AS BIGINT) AS N_CLASES FROM {CELLS_SQL} c GROUP BY PERIODO),
x AS (SELECT {ord_sql('MAX(PERIODO)')} AS o FROM m),
w AS ({' UNION ALL '.join(parts)})
SELECT w.KIND, w.PERIODO, COALESCE(m.N_CLASES, 0) AS N_CLASES FROM w LEFT JOIN m ON m.PERIODO = w.PERIODO"""


@query("period_windows", _windows_sql)
def period_windows(spark, sf_dir):
    """P2-P7 + P9: the classes of every month of each window that ends (or starts) at the last month with data."""
    m = (_cells(spark, sf_dir).groupBy("PERIODO").agg(F.sum("CANT_CLASES").cast("long").alias("N_CLASES")))
    last = m.agg(F.max("PERIODO")).first()[0]
    if last is None:
        return m.select(F.lit("").alias("KIND"), "PERIODO", "N_CLASES")
    windows = {"last": per.last_n(last, 3), "ahead": per.ahead_n(last, 5), "all": per.all_periods(last, P),
               "training": per.training_periods(last, P),
               "seasonal_training": per.seasonal_training_periods(last, P.seasonal_months, P),
               "selected_n": per.select_periods(12, last, False, P),
               "selected_all": per.select_periods(None, last, True, P), "horizon": per.horizon(last, 3),
               "horizon_explicit": per.horizon(last, 3, per.shift(last, 1))}
    frames = [per.period_list_frame(spark, months).select(F.lit(kind).alias("KIND"), "PERIODO")
              for kind, months in windows.items()]
    every = frames[0]
    for f in frames[1:]:
        every = every.unionByName(f)
    return (every.join(m, "PERIODO", "left")
            .select("KIND", "PERIODO", F.coalesce("N_CLASES", F.lit(0).cast("long")).alias("N_CLASES")))


def _schedule_sql() -> str:
    rows = ", ".join(f"({m}, '{f}', {'TRUE' if r else 'FALSE'})" for m, f, r in per.schedule_rows())
    return f"""
WITH m AS (SELECT DISTINCT PERIODO FROM {CELLS_SQL} c),
s AS (SELECT * FROM (VALUES {rows}) v(MONTH, TIPO, RUNS))
SELECT m.PERIODO, s.TIPO, s.RUNS,
       (m.PERIODO % 100) IN {in_list(P.seasonal_months)} AS SEASONAL_REGIME
  FROM m JOIN s ON s.MONTH = m.PERIODO % 100"""


@query("schedule_map", _schedule_sql)
def schedule_map(spark, sf_dir):
    """P6 + P8 + P9: which families run in each data month, and whether the seasonal regime applies."""
    m = _cells(spark, sf_dir).select("PERIODO").distinct()
    s = F.broadcast(per.schedule_frame(spark))
    return (m.join(s, per.month_of("PERIODO") == s.MONTH)
             .select("PERIODO", "TIPO", "RUNS",
                     per.month_of("PERIODO").isin(list(P.seasonal_months)).alias("SEASONAL_REGIME")))


# ---- lags -------------------------------------------------------------------------

LAGS = (1, 2, 3, 12)


def _lag_sql() -> str:
    cols = ", ".join(f"CAST(COALESCE(l{n}.CANT_CLASES, 0) AS DOUBLE) AS CANT_CLASES_LAG_{n:02d}, "
                     f"CAST(COALESCE(l{n}.CANT_ALUMNOS, 0) AS DOUBLE) AS CANT_ALUMNOS_LAG_{n:02d}" for n in LAGS)
    joins = " ".join(f"LEFT JOIN c l{n} ON l{n}.PERIODO = {shift_sql('c0.PERIODO', n)} AND l{n}.SEDE = c0.SEDE "
                     f"AND l{n}.CURSO_ACTUAL = c0.CURSO_ACTUAL AND l{n}.HORARIO_ACTUAL = c0.HORARIO_ACTUAL" for n in LAGS)
    return f"""
WITH c AS {CELLS_SQL}
SELECT c0.PERIODO, c0.SEDE, c0.CURSO_ACTUAL, c0.HORARIO_ACTUAL, c0.CANT_CLASES, c0.CANT_ALUMNOS, {cols}
  FROM c c0 {joins}"""


@query("lag_lookup", _lag_sql)
def lag_lookup(spark, sf_dir):
    """For every cell, the same cell 1, 2, 3 and 12 months earlier (0 when absent), one shuffle."""
    cells = _cells(spark, sf_dir)
    fan = lags.lag_fanout(cells, ["SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL"], (0, *LAGS))
    aggs = [F.max(F.col("LAG") == 0).alias("_HERE"), lags.lag_value(0, "CANT_CLASES").alias("CANT_CLASES"),
            lags.lag_value(0, "CANT_ALUMNOS").alias("CANT_ALUMNOS")]
    for n in LAGS:
        for v in ("CANT_CLASES", "CANT_ALUMNOS"):
            aggs.append(F.coalesce(lags.lag_value(n, v), F.lit(0)).cast("double").alias(f"{v}_LAG_{n:02d}"))
    g = fan.groupBy("PERIODO_TARGET", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL").agg(*aggs)
    return g.where("_HERE").drop("_HERE").withColumnRenamed("PERIODO_TARGET", "PERIODO")


def _course_lag_sql() -> str:
    return f"""
WITH t AS (SELECT PERIODO, SEDE, CURSO_ACTUAL, CAST(SUM(CANT_CLASES) AS BIGINT) AS CANT_CLASES,
                  CAST(SUM(CANT_ALUMNOS) AS BIGINT) AS CANT_ALUMNOS FROM {CELLS_SQL} c GROUP BY 1, 2, 3)
SELECT t.PERIODO, {shift_sql('t.PERIODO', 12)} AS PERIODO_LAG_12, t.SEDE, t.CURSO_ACTUAL, t.CANT_CLASES,
       t.CANT_ALUMNOS, CAST(COALESCE(l.CANT_CLASES, 0) AS DOUBLE) AS CANT_CLASES_LAG_12,
       CAST(COALESCE(l.CANT_ALUMNOS, 0) AS DOUBLE) AS CANT_ALUMNOS_LAG_12
  FROM t LEFT JOIN t l ON l.PERIODO = {shift_sql('t.PERIODO', 12)} AND l.SEDE = t.SEDE AND l.CURSO_ACTUAL = t.CURSO_ACTUAL"""


@query("course_lag", _course_lag_sql)
def course_lag(spark, sf_dir):
    """A6 + J7 (join form): course totals and the same course 12 months earlier."""
    tot = rollup.course_totals(_cells(spark, sf_dir))
    idx = tot.withColumnRenamed("PERIODO", "PERIODO_TARGET")
    out = lags.lag_join(idx, tot, 12, ["SEDE", "CURSO_ACTUAL"])
    return out.select(F.col("PERIODO_TARGET").alias("PERIODO"), "PERIODO_LAG_12", "SEDE", "CURSO_ACTUAL",
                      "CANT_CLASES", "CANT_ALUMNOS", "CANT_CLASES_LAG_12", "CANT_ALUMNOS_LAG_12")


# ---- pieces of the continuing / slot families --------------------------------------

def _cohort_sql() -> str:
    return _continuing_sql().split("\nreal AS (")[0].rstrip().rstrip(",") + f"""
SELECT PERIODO_TARGET, PERIODO, SEDE, CURSO_ACTUAL, SUCC AS "POSTERIOR_(+1)", FLAG_ESTACIONAL, FLAG_INICIAL,
       COUNT(*) AS N_CELLS, CAST(SUM(CANT_ALUMNOS) AS BIGINT) AS CANT_ALUMNOS,
       SUCC IS NOT NULL AND SUCC <> '{P.terminal_course}' AS CONTINUES
  FROM base GROUP BY PERIODO_TARGET, PERIODO, SEDE, CURSO_ACTUAL, SUCC, FLAG_ESTACIONAL, FLAG_INICIAL"""


@query("cohort_base", _cohort_sql)
def cohort_base(spark, sf_dir):
    """F6 + F7 + F9 + F10: cells feeding each target month (+1 monthly, +2 bimonthly), flags and continuation."""
    dm = drv.dims(spark)
    full = drv.regular(spark, sf_dir, dm, include_seasonal=True)
    lo12 = per.shift(LO, 12)
    b = continuing.base_rows(full, dm, (lo12, HI), P)
    return (b.groupBy("PERIODO_TARGET", "PERIODO", "SEDE", "CURSO_ACTUAL", f"`{SUCC}`", "FLAG_ESTACIONAL",
                      "FLAG_INICIAL")
             .agg(F.count(F.lit(1)).alias("N_CELLS"), F.sum("CANT_ALUMNOS").cast("long").alias("CANT_ALUMNOS"))
             .withColumn("CONTINUES", clean.not_terminal(SUCC, P)))


def _march_q_sql() -> str:
    return f"""
WITH {_dims_sql()}, c AS {CELLS_SQL}
SELECT c.PERIODO, c.SEDE, c.CURSO_ACTUAL, c.HORARIO_ACTUAL, c.CANT_ALUMNOS,
       {_march_sql('co.NIVEL', 'co.FRECUENCIA', 'c.HORARIO_ACTUAL')} AS EXCLUDED
  FROM c JOIN d_courses co ON c.CURSO_ACTUAL = co.CURSO_ACTUAL WHERE c.PERIODO % 100 = {P.substitution_month}"""


@query("march_exclusion", _march_q_sql)
def march_exclusion(spark, sf_dir):
    """F8: March cells flagged when level, frequency and day slot all match the exclusion lists."""
    dm = drv.dims(spark)
    c = _cells(spark, sf_dir).where(per.month_of("PERIODO") == P.substitution_month)
    c = c.join(enrich.course_attributes(dm, ["NIVEL", "FRECUENCIA"]), "CURSO_ACTUAL", "left")
    return c.select(*CELL, "CANT_ALUMNOS",
                    clean.march_excluded("NIVEL", "FRECUENCIA", "HORARIO_ACTUAL", P).alias("EXCLUDED"))


def _seasonal_sql() -> str:
    pre = _continuing_sql().split("\nreal AS (")[0].rstrip().rstrip(",")
    return pre + f""",
seasonal AS (
  SELECT DISTINCT b.PERIODO_TARGET, b.PERIODO, b.SEDE, b.CURSO_ACTUAL, m."POSTERIOR_(+1)" AS SUCC,
         b.HORARIO_ACTUAL, hm."HORARIO_(+1)" AS SLOT_SUCC
    FROM base b JOIN d_seasonal_course_map m ON b.CURSO_ACTUAL = m.CURSO_ACTUAL
    LEFT JOIN d_seasonal_slot_map hm ON hm.HORARIO = b.HORARIO_ACTUAL
   WHERE b.FLAG_ESTACIONAL = 1 AND b.PERIODO_TARGET % 100 = {P.substitution_month})
SELECT PERIODO_TARGET, PERIODO, SEDE, CURSO_ACTUAL AS CURSO_ANTERIOR, SUCC AS CURSO_ACTUAL,
       HORARIO_ACTUAL AS HORARIO_ANTERIOR, SLOT_SUCC AS HORARIO_ACTUAL FROM seasonal"""


@query("seasonal_substitution", _seasonal_sql)
def seasonal_substitution(spark, sf_dir):
    """March rows of seasonal courses re-pointed to their mapped successor course and slot."""
    dm = drv.dims(spark)
    full = drv.regular(spark, sf_dir, dm, include_seasonal=True)
    b = continuing.base_rows(full, dm, (per.shift(LO, 12), HI), P)
    cmap = dm.small("seasonal_course_map", dm["seasonal_course_map"].select(
        "CURSO_ACTUAL", F.col(f"`{SUCC}`").alias("_SUCC")))
    hmap = dm.small("seasonal_slot_map", dm["seasonal_slot_map"].select(
        F.col("HORARIO").alias("HORARIO_ACTUAL"), F.col("`HORARIO_(+1)`").alias("_SLOT")))
    s = (b.where((F.col("FLAG_ESTACIONAL") == 1) & (per.month_of("PERIODO_TARGET") == P.substitution_month))
          .select("PERIODO_TARGET", "PERIODO", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL")
          .join(cmap, "CURSO_ACTUAL", "left").join(hmap, "HORARIO_ACTUAL", "left").distinct())
    return s.select("PERIODO_TARGET", "PERIODO", "SEDE", F.col("CURSO_ACTUAL").alias("CURSO_ANTERIOR"),
                    F.col("_SUCC").alias("CURSO_ACTUAL"), F.col("HORARIO_ACTUAL").alias("HORARIO_ANTERIOR"),
                    F.col("_SLOT").alias("HORARIO_ACTUAL"))


def _slot_expansion_sql() -> str:
    return _slot_sql() + "\nSELECT * FROM cand"


@query("slot_expansion", _slot_expansion_sql)
def slot_expansion(spark, sf_dir):
    """J10 + F18: successor courses expanded to every slot seen earlier at the site (slot candidates C6)."""
    dm = drv.dims(spark)
    full = drv.regular(spark, sf_dir, dm, include_seasonal=True)
    return slot.candidates(full, dm, drv.TARGET_RANGE, P)


def _predecessor_sql() -> str:
    return _continuing_sql() + "\nSELECT * FROM ant WHERE PERIODO_TARGET BETWEEN " + f"{LO} AND {HI}"


@query("predecessor_rollin", _predecessor_sql)
def predecessor_rollin(spark, sf_dir):
    """J8 + A7: predecessor course totals of the base month rolled into the successor course."""
    dm = drv.dims(spark)
    full = drv.regular(spark, sf_dir, dm, include_seasonal=True)
    cand = continuing.candidates(full, dm, drv.TARGET_RANGE, P)
    return continuing.anterior(cand, full)


def _target_sql() -> str:
    return _continuing_sql() + "\nSELECT * FROM tgt WHERE PERIODO_TARGET BETWEEN " + f"{LO} AND {HI}"


@query("target_attach", _target_sql)
def target_attach(spark, sf_dir):
    """C8 + J11: course-level actuals of continuing courses with the target blackout applied."""
    dm = drv.dims(spark)
    full = drv.regular(spark, sf_dir, dm, include_seasonal=True)
    return continuing.targets(full, P).where(F.col("PERIODO_TARGET").between(LO, HI))


def _sply_sql() -> str:
    return _continuing_sql() + f"""
SELECT PERIODO_TARGET, SEDE, CURSO_ACTUAL, DIFF_ALUMNOS_SPLY, PCT_ALUMNOS_SPLY, DIFF_CLASES_SPLY, PCT_CLASES_SPLY
  FROM sply WHERE PERIODO_TARGET BETWEEN {LO} AND {HI}"""


@query("same_period_last_year", _sply_sql)
def same_period_last_year(spark, sf_dir):
    """J13 + X7: last year's predecessor totals vs last year's actuals (difference and growth), moved +12 months."""
    dm = drv.dims(spark)
    full = drv.regular(spark, sf_dir, dm, include_seasonal=True)
    cand = continuing.candidates(full, dm, (per.shift(LO, 12), HI), P)
    ant = continuing.anterior(cand, full)
    tgt = continuing.targets(full, P)
    k = ["PERIODO_TARGET", "SEDE", "CURSO_ACTUAL"]
    s = ant.select(*k, "CANT_CLASES_ANTERIOR", "CANT_ALUMNOS_ANTERIOR").join(tgt, k, "left")
    a, c = F.coalesce("CANT_ALUMNOS", F.lit(0)), F.coalesce("CANT_CLASES", F.lit(0))
    out = s.select(per.shift_period("PERIODO_TARGET", -12).alias("PERIODO_TARGET"), "SEDE", "CURSO_ACTUAL",
                   (a - F.col("CANT_ALUMNOS_ANTERIOR")).alias("DIFF_ALUMNOS_SPLY"),
                   growth(a, "CANT_ALUMNOS_ANTERIOR", P).alias("PCT_ALUMNOS_SPLY"),
                   (c - F.col("CANT_CLASES_ANTERIOR")).alias("DIFF_CLASES_SPLY"),
                   growth(c, "CANT_CLASES_ANTERIOR", P).alias("PCT_CLASES_SPLY"))
    return out.where(F.col("PERIODO_TARGET").between(LO, HI))


def _share_sql() -> str:
    return _slot_sql() + "\nSELECT * FROM anter"


@query("share_of_parent", _share_sql)
def share_of_parent(spark, sf_dir):
    """A8 + J16: predecessor slot totals and their share of the successor course (many-to-many kept)."""
    dm = drv.dims(spark)
    full = drv.regular(spark, sf_dir, dm, include_seasonal=True)
    cand = slot.candidates(full, dm, drv.TARGET_RANGE, P)
    return slot.anterior_shares(cand, full)


# ---- lookups ------------------------------------------------------------------------

def _flags_sql() -> str:
    return f"""
WITH {_dims_sql()}, c AS {CELLS_SQL}
SELECT c.PERIODO, c.SEDE, c.CURSO_ACTUAL, c.HORARIO_ACTUAL, cm.FLAG_ESTACIONAL,
       CASE WHEN co.CURSO_2 IN (SELECT CURSOS_INICIALES FROM d_initial_courses) THEN 1 ELSE 0 END AS FLAG_INICIAL
  FROM c JOIN d_course_map cm ON cm.CURSO_ANTERIOR = c.CURSO_ACTUAL JOIN d_courses co ON co.CURSO_ACTUAL = c.CURSO_ACTUAL"""


@query("course_flags", _flags_sql)
def course_flags(spark, sf_dir):
    """J3 + J17: seasonal flag and initial-course membership for every cell."""
    dm = drv.dims(spark)
    return enrich.add_flags(_cells(spark, sf_dir).select(*CELL), dm)


def _pe_sql() -> str:
    return f"""
WITH {_dims_sql()}, c AS {CELLS_SQL}
SELECT c.PERIODO, c.SEDE, c.CURSO_ACTUAL, c.HORARIO_ACTUAL, pe.PE
  FROM c JOIN d_courses co ON co.CURSO_ACTUAL = c.CURSO_ACTUAL
  JOIN d_pe pe ON pe.PERIODO = c.PERIODO AND pe.PROGRAMA = {_prog_sql('co.PROGRAMA')}"""


@query("break_even", _pe_sql)
def break_even(spark, sf_dir):
    """J4 + X6: break-even students per cell from (month, collapsed programme)."""
    return enrich.add_pe(_cells(spark, sf_dir).select(*CELL), drv.dims(spark), "PERIODO", P)


def _seats_sql() -> str:
    return f"""
WITH {_dims_sql()}, c AS {CELLS_SQL}
SELECT c.PERIODO, c.SEDE, c.CURSO_ACTUAL, c.HORARIO_ACTUAL, se.VAC_ACAD_ESTANDAR
  FROM c JOIN d_courses co ON co.CURSO_ACTUAL = c.CURSO_ACTUAL
  JOIN d_seats se ON se.PERIODO = c.PERIODO AND se.NIVEL = co.NIVEL AND se.LINEA_DE_NEGOCIO = co.LINEA_DE_NEGOCIO"""


@query("capacity", _seats_sql)
def capacity(spark, sf_dir):
    """Standard seats per class for every cell from (month, level, business line)."""
    return enrich.add_seats(_cells(spark, sf_dir).select(*CELL), drv.dims(spark), "PERIODO")


def _hours_q_sql() -> str:
    return f"""
WITH {_dims_sql()}, c AS {CELLS_SQL}
SELECT c.PERIODO, c.SEDE, c.CURSO_ACTUAL, c.HORARIO_ACTUAL, c.CANT_ALUMNOS
  FROM c JOIN d_slots sl ON sl.HORARIO = c.HORARIO_ACTUAL JOIN d_site_hours sh ON sh.PERIODO = c.PERIODO AND sh.SEDE = c.SEDE
 WHERE sh.HORA_MAX >= sl.HORA_MAX AND sh.HORA_MIN <= sl.HORA_MIN"""


@query("opening_hours", _hours_q_sql)
def opening_hours(spark, sf_dir):
    """Cells whose slot lies within the site's opening hours of that month."""
    c = _cells(spark, sf_dir).select(*CELL, "CANT_ALUMNOS")
    return enrich.within_opening_hours(c, drv.dims(spark), "PERIODO")


def _blackout_sql() -> str:
    return f"""
WITH {_dims_sql()}, c AS {CELLS_SQL}
SELECT c.PERIODO AS PERIODO_TARGET, c.SEDE, c.CURSO_ACTUAL, c.HORARIO_ACTUAL, c.CANT_ALUMNOS
  FROM c WHERE {_not_blackout('c', first_level.FAMILY, 'features', 'PERIODO')}"""


@query("blackout_anti", _blackout_sql)
def blackout_anti(spark, sf_dir):
    """cells outside the (site, month) blackout list of the first-level features (left anti join)."""
    c = _cells(spark, sf_dir).select(F.col("PERIODO").alias("PERIODO_TARGET"), "SEDE", "CURSO_ACTUAL",
                                     "HORARIO_ACTUAL", "CANT_ALUMNOS")
    return clean.drop_blackout(c, first_level.FAMILY, "features", P)


def _feature_attach_sql() -> str:
    return _first_level_sql() + f"""
SELECT f.PERIODO_TARGET, f.SEDE, f.CURSO_ACTUAL, f.HORARIO_ACTUAL, f.IDX, f.PERIODO_LAG_12,
       co.NIVEL, co.CURSO_2, co.FRECUENCIA, co.DURACION, {_level_sql('co.CURSO_2')}
  FROM feat f JOIN d_courses co ON f.CURSO_ACTUAL = co.CURSO_ACTUAL"""


@query("feature_attach", _feature_attach_sql)
def feature_attach(spark, sf_dir):
    """J12 + F20: categoricals attached to the candidate rows of every target month."""
    dm = drv.dims(spark)
    reg = drv.regular(spark, sf_dir, dm)
    f = first_level.features(reg, dm, drv.TARGET_RANGE, P, blackout=False)
    return f.select("PERIODO_TARGET", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL", "IDX", "PERIODO_LAG_12",
                     "NIVEL", "CURSO_2", "FRECUENCIA", "DURACION", "LEVEL", "IDX_CURSO")


MODEL_MONTHS = 12          # model months of ``time_split``: the last year of the data, so that every regime occurs


def _split_sql() -> str:
    last = "(SELECT MAX(CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER)) FROM lineitem)"
    months = ", ".join(f"({i})" for i in range(MODEL_MONTHS))
    seasonal = in_list(P.seasonal_months)
    return _first_level_sql() + f""",
models AS (SELECT {shift_sql(last, 'i')} AS MODEL_PERIODO FROM (VALUES {months}) m(i))
SELECT m.MODEL_PERIODO, f.PERIODO_TARGET, f.SEDE, f.CURSO_ACTUAL, f.HORARIO_ACTUAL, f.CANT_ALUMNOS,
       CASE WHEN f.PERIODO_TARGET < m.MODEL_PERIODO THEN 'train' ELSE 'test' END AS SPLIT
  FROM feat f JOIN models m ON f.PERIODO_TARGET <= m.MODEL_PERIODO
 WHERE {_not_blackout('f', first_level.FAMILY, 'features')}
   AND (f.PERIODO_TARGET = m.MODEL_PERIODO OR (f.PERIODO_TARGET >= {P.training_start_period}
        AND CASE WHEN (m.MODEL_PERIODO % 100) IN {seasonal} THEN f.PERIODO_TARGET % 100 = m.MODEL_PERIODO % 100
                 ELSE NOT (f.PERIODO_TARGET % 100) IN {seasonal} END))"""


@query("time_split", _split_sql)
def time_split(spark, sf_dir):
    """F11 + F12 + F13: for each of the last twelve model months, train (earlier months, regime of the model month: the same month
    number in season, else no seasonal months) and test (the model month)."""
    dm = drv.dims(spark)
    last = drv.read(spark, sf_dir, "lineitem").agg(F.max(per.period_of_timestamp("l_shipdate"))).first()[0]
    f = first_level.features(drv.regular(spark, sf_dir, dm), dm, drv.TARGET_RANGE, P)
    months = F.array(*[F.lit(per.shift(last, i)) for i in range(MODEL_MONTHS)])        # a bounded fan-out
    x = f.withColumn("MODEL_PERIODO", F.explode(months)).where("PERIODO_TARGET <= MODEL_PERIODO")
    test = F.col("PERIODO_TARGET") == F.col("MODEL_PERIODO")
    train = (F.col("PERIODO_TARGET") >= P.training_start_period) & clean.seasonal_regime_predicate(
        "PERIODO_TARGET", "MODEL_PERIODO", P)
    return x.where(test | train).select("MODEL_PERIODO", "PERIODO_TARGET", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL", "CANT_ALUMNOS",
                                        F.when(test, "test").otherwise("train").alias("SPLIT"))
