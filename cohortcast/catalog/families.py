"""Driver-table queries for the three model families."""

from __future__ import annotations

from ..plans import continuing, first_level, slot
from ..session import cut_lineage
from ..sources import driver as drv
from .registry import in_list, months_sql, ord_sql, query, shift_sql

P = drv.PARAMS
LO, HI = drv.TARGET_RANGE


def _dims_sql() -> str:
    names = ["courses", "course_map", "initial_courses", "seasonal_course_map", "seasonal_slot_map",
             "slots", "site_hours", "seats", "pe"]
    return ",\n".join(f"d_{n} AS {drv.dim_sql(n)}" for n in names) + f",\nd_blackout AS {drv.blackout_sql(P)}"


def _prog_sql(col: str) -> str:
    return f"CASE WHEN {col} = {in_list([P.kids_program])[1:-1]} THEN '{P.kids_program}' ELSE '{P.adults_program}' END"


def _march_sql(level: str, freq: str, slot_col: str) -> str:
    return (f"(COALESCE({level} IN {in_list(P.march_levels)}, FALSE) AND COALESCE({freq} = '{P.march_frequency}', FALSE)"
            f" AND COALESCE({slot_col} IN {in_list(P.march_day_slots)}, FALSE))")


def _not_blackout(alias: str, family: str, use: str, period_col: str = "PERIODO_TARGET") -> str:
    return (f"NOT EXISTS (SELECT 1 FROM d_blackout b WHERE b.TIPO = '{family}' AND b.USE = '{use}' "
            f"AND b.SEDE = {alias}.SEDE AND b.PERIODO_TARGET = {alias}.{period_col})")


def _level_sql(col: str) -> str:
    return (f"'L_' || regexp_replace({col}, '(.+) (.+)', '\\1') AS LEVEL, "
            f"'IC_' || regexp_replace({col}, '(.+) (.+)', '\\2') AS IDX_CURSO")


# ---------------------------------------------------------------------------
# First-level family
# ---------------------------------------------------------------------------

def _first_level_sql() -> str:
    lagcols = ",\n         ".join(
        f"CAST(COALESCE(l{n}.CANT_CLASES, 0) AS DOUBLE) AS CANT_CLASES_LAG_{n:02d}, "
        f"CAST(COALESCE(l{n}.CANT_ALUMNOS, 0) AS DOUBLE) AS CANT_ALUMNOS_LAG_{n:02d}" for n in (1, 2, 3, 12))
    lagjoins = "\n    ".join(
        f"LEFT JOIN reg l{n} ON l{n}.PERIODO = c.PERIODO_LAG_{n:02d} AND l{n}.SEDE = c.SEDE "
        f"AND l{n}.CURSO_ACTUAL = c.CURSO_ACTUAL AND l{n}.HORARIO_ACTUAL = c.HORARIO_ACTUAL" for n in (1, 2, 3, 12))
    return f"""
WITH {_dims_sql()},
reg AS MATERIALIZED {drv.regular_sql()},
ini AS (SELECT * FROM reg WHERE FLAG_INICIAL = 1),
targets AS {months_sql(LO, HI)},
cand0 AS (
  SELECT DISTINCT t.PERIODO_TARGET, i.SEDE, i.CURSO_ACTUAL, i.HORARIO_ACTUAL
    FROM ini i JOIN targets t
      ON ({ord_sql('t.PERIODO_TARGET')} - {ord_sql('i.PERIODO')} BETWEEN 1 AND 3)
      OR ({ord_sql('t.PERIODO_TARGET')} - {ord_sql('i.PERIODO')} = 12
          AND t.PERIODO_TARGET % 100 IN {in_list(P.lag12_candidate_months)})),
cand1 AS (
  SELECT c.* FROM cand0 c JOIN d_courses co ON c.CURSO_ACTUAL = co.CURSO_ACTUAL
   WHERE NOT (c.PERIODO_TARGET % 100 = {P.substitution_month}
              AND {_march_sql('co.NIVEL', 'co.FRECUENCIA', 'c.HORARIO_ACTUAL')})),
cand AS (
  SELECT c.PERIODO_TARGET, {shift_sql('c.PERIODO_TARGET', 1)} AS PERIODO_LAG_01,
         {shift_sql('c.PERIODO_TARGET', 2)} AS PERIODO_LAG_02, {shift_sql('c.PERIODO_TARGET', 3)} AS PERIODO_LAG_03,
         {shift_sql('c.PERIODO_TARGET', 12)} AS PERIODO_LAG_12,
         c.SEDE, c.CURSO_ACTUAL, c.HORARIO_ACTUAL, 1 AS IDX, pe.PE, se.VAC_ACAD_ESTANDAR
    FROM cand1 c
    JOIN d_courses co ON c.CURSO_ACTUAL = co.CURSO_ACTUAL
    JOIN d_pe pe ON pe.PERIODO = c.PERIODO_TARGET AND pe.PROGRAMA = {_prog_sql('co.PROGRAMA')}
    JOIN d_seats se ON se.PERIODO = c.PERIODO_TARGET AND se.NIVEL = co.NIVEL
                   AND se.LINEA_DE_NEGOCIO = co.LINEA_DE_NEGOCIO
    JOIN d_slots sl ON sl.HORARIO = c.HORARIO_ACTUAL
    JOIN d_site_hours sh ON sh.PERIODO = c.PERIODO_TARGET AND sh.SEDE = c.SEDE
   WHERE sh.HORA_MAX >= sl.HORA_MAX AND sh.HORA_MIN <= sl.HORA_MIN),
tgt AS (
  SELECT PERIODO AS PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, CANT_CLASES, CANT_ALUMNOS
    FROM ini i WHERE {_not_blackout('i', first_level.FAMILY, 'target', 'PERIODO')}),
feat AS (
  SELECT c.*, {lagcols},
         CAST(COALESCE(t.CANT_CLASES, 0) AS INTEGER) AS CANT_CLASES,
         CAST(COALESCE(t.CANT_ALUMNOS, 0) AS INTEGER) AS CANT_ALUMNOS
    FROM cand c
    {lagjoins}
    LEFT JOIN tgt t ON t.PERIODO_TARGET = c.PERIODO_TARGET AND t.SEDE = c.SEDE
                   AND t.CURSO_ACTUAL = c.CURSO_ACTUAL AND t.HORARIO_ACTUAL = c.HORARIO_ACTUAL)
"""


def first_level_features_sql() -> str:
    return _first_level_sql() + f"""
SELECT f.*, co.NIVEL, co.CURSO_2, co.FRECUENCIA, co.DURACION, {_level_sql('co.CURSO_2')}
  FROM feat f JOIN d_courses co ON f.CURSO_ACTUAL = co.CURSO_ACTUAL
 WHERE {_not_blackout('f', first_level.FAMILY, 'features')}"""


@query("candidates_first", first_level_features_sql)
def candidates_first(spark, sf_dir):
    """C2 + C3: first-level candidates with lags 1, 2, 3, 12, actuals and categoricals, every target month."""
    dm = drv.dims(spark)
    reg = drv.regular(spark, sf_dir, dm)
    return first_level.features(reg, dm, drv.TARGET_RANGE, P)


# ---------------------------------------------------------------------------
# Continuing and slot families
# ---------------------------------------------------------------------------

def _growth_sql(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) <> 0 THEN ({a}) / ({b}) - 1 END"


def _base_sql(lo: int, hi: int) -> str:
    """Cohort base: every cell with the target month it feeds and its course attributes."""
    return f"""
full_ AS MATERIALIZED {drv.regular_sql(include_seasonal=True)},
targets AS {months_sql(lo, hi)},
base AS (
  SELECT t.PERIODO_TARGET, f.*, co.NIVEL, co.FRECUENCIA, co.DURACION, co."POSTERIOR_(+1)" AS SUCC
    FROM full_ f JOIN d_courses co ON f.CURSO_ACTUAL = co.CURSO_ACTUAL
    JOIN targets t ON ({ord_sql('t.PERIODO_TARGET')} - {ord_sql('f.PERIODO')} = 1 AND co.DURACION = '{P.monthly}')
                   OR ({ord_sql('t.PERIODO_TARGET')} - {ord_sql('f.PERIODO')} = 2 AND co.DURACION = '{P.bimonthly}'))"""


def _finish_sql(src: str, extra_cols: str = "", extra_joins: str = "", extra_where: str = "") -> str:
    """PE of the predecessor month, successor PE / seats / flags on the target month."""
    return f"""
  SELECT c.PERIODO_TARGET, c.PERIODO, {shift_sql('c.PERIODO_TARGET', 12)} AS PERIODO_LAG_12, c.SEDE,
         c.CURSO_ACTUAL AS CURSO_ANTERIOR, c.SUCC AS CURSO_ACTUAL, {extra_cols}
         1 AS IDX, pe.PE, se.VAC_ACAD_ESTANDAR, pa.PE AS PE_ANTERIOR
    FROM {src} c
    JOIN d_courses cp ON cp.CURSO_ACTUAL = c.CURSO_ACTUAL
    JOIN d_pe pa ON pa.PERIODO = c.PERIODO AND pa.PROGRAMA = {_prog_sql('cp.PROGRAMA')}
    JOIN d_courses cs ON cs.CURSO_ACTUAL = c.SUCC
    JOIN d_pe pe ON pe.PERIODO = c.PERIODO_TARGET AND pe.PROGRAMA = {_prog_sql('cs.PROGRAMA')}
    JOIN d_seats se ON se.PERIODO = c.PERIODO_TARGET AND se.NIVEL = cs.NIVEL
                   AND se.LINEA_DE_NEGOCIO = cs.LINEA_DE_NEGOCIO
    JOIN d_course_map cm ON cm.CURSO_ANTERIOR = c.SUCC
    {extra_joins}
   WHERE cs.CURSO_2 NOT IN (SELECT CURSOS_INICIALES FROM d_initial_courses) {extra_where}"""


def _continuing_sql() -> str:
    lo12 = drv.from_ord(drv.to_ord(LO) - 12)
    return f"""
WITH {_dims_sql()},
{_base_sql(lo12, HI)},
real AS (SELECT * FROM full_ WHERE FLAG_ESTACIONAL = 0),
regular AS (
  SELECT DISTINCT PERIODO_TARGET, PERIODO, SEDE, CURSO_ACTUAL, SUCC FROM base
   WHERE FLAG_ESTACIONAL = 0 AND SUCC IS NOT NULL AND SUCC <> '{P.terminal_course}'
     AND NOT (PERIODO_TARGET % 100 = {P.substitution_month} AND {_march_sql('NIVEL', 'FRECUENCIA', 'HORARIO_ACTUAL')})),
seasonal AS (
  SELECT DISTINCT b.PERIODO_TARGET, b.PERIODO, b.SEDE, b.CURSO_ACTUAL, m."POSTERIOR_(+1)" AS SUCC
    FROM base b JOIN d_seasonal_course_map m ON b.CURSO_ACTUAL = m.CURSO_ACTUAL
   WHERE b.FLAG_ESTACIONAL = 1 AND b.PERIODO_TARGET % 100 = {P.substitution_month}),
c0 AS (SELECT * FROM regular UNION ALL SELECT * FROM seasonal),
cand AS ({_finish_sql('c0')}),
tot AS (SELECT PERIODO, SEDE, CURSO_ACTUAL, CAST(SUM(CANT_CLASES) AS BIGINT) AS CANT_CLASES,
               CAST(SUM(CANT_ALUMNOS) AS BIGINT) AS CANT_ALUMNOS FROM full_ GROUP BY PERIODO, SEDE, CURSO_ACTUAL),
ant AS (
  SELECT c.PERIODO_TARGET, c.PERIODO_LAG_12, c.SEDE, c.CURSO_ACTUAL, c.IDX, c.PE, c.PE_ANTERIOR, c.VAC_ACAD_ESTANDAR,
         CAST(SUM(COALESCE(t.CANT_CLASES, 0)) AS DOUBLE) AS CANT_CLASES_ANTERIOR,
         CAST(SUM(COALESCE(t.CANT_ALUMNOS, 0)) AS DOUBLE) AS CANT_ALUMNOS_ANTERIOR
    FROM cand c LEFT JOIN tot t ON t.PERIODO = c.PERIODO AND t.SEDE = c.SEDE AND t.CURSO_ACTUAL = c.CURSO_ANTERIOR
   GROUP BY c.PERIODO_TARGET, c.PERIODO_LAG_12, c.SEDE, c.CURSO_ACTUAL, c.IDX, c.PE, c.PE_ANTERIOR, c.VAC_ACAD_ESTANDAR),
tgt AS (
  SELECT PERIODO AS PERIODO_TARGET, SEDE, CURSO_ACTUAL, CAST(SUM(CANT_CLASES) AS BIGINT) AS CANT_CLASES,
         CAST(SUM(CANT_ALUMNOS) AS BIGINT) AS CANT_ALUMNOS
    FROM real r WHERE FLAG_INICIAL = 0 AND {_not_blackout('r', continuing.FAMILY, 'target', 'PERIODO')}
   GROUP BY PERIODO, SEDE, CURSO_ACTUAL),
sply AS (
  SELECT {shift_sql('a.PERIODO_TARGET', -12)} AS PERIODO_TARGET, a.SEDE, a.CURSO_ACTUAL,
         COALESCE(t.CANT_ALUMNOS, 0) - a.CANT_ALUMNOS_ANTERIOR AS DIFF_ALUMNOS_SPLY,
         {_growth_sql('COALESCE(t.CANT_ALUMNOS, 0)', 'a.CANT_ALUMNOS_ANTERIOR')} AS PCT_ALUMNOS_SPLY,
         COALESCE(t.CANT_CLASES, 0) - a.CANT_CLASES_ANTERIOR AS DIFF_CLASES_SPLY,
         {_growth_sql('COALESCE(t.CANT_CLASES, 0)', 'a.CANT_CLASES_ANTERIOR')} AS PCT_CLASES_SPLY
    FROM ant a LEFT JOIN tgt t ON t.PERIODO_TARGET = a.PERIODO_TARGET AND t.SEDE = a.SEDE
                              AND t.CURSO_ACTUAL = a.CURSO_ACTUAL),
feat AS (
  SELECT a.*, CAST(COALESCE(l.CANT_CLASES, 0) AS DOUBLE) AS CANT_CLASES_LAG_12,
         CAST(COALESCE(l.CANT_ALUMNOS, 0) AS DOUBLE) AS CANT_ALUMNOS_LAG_12,
         CAST(COALESCE(s.DIFF_ALUMNOS_SPLY, 0) AS DOUBLE) AS DIFF_ALUMNOS_SPLY,
         CAST(COALESCE(s.PCT_ALUMNOS_SPLY, 0) AS DOUBLE) AS PCT_ALUMNOS_SPLY,
         CAST(COALESCE(s.DIFF_CLASES_SPLY, 0) AS DOUBLE) AS DIFF_CLASES_SPLY,
         CAST(COALESCE(s.PCT_CLASES_SPLY, 0) AS DOUBLE) AS PCT_CLASES_SPLY,
         CAST(COALESCE(t.CANT_CLASES, 0) AS INTEGER) AS CANT_CLASES,
         CAST(COALESCE(t.CANT_ALUMNOS, 0) AS INTEGER) AS CANT_ALUMNOS
    FROM ant a
    LEFT JOIN tot l ON l.PERIODO = a.PERIODO_LAG_12 AND l.SEDE = a.SEDE AND l.CURSO_ACTUAL = a.CURSO_ACTUAL
    LEFT JOIN sply s ON s.PERIODO_TARGET = a.PERIODO_TARGET AND s.SEDE = a.SEDE AND s.CURSO_ACTUAL = a.CURSO_ACTUAL
    LEFT JOIN tgt t ON t.PERIODO_TARGET = a.PERIODO_TARGET AND t.SEDE = a.SEDE AND t.CURSO_ACTUAL = a.CURSO_ACTUAL
   WHERE a.PERIODO_TARGET BETWEEN {LO} AND {HI})
"""


def continuing_features_sql() -> str:
    return _continuing_sql() + f"""
SELECT f.*, {_growth_sql('f.CANT_ALUMNOS', 'f.CANT_ALUMNOS_ANTERIOR')} AS PCT_ALUMNOS,
       {_growth_sql('f.CANT_CLASES', 'f.CANT_CLASES_ANTERIOR')} AS PCT_CLASES,
       co.NIVEL, co.CURSO_2, co.FRECUENCIA, co.DURACION, {_level_sql('co.CURSO_2')}
  FROM feat f JOIN d_courses co ON f.CURSO_ACTUAL = co.CURSO_ACTUAL
 WHERE {_not_blackout('f', continuing.FAMILY, 'features')}"""


@query("candidates_continuing", continuing_features_sql)
def candidates_continuing(spark, sf_dir):
    """C4 + C5: continuing-course candidates with predecessor roll-in, lag 12, SPLY, actuals, growth targets."""
    dm = drv.dims(spark)
    full = drv.regular(spark, sf_dir, dm, include_seasonal=True)
    return continuing.features(full, dm, drv.TARGET_RANGE, P)


def _slot_sql() -> str:
    return f"""
WITH {_dims_sql()},
{_base_sql(LO, HI)},
real AS (SELECT * FROM full_ WHERE FLAG_ESTACIONAL = 0),
hist AS (
  SELECT DISTINCT f.PERIODO, f.SEDE, f.HORARIO_ACTUAL, co.FRECUENCIA, co.INTENSIDAD,
         {_prog_sql('co.PROGRAMA')} AS PROGRAMA
    FROM full_ f JOIN d_courses co ON f.CURSO_ACTUAL = co.CURSO_ACTUAL),
reg0 AS (
  SELECT DISTINCT PERIODO_TARGET, PERIODO, SEDE, CURSO_ACTUAL, SUCC FROM base
   WHERE FLAG_ESTACIONAL = 0 AND SUCC IS NOT NULL AND SUCC <> '{P.terminal_course}'),
reg1 AS (
  SELECT DISTINCT r.PERIODO_TARGET, r.PERIODO, r.SEDE, r.CURSO_ACTUAL, r.SUCC, cs.NIVEL, cs.FRECUENCIA,
         h.HORARIO_ACTUAL
    FROM reg0 r JOIN d_courses cs ON cs.CURSO_ACTUAL = r.SUCC
    JOIN hist h ON h.SEDE = r.SEDE AND h.FRECUENCIA = cs.FRECUENCIA AND h.INTENSIDAD = cs.INTENSIDAD
               AND h.PROGRAMA = {_prog_sql('cs.PROGRAMA')} AND h.PERIODO < r.PERIODO_TARGET),
reg AS (
  SELECT DISTINCT PERIODO_TARGET, PERIODO, SEDE, CURSO_ACTUAL, SUCC, HORARIO_ACTUAL AS HORARIO_ANTERIOR,
         HORARIO_ACTUAL AS SLOT_SUCC
    FROM reg1
   WHERE NOT (PERIODO_TARGET % 100 = {P.substitution_month} AND {_march_sql('NIVEL', 'FRECUENCIA', 'HORARIO_ACTUAL')})),
sea AS (
  SELECT DISTINCT b.PERIODO_TARGET, b.PERIODO, b.SEDE, b.CURSO_ACTUAL, m."POSTERIOR_(+1)" AS SUCC,
         b.HORARIO_ACTUAL AS HORARIO_ANTERIOR, hm."HORARIO_(+1)" AS SLOT_SUCC
    FROM base b JOIN d_seasonal_course_map m ON b.CURSO_ACTUAL = m.CURSO_ACTUAL
    LEFT JOIN d_seasonal_slot_map hm ON hm.HORARIO = b.HORARIO_ACTUAL
   WHERE b.FLAG_ESTACIONAL = 1 AND b.PERIODO_TARGET % 100 = {P.substitution_month}),
c0 AS (SELECT * FROM reg UNION ALL SELECT * FROM sea),
cand AS ({_finish_sql('c0', 'c.HORARIO_ANTERIOR, c.SLOT_SUCC AS HORARIO_ACTUAL,',
                      'JOIN d_slots sl ON sl.HORARIO = c.SLOT_SUCC '
                      'JOIN d_site_hours sh ON sh.PERIODO = c.PERIODO_TARGET AND sh.SEDE = c.SEDE',
                      'AND sh.HORA_MAX >= sl.HORA_MAX AND sh.HORA_MIN <= sl.HORA_MIN')}),
ant0 AS (
  SELECT c.PERIODO_TARGET, c.PERIODO_LAG_12, c.SEDE, c.CURSO_ACTUAL, c.HORARIO_ACTUAL, c.IDX, c.PE,
         c.VAC_ACAD_ESTANDAR, c.PE_ANTERIOR,
         CAST(SUM(COALESCE(f.CANT_CLASES, 0)) AS DOUBLE) AS CANT_CLASES_ANTERIOR,
         CAST(SUM(COALESCE(f.CANT_ALUMNOS, 0)) AS DOUBLE) AS CANT_ALUMNOS_ANTERIOR
    FROM cand c LEFT JOIN full_ f ON f.PERIODO = c.PERIODO AND f.SEDE = c.SEDE AND f.CURSO_ACTUAL = c.CURSO_ANTERIOR
                                 AND f.HORARIO_ACTUAL = c.HORARIO_ANTERIOR
   GROUP BY c.PERIODO_TARGET, c.PERIODO_LAG_12, c.SEDE, c.CURSO_ACTUAL, c.HORARIO_ACTUAL, c.IDX, c.PE,
            c.VAC_ACAD_ESTANDAR, c.PE_ANTERIOR),
par AS (
  SELECT PERIODO_TARGET, PERIODO_LAG_12, SEDE, CURSO_ACTUAL, IDX, PE, VAC_ACAD_ESTANDAR, PE_ANTERIOR,
         SUM(CANT_CLASES_ANTERIOR) AS PC, SUM(CANT_ALUMNOS_ANTERIOR) AS PA
    FROM ant0 GROUP BY PERIODO_TARGET, PERIODO_LAG_12, SEDE, CURSO_ACTUAL, IDX, PE, VAC_ACAD_ESTANDAR, PE_ANTERIOR),
sh AS (
  SELECT a.PERIODO_TARGET, a.PERIODO_LAG_12, a.SEDE, a.CURSO_ACTUAL, a.HORARIO_ACTUAL, a.IDX, a.PE,
         a.VAC_ACAD_ESTANDAR, a.PE_ANTERIOR,
         CASE WHEN p.PC <> 0 THEN a.CANT_CLASES_ANTERIOR / p.PC END AS FAC_CLASES_ANTERIOR,
         CASE WHEN p.PA <> 0 THEN a.CANT_ALUMNOS_ANTERIOR / p.PA END AS FAC_ALUMNOS_ANTERIOR
    FROM ant0 a JOIN par p USING (PERIODO_TARGET, PERIODO_LAG_12, SEDE, CURSO_ACTUAL, IDX, PE, VAC_ACAD_ESTANDAR,
                                  PE_ANTERIOR)),
anter AS (
  SELECT a.PERIODO_TARGET, a.SEDE, a.CURSO_ACTUAL, a.HORARIO_ACTUAL, a.CANT_CLASES_ANTERIOR,
         a.CANT_ALUMNOS_ANTERIOR, s.PERIODO_LAG_12, s.IDX, s.PE, s.VAC_ACAD_ESTANDAR, s.PE_ANTERIOR,
         s.FAC_CLASES_ANTERIOR, s.FAC_ALUMNOS_ANTERIOR
    FROM ant0 a LEFT JOIN sh s ON s.PERIODO_TARGET = a.PERIODO_TARGET AND s.SEDE = a.SEDE
                              AND s.CURSO_ACTUAL = a.CURSO_ACTUAL AND s.HORARIO_ACTUAL = a.HORARIO_ACTUAL),
cpar AS (SELECT PERIODO, SEDE, CURSO_ACTUAL, SUM(CANT_CLASES) AS PC, SUM(CANT_ALUMNOS) AS PA
           FROM full_ GROUP BY PERIODO, SEDE, CURSO_ACTUAL),
lag12 AS (
  SELECT f.PERIODO AS PERIODO_LAG_12, f.SEDE, f.CURSO_ACTUAL, f.HORARIO_ACTUAL,
         CASE WHEN p.PC <> 0 THEN f.CANT_CLASES / p.PC END AS FAC_CLASES_LAG_12,
         CASE WHEN p.PA <> 0 THEN f.CANT_ALUMNOS / p.PA END AS FAC_ALUMNOS_LAG_12
    FROM full_ f JOIN cpar p USING (PERIODO, SEDE, CURSO_ACTUAL)),
tpar AS (SELECT PERIODO, SEDE, CURSO_ACTUAL, SUM(CANT_CLASES) AS PC, SUM(CANT_ALUMNOS) AS PA
           FROM real WHERE FLAG_INICIAL = 0 GROUP BY PERIODO, SEDE, CURSO_ACTUAL),
tgt AS (
  SELECT r.PERIODO AS PERIODO_TARGET, r.SEDE, r.CURSO_ACTUAL, r.HORARIO_ACTUAL, r.CANT_CLASES, r.CANT_ALUMNOS,
         CASE WHEN p.PC <> 0 THEN r.CANT_CLASES / p.PC END AS FAC_CLASES,
         CASE WHEN p.PA <> 0 THEN r.CANT_ALUMNOS / p.PA END AS FAC_ALUMNOS
    FROM real r JOIN tpar p USING (PERIODO, SEDE, CURSO_ACTUAL)
   WHERE r.FLAG_INICIAL = 0 AND {_not_blackout('r', slot.FAMILY, 'target', 'PERIODO')})
"""


def slot_features_sql() -> str:
    return _slot_sql() + f"""
SELECT a.*, CAST(COALESCE(l.FAC_CLASES_LAG_12, 0) AS DOUBLE) AS FAC_CLASES_LAG_12,
       CAST(COALESCE(l.FAC_ALUMNOS_LAG_12, 0) AS DOUBLE) AS FAC_ALUMNOS_LAG_12,
       CAST(COALESCE(t.CANT_CLASES, 0) AS INTEGER) AS CANT_CLASES,
       CAST(COALESCE(t.CANT_ALUMNOS, 0) AS INTEGER) AS CANT_ALUMNOS,
       CAST(COALESCE(t.FAC_CLASES, 0) AS FLOAT) AS FAC_CLASES,
       CAST(COALESCE(t.FAC_ALUMNOS, 0) AS FLOAT) AS FAC_ALUMNOS,
       co.NIVEL, co.CURSO_2, {_level_sql('co.CURSO_2')}
  FROM anter a
  LEFT JOIN lag12 l ON l.PERIODO_LAG_12 = a.PERIODO_LAG_12 AND l.SEDE = a.SEDE AND l.CURSO_ACTUAL = a.CURSO_ACTUAL
                   AND l.HORARIO_ACTUAL = a.HORARIO_ACTUAL
  LEFT JOIN tgt t ON t.PERIODO_TARGET = a.PERIODO_TARGET AND t.SEDE = a.SEDE AND t.CURSO_ACTUAL = a.CURSO_ACTUAL
                 AND t.HORARIO_ACTUAL = a.HORARIO_ACTUAL
  JOIN d_courses co ON a.CURSO_ACTUAL = co.CURSO_ACTUAL
 WHERE {_not_blackout('a', slot.FAMILY, 'features')}"""


@query("candidates_slot", slot_features_sql)
def candidates_slot(spark, sf_dir):
    """C6 + C7: successor courses expanded to historical slots, predecessor shares, lag-12 shares, actuals."""
    dm = drv.dims(spark)
    full = drv.regular(spark, sf_dir, dm, include_seasonal=True)
    return slot.features(full, dm, drv.TARGET_RANGE, P, materialize=cut_lineage)
