"""The forecasting domain laid over the driver's TPC-H-like tables.

A scheduled class is a line item: month = ship month, site = region of the
supplier, course = part type, slot = order priority, students = quantity,
state = return flag.  Raw codes (course code with sale suffixes, raw slot
label, raw site label) are derived from the same rows so the ETL rules have
something to clean.  Synthetic planner rows come from the orders table.

Catalogue tables are generated here by rule (``*_rows`` functions) and
rendered twice from the same rows: as Spark frames and as SQL ``VALUES``
for the DuckDB oracle, so both sides see identical reference data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BLACKOUT, Params
from ..functions.periods import from_ord, period_of_timestamp, to_ord
from .dims import Dims

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# ---------------------------------------------------------------------------
# Fixed values of the driver profile (catalogue of the stand-in domain).
# ---------------------------------------------------------------------------
COURSES = [
    # CURSO_ACTUAL, CURSO_2, NIVEL, FRECUENCIA, INTENSIDAD, DURACION, PROGRAMA, LINEA_DE_NEGOCIO, POSTERIOR_(+1)
    ("SMALL", "Basic 1", "ST1", "Interdiario", "Regular", "Mensual", "Niños", "Kids", "MEDIUM"),
    ("MEDIUM", "Basic 2", "ST2", "Interdiario", "Regular", "Bimensual", "Niños", "Kids", "LARGE"),
    ("LARGE", "Basic 3", "SY", "Interdiario", "Regular", "Mensual", "Niños", "Kids", "END"),
    ("ECONOMY", "Teens 1", "IST", "Diario", "Intensivo", "Mensual", "Jóvenes", "Adults", "STANDARD"),
    ("STANDARD", "Teens 2", "ADV", "Diario", "Intensivo", "Mensual", "Adultos", "Adults", "PROMO"),
    ("PROMO", "Summer", "ADV", "Diario", "Intensivo", "Mensual", "Adultos", "Adults", None),
]
SEASONAL_COURSES = ("PROMO",)
INITIAL_COURSES = ("Basic 1", "Teens 1")
SEASONAL_COURSE_MAP = [("PROMO", "STANDARD")]
CODE_SUFFIXES = ("", "p", "PV", "hd", "pv")
SLOT_TURNS = {
    # HORARIO_ACTUAL: (TURNO_1, TURNO_2)
    "1-URGENT": ("07:00 - 08:30", None),
    "2-HIGH": ("08:45 - 10:15", None),
    "3-MEDIUM": ("10:30 - 12:00", None),
    "4-NOT SPECIFIED": ("19:00 - 19:45", "19:45 - 20:30"),
    "5-LOW": ("20:45 - 22:15", None),
}
SLOT_HOURS = {"1-URGENT": (7.0, 8.5), "2-HIGH": (8.75, 10.25), "3-MEDIUM": (10.5, 12.0),
              "4-NOT SPECIFIED": (19.0, 20.5), "5-LOW": (20.75, 22.25)}
ORDER_STATUSES = ("F", "O", "P")
SEASONAL_SLOT_MAP = [("1-URGENT", "5-LOW"), ("2-HIGH", "5-LOW"), ("3-MEDIUM", "4-NOT SPECIFIED"),
                     ("4-NOT SPECIFIED", "4-NOT SPECIFIED"), ("5-LOW", "5-LOW")]
SITE_HOURS = {"AFRICA": (7.0, 22.25), "AMERICA": (8.0, 22.25), "ASIA": (7.0, 20.5),
              "EUROPE": (7.0, 22.25), "MIDDLE EAST": (8.75, 20.5)}
SUMMER_LATE_OPENING = ("ASIA", (6, 7, 8), 8.0)
LEVEL_LINE_SEATS = {("ST1", "Kids"): 16, ("ST2", "Kids"): 16, ("SY", "Kids"): 18,
                    ("IST", "Adults"): 20, ("ADV", "Adults"): 22}
CALENDAR_SPAN = (199301, 200312)
SHIFT_MONTHS = 28 * 12          # production calendar -> driver calendar
# ---------------------------------------------------------------------------


def _shifted_blackout() -> tuple:
    rows = []
    for (family, use), sites in BLACKOUT.items():
        for site, new_site in (("Ica", "ASIA"), ("Pucallpa", "EUROPE")):
            rows.extend((family, use, new_site, from_ord(to_ord(m) - SHIFT_MONTHS)) for m in sites[site])
    return tuple(rows)


PARAMS = Params(
    cancelled_state="R",
    excluded_site="VECOR",
    excluded_level="Corporate",
    satellite_sites=("AFRICA Satélite", "AMERICA Satélite", "ASIA Satélite", "EUROPE Satélite",
                     "MIDDLE EAST Satélite"),
    site_prefix_to_strip="Provincias - ",
    site_merge_sources=("ASIA 2", "ASIA"),
    site_merge_target="ASIA",
    suffix_cutover_period=199609,
    history_start_period=199411,
    training_start_period=199603,
    terminal_course="END",
    march_day_slots=("1-URGENT", "2-HIGH", "3-MEDIUM"),
    blackout=_shifted_blackout(),
)
TARGET_RANGE = (199603, 200112)       # training start .. month after the last data month
FULL_RANGE = (199501, 200112)


# ---- catalogue rows (rule-generated) --------------------------------------

def calendar() -> list[int]:
    lo, hi = CALENDAR_SPAN
    return [from_ord(o) for o in range(to_ord(lo), to_ord(hi) + 1)]


def course_rows():
    return list(COURSES)


def course_map_rows():
    return [(t + s, t, 1 if t in SEASONAL_COURSES else 0) for (t, *_rest) in COURSES for s in CODE_SUFFIXES]


def initial_rows():
    return [(c,) for c in INITIAL_COURSES]


def seasonal_course_map_rows():
    return list(SEASONAL_COURSE_MAP)


def seasonal_slot_map_rows():
    return list(SEASONAL_SLOT_MAP)


def raw_slot_rows():
    """Raw slot sheet: HORARIO, HORARIO_ACTUAL, TURNO_1..TURNO_4 (identity rows + priority/status rows)."""
    rows = []
    for slot, (t1, t2) in SLOT_TURNS.items():
        rows.append((slot, slot, t1, t2, None, None))
        for st in ORDER_STATUSES:
            rows.append((f"{slot}/{st}", slot, t1, t2, None, None))
    return rows


def slot_rows():
    """Slot catalogue after A4: HORARIO, HORARIO_ACTUAL, HORA_MIN, HORA_MAX."""
    return [(h, a, SLOT_HOURS[a][0], SLOT_HOURS[a][1]) for (h, a, *_t) in raw_slot_rows()]


def site_hours_rows():
    site, months, late = SUMMER_LATE_OPENING
    rows = []
    for p in calendar():
        for s, (lo, hi) in SITE_HOURS.items():
            rows.append((p, s, late if (s == site and p % 100 in months) else lo, hi))
    return rows


def seats_rows():
    return [(p, lvl, line, v) for p in calendar() for (lvl, line), v in LEVEL_LINE_SEATS.items()]


def pe_rows():
    return [(p, prog, (8 if prog == "Niños" else 10) + (1 if p >= 199801 else 0))
            for p in calendar() for prog in ("Niños", "Adultos")]


DIM_SPECS = {
    "courses": (course_rows, "CURSO_ACTUAL string, CURSO_2 string, NIVEL string, FRECUENCIA string, "
                             "INTENSIDAD string, DURACION string, PROGRAMA string, LINEA_DE_NEGOCIO string, "
                             "`POSTERIOR_(+1)` string"),
    "course_map": (course_map_rows, "CURSO_ANTERIOR string, CURSO_ACTUAL string, FLAG_ESTACIONAL int"),
    "initial_courses": (initial_rows, "CURSOS_INICIALES string"),
    "seasonal_course_map": (seasonal_course_map_rows, "CURSO_ACTUAL string, `POSTERIOR_(+1)` string"),
    "seasonal_slot_map": (seasonal_slot_map_rows, "HORARIO string, `HORARIO_(+1)` string"),
    "slots": (slot_rows, "HORARIO string, HORARIO_ACTUAL string, HORA_MIN double, HORA_MAX double"),
    "site_hours": (site_hours_rows, "PERIODO int, SEDE string, HORA_MIN double, HORA_MAX double"),
    "seats": (seats_rows, "PERIODO int, NIVEL string, LINEA_DE_NEGOCIO string, VAC_ACAD_ESTANDAR int"),
    "pe": (pe_rows, "PERIODO int, PROGRAMA string, PE int"),
}


_DIMS_CACHE: dict = {}


def dims(spark: SparkSession) -> Dims:
    """Catalogue tables as in-plan ``VALUES`` (JVM local relations with exact size statistics)."""
    key = id(spark)
    if key not in _DIMS_CACHE:
        tables, rows = {}, {}
        for name, (fn, schema) in DIM_SPECS.items():
            data = fn()
            tables[name] = spark.sql(values_sql(data, schema, quote="`"))
            rows[name] = len(data)
        _DIMS_CACHE[key] = Dims(tables, rows)
    return _DIMS_CACHE[key]


# ---- fact views ------------------------------------------------------------

_READS: dict = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One reader per (session, table): file listing and footers are resolved once."""
    key = (id(spark), sf_dir, name)
    if key not in _READS:
        _READS[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _READS[key]


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                                                "l_returnflag", "l_shipdate")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    geo = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .join(p, li.l_partkey == p.p_partkey)
              .join(geo, li.l_suppkey == geo.s_suppkey))


def class_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean stand-in facts: PERIODO, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, CANT_MATRICULADOS, ESTADO."""
    j = _joined(spark, sf_dir)
    return j.select(period_of_timestamp("l_shipdate").alias("PERIODO"), F.col("r_name").alias("SEDE"),
                    F.col("p_type").alias("CURSO_ACTUAL"), F.col("o_orderpriority").alias("HORARIO_ACTUAL"),
                    F.col("l_quantity").cast("int").alias("CANT_MATRICULADOS"),
                    F.col("l_returnflag").alias("ESTADO"))


def raw_class_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw stand-in facts (before F1-F3, J1, J2): PERIODO, SEDE, NIVEL, CODIGO_DE_CURSO, HORARIO,
    CANT_MATRICULADOS, ESTADO."""
    j = _joined(spark, sf_dir)
    site = (F.when(F.col("n_nationkey") == 24, F.lit("VECOR"))
             .when(F.col("n_nationkey") == 23, F.concat(F.col("r_name"), F.lit(" Satélite")))
             .when(F.col("n_nationkey") % 5 == 0, F.concat(F.lit("Provincias - "), F.col("r_name")))
             .when((F.col("r_name") == "ASIA") & (F.col("n_nationkey") % 2 == 1), F.lit("ASIA 2"))
             .otherwise(F.col("r_name")))
    suffix = (F.when(F.col("p_size") % 10 == 0, "p").when(F.col("p_size") % 10 == 1, "PV")
               .when(F.col("p_size") % 10 == 2, "hd").when(F.col("p_size") % 10 == 3, "pv").otherwise(""))
    return j.select(period_of_timestamp("l_shipdate").alias("PERIODO"), site.alias("SEDE"),
                    F.when(F.col("p_size") >= 49, "Corporate").otherwise("Regular").alias("NIVEL"),
                    F.concat(F.col("p_type"), suffix).alias("CODIGO_DE_CURSO"),
                    F.concat(F.col("o_orderpriority"), F.lit("/"), F.col("o_orderstatus")).alias("HORARIO"),
                    F.col("l_quantity").cast("int").alias("CANT_MATRICULADOS"),
                    F.col("l_returnflag").alias("ESTADO"))


def raw_synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planner rows from pending orders: PERIODO, SEDE, CODIGO_DE_CURSO, HORARIO, CANT_CLASES, CANT_ALUMNOS."""
    o = read(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P").select(
        "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
          .join(r, n.n_regionkey == r.r_regionkey))
    types = [t for (t, *_r) in COURSES]
    code = None
    for i, t in enumerate(types):
        cond = F.col("o_custkey") % len(types) == i
        code = F.when(cond, F.lit(t)) if code is None else code.when(cond, F.lit(t))
    return j.select(period_of_timestamp("o_orderdate").alias("PERIODO"), F.col("r_name").alias("SEDE"),
                    code.alias("CODIGO_DE_CURSO"),
                    F.concat(F.col("o_orderpriority"), F.lit("/"), F.col("o_orderstatus")).alias("HORARIO"),
                    F.lit(1).alias("CANT_CLASES"),
                    (F.floor(F.col("o_totalprice") / 10000) % 30).cast("int").alias("CANT_ALUMNOS"))


def synthetic_cells(spark: SparkSession, sf_dir: str, dm: Dims) -> DataFrame:
    """Synthetic roll-up (J1, J2, A2) of the planner rows."""
    from ..operators import enrich, rollup
    s = enrich.recode_slot(enrich.recode_course(raw_synthetic(spark, sf_dir), dm), dm)
    return rollup.synthetic_rollup(s)


# Shared base of one query: built once, checkpointed, reused by every branch of the plan.
_BASE: dict = {}


def reset_base() -> None:
    """Forget the shared base (called at the start of every registered query)."""
    _BASE.clear()


def regular(spark: SparkSession, sf_dir: str, dm: Dims, include_seasonal: bool = False) -> DataFrame:
    """C1's fact cells + synthetic cells (A2), regrouped (A3), with course flags (J3): every family starts from the
    platinum layer.

    It is computed once per query and written to the shared checkpoint folder, so later stages neither recompute
    the fact joins nor depend on executors that computed them, and read only the columns they need.
    """
    from ..operators import rollup
    from ..plans import platinum
    from ..session import cut_lineage
    key = (id(spark), sf_dir, id(dm))
    if key not in _BASE:
        facts = platinum.facts_rollup(raw_class_rows(spark, sf_dir), dm, PARAMS)
        full = rollup.regular_facts(facts, synthetic_cells(spark, sf_dir, dm), dm, include_seasonal=True)
        _BASE[key] = cut_lineage(full)
    full = _BASE[key]
    return full if include_seasonal else full.where(F.col("FLAG_ESTACIONAL") == 0)


# ---- SQL rendering for the oracle -------------------------------------------

from .local import SQL_TYPES, SPARK_TYPES, values_sql  # noqa: E402,F401
from .local import sql_literal as _sql_lit  # noqa: E402,F401


def dim_sql(name: str) -> str:
    fn, schema = DIM_SPECS[name]
    return values_sql(fn(), schema)


def blackout_sql(params: Params = PARAMS) -> str:
    return values_sql(list(params.blackout), "TIPO string, USE string, SEDE string, PERIODO_TARGET int")


CLASS_ROWS_SQL = """
(SELECT CAST(year(l.l_shipdate) * 100 + month(l.l_shipdate) AS INTEGER) AS PERIODO,
        r.r_name AS SEDE, p.p_type AS CURSO_ACTUAL, o.o_orderpriority AS HORARIO_ACTUAL,
        CAST(l.l_quantity AS INTEGER) AS CANT_MATRICULADOS, l.l_returnflag AS ESTADO
   FROM lineitem l
   JOIN orders o ON l.l_orderkey = o.o_orderkey
   JOIN part p ON l.l_partkey = p.p_partkey
   JOIN supplier s ON l.l_suppkey = s.s_suppkey
   JOIN nation n ON s.s_nationkey = n.n_nationkey
   JOIN region r ON n.n_regionkey = r.r_regionkey)"""

RAW_CLASS_ROWS_SQL = """
(SELECT CAST(year(l.l_shipdate) * 100 + month(l.l_shipdate) AS INTEGER) AS PERIODO,
        CASE WHEN n.n_nationkey = 24 THEN 'VECOR'
             WHEN n.n_nationkey = 23 THEN r.r_name || ' Satélite'
             WHEN n.n_nationkey % 5 = 0 THEN 'Provincias - ' || r.r_name
             WHEN r.r_name = 'ASIA' AND n.n_nationkey % 2 = 1 THEN 'ASIA 2'
             ELSE r.r_name END AS SEDE,
        CASE WHEN p.p_size >= 49 THEN 'Corporate' ELSE 'Regular' END AS NIVEL,
        p.p_type || CASE p.p_size % 10 WHEN 0 THEN 'p' WHEN 1 THEN 'PV' WHEN 2 THEN 'hd'
                                       WHEN 3 THEN 'pv' ELSE '' END AS CODIGO_DE_CURSO,
        o.o_orderpriority || '/' || o.o_orderstatus AS HORARIO,
        CAST(l.l_quantity AS INTEGER) AS CANT_MATRICULADOS, l.l_returnflag AS ESTADO
   FROM lineitem l
   JOIN orders o ON l.l_orderkey = o.o_orderkey
   JOIN part p ON l.l_partkey = p.p_partkey
   JOIN supplier s ON l.l_suppkey = s.s_suppkey
   JOIN nation n ON s.s_nationkey = n.n_nationkey
   JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def raw_synthetic_sql() -> str:
    types = [t for (t, *_r) in COURSES]
    case = " ".join(f"WHEN o.o_custkey % {len(types)} = {i} THEN '{t}'" for i, t in enumerate(types))
    return f"""
(SELECT CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS INTEGER) AS PERIODO,
        r.r_name AS SEDE, CASE {case} END AS CODIGO_DE_CURSO,
        o.o_orderpriority || '/' || o.o_orderstatus AS HORARIO,
        1 AS CANT_CLASES, CAST(floor(o.o_totalprice / 10000) % 30 AS INTEGER) AS CANT_ALUMNOS
   FROM orders o
   JOIN customer c ON o.o_custkey = c.c_custkey
   JOIN nation n ON c.c_nationkey = n.n_nationkey
   JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE o.o_orderstatus = 'P')"""


def _in(values) -> str:
    return "(" + ", ".join(_sql_lit(v) for v in values) + ")"


def f1_sql(alias: str = "r") -> str:
    code, p = f"{alias}.CODIGO_DE_CURSO", PARAMS
    return (f"{alias}.ESTADO <> '{p.cancelled_state}' AND {alias}.SEDE <> '{p.excluded_site}' "
            f"AND {alias}.NIVEL <> '{p.excluded_level}' "
            f"AND NOT (length({code}) > 2 AND upper(right({code}, 2)) IN ('HD', 'PV')) "
            f"AND NOT (length({code}) > 1 AND upper(right({code}, 1)) = 'P' "
            f"AND {alias}.PERIODO < {p.suffix_cutover_period})")


def f2_sql(alias: str = "r") -> str:
    return f"NOT COALESCE({alias}.SEDE IN {_in(PARAMS.satellite_sites)}, FALSE)"


def f3_sql(alias: str = "r") -> str:
    stripped = f"replace({alias}.SEDE, '{PARAMS.site_prefix_to_strip}', '')"
    return (f"CASE WHEN COALESCE({stripped} IN {_in(PARAMS.site_merge_sources)}, FALSE) "
            f"THEN '{PARAMS.site_merge_target}' ELSE {stripped} END")


def platinum_sql() -> str:
    """SQL of C1's fact cells: F1, F2, F3, J1, J2, A1."""
    return f"""
SELECT PERIODO, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, COUNT(*) AS CANT_CLASES,
       CAST(SUM(CANT_MATRICULADOS) AS BIGINT) AS CANT_ALUMNOS
  FROM (SELECT c.PERIODO, c.SEDE, cm.CURSO_ACTUAL, sl.HORARIO_ACTUAL, c.CANT_MATRICULADOS
          FROM (SELECT r.PERIODO, {f3_sql('r')} AS SEDE, r.CODIGO_DE_CURSO, r.HORARIO, r.CANT_MATRICULADOS
                  FROM {RAW_CLASS_ROWS_SQL} r WHERE {f1_sql('r')} AND {f2_sql('r')}) c
          JOIN {dim_sql('course_map')} cm ON c.CODIGO_DE_CURSO = cm.CURSO_ANTERIOR
          JOIN {dim_sql('slots')} sl ON c.HORARIO = sl.HORARIO) x
 WHERE PERIODO IS NOT NULL AND SEDE IS NOT NULL AND CURSO_ACTUAL IS NOT NULL AND HORARIO_ACTUAL IS NOT NULL
 GROUP BY PERIODO, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL"""


def regular_sql(include_seasonal: bool = False) -> str:
    """SQL of ``regular``: C1's cells + synthetic (J1 J2 A2) regrouped (A3) with flags."""
    seasonal = "" if include_seasonal else "WHERE FLAG_ESTACIONAL = 0"
    return f"""
(WITH facts AS ({platinum_sql()}),
 synth AS (
   SELECT s.PERIODO, s.SEDE, cm.CURSO_ACTUAL, sl.HORARIO_ACTUAL,
          SUM(s.CANT_CLASES) AS CANT_CLASES, SUM(s.CANT_ALUMNOS) AS CANT_ALUMNOS
     FROM {raw_synthetic_sql()} s
     JOIN {dim_sql('course_map')} cm ON s.CODIGO_DE_CURSO = cm.CURSO_ANTERIOR
     JOIN {dim_sql('slots')} sl ON s.HORARIO = sl.HORARIO
    WHERE s.PERIODO IS NOT NULL AND s.SEDE IS NOT NULL
    GROUP BY s.PERIODO, s.SEDE, cm.CURSO_ACTUAL, sl.HORARIO_ACTUAL),
 u AS (
   SELECT PERIODO, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, SUM(CANT_ALUMNOS) AS CANT_ALUMNOS,
          SUM(CANT_CLASES) AS CANT_CLASES
     FROM (SELECT * FROM facts UNION ALL SELECT * FROM synth) x
    GROUP BY PERIODO, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL),
 flagged AS (
   SELECT u.*, cm.FLAG_ESTACIONAL,
          CASE WHEN c.CURSO_2 IN (SELECT CURSOS_INICIALES FROM {dim_sql('initial_courses')} ic) THEN 1 ELSE 0 END
            AS FLAG_INICIAL
     FROM u
     JOIN {dim_sql('course_map')} cm ON u.CURSO_ACTUAL = cm.CURSO_ANTERIOR
     JOIN {dim_sql('courses')} c ON u.CURSO_ACTUAL = c.CURSO_ACTUAL)
 SELECT * FROM flagged {seasonal})"""
