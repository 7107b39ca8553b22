"""Driver-table queries for the ETL layer (S*, F1-F5, J1-J2, A1-A5, R1-R2, X1-X5, Q*)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.periods import period_of_timestamp, shift_period
from ..functions.scalars import level_of, course_index_of
from ..operators import clean, enrich, quality, reshape, rollup
from ..plans import platinum
from ..session import ensure_checkpoint_dir
from ..sources import driver as drv
from ..sources import ingest, sinks
from .families import _dims_sql
from .registry import in_list, query, shift_sql

P = drv.PARAMS


_f1_sql, _f2_sql, _f3_sql, _platinum_sql = drv.f1_sql, drv.f2_sql, drv.f3_sql, drv.platinum_sql


@query("platinum_rollup", _platinum_sql)
def platinum_rollup(spark, sf_dir):
    """C1 facts: F1, F2, F3, J1, J2 then A1 -- classes counted and students summed per cell."""
    return platinum.facts_rollup(drv.raw_class_rows(spark, sf_dir), drv.dims(spark), P)


def _sale_filter_sql() -> str:
    return f"""
WITH raw AS {drv.RAW_CLASS_ROWS_SQL}
SELECT PERIODO, SEDE, CODIGO_DE_CURSO, ESTADO, NIVEL, COUNT(*) AS N_ROWS,
       CAST(SUM(CANT_MATRICULADOS) AS BIGINT) AS CANT_ALUMNOS
  FROM raw r WHERE {_f1_sql('r')} AND {_f2_sql('r')}
 GROUP BY PERIODO, SEDE, CODIGO_DE_CURSO, ESTADO, NIVEL"""


@query("sale_filter", _sale_filter_sql)
def sale_filter(spark, sf_dir):
    """F1 + F2: regular-sale rows (cancelled, excluded site, corporate, suffix rules, satellites dropped)."""
    raw = drv.raw_class_rows(spark, sf_dir)
    kept = clean.drop_satellites(clean.regular_sale(raw, P), P)
    return kept.groupBy("PERIODO", "SEDE", "CODIGO_DE_CURSO", "ESTADO", "NIVEL").agg(
        F.count(F.lit(1)).alias("N_ROWS"), F.sum("CANT_MATRICULADOS").cast("long").alias("CANT_ALUMNOS"))


def _site_canonical_sql() -> str:
    return f"""
WITH raw AS {drv.RAW_CLASS_ROWS_SQL}
SELECT r.SEDE AS SEDE_RAW, {_f3_sql('r')} AS SEDE, COUNT(*) AS N_ROWS
  FROM raw r GROUP BY r.SEDE, {_f3_sql('r')}"""


@query("site_canonical", _site_canonical_sql)
def site_canonical(spark, sf_dir):
    """F3 + X5: raw site labels and their canonical site, with row counts."""
    raw = drv.raw_class_rows(spark, sf_dir)
    return (raw.select(F.col("SEDE").alias("SEDE_RAW"), clean.canonical_site("SEDE", P).alias("SEDE"))
               .groupBy("SEDE_RAW", "SEDE").agg(F.count(F.lit(1)).alias("N_ROWS")))


def _course_recode_sql() -> str:
    return f"""
WITH {_dims_sql()},
raw AS {drv.RAW_CLASS_ROWS_SQL}
SELECT r.CODIGO_DE_CURSO, r.HORARIO, cm.CURSO_ACTUAL, sl.HORARIO_ACTUAL, COUNT(*) AS N_ROWS,
       CASE WHEN cm.CURSO_ACTUAL IS NULL OR sl.HORARIO_ACTUAL IS NULL THEN 1 ELSE 0 END AS MISS
  FROM raw r
  LEFT JOIN (SELECT * FROM d_course_map WHERE NOT (CURSO_ANTERIOR LIKE '%pv')) cm
         ON r.CODIGO_DE_CURSO = cm.CURSO_ANTERIOR
  LEFT JOIN d_slots sl ON r.HORARIO = sl.HORARIO
 GROUP BY r.CODIGO_DE_CURSO, r.HORARIO, cm.CURSO_ACTUAL, sl.HORARIO_ACTUAL"""


@query("course_recode", _course_recode_sql)
def course_recode(spark, sf_dir):
    """J1 + J2 + Q1 report: raw codes recoded; a map without the lower-case 'pv' codes shows the misses."""
    dm = drv.dims(spark)
    from ..sources.dims import Dims
    cut = Dims(dict(dm.tables, course_map=dm["course_map"].where(~F.col("CURSO_ANTERIOR").like("%pv"))), dict(dm.rows))
    raw = drv.raw_class_rows(spark, sf_dir)
    rec = enrich.recode_slot(enrich.recode_course(raw, cut, strict=False), cut, strict=False)
    return (rec.groupBy("CODIGO_DE_CURSO", "HORARIO", "CURSO_ACTUAL", "HORARIO_ACTUAL")
               .agg(F.count(F.lit(1)).alias("N_ROWS"))
               .withColumn("MISS", F.when(F.col("CURSO_ACTUAL").isNull() | F.col("HORARIO_ACTUAL").isNull(), 1)
                           .otherwise(0)))


def _union_sql() -> str:
    return f"""
WITH {_dims_sql()}
SELECT PERIODO, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, CAST(CANT_ALUMNOS AS BIGINT) AS CANT_ALUMNOS,
       CAST(CANT_CLASES AS BIGINT) AS CANT_CLASES, FLAG_ESTACIONAL, FLAG_INICIAL
  FROM {drv.regular_sql(include_seasonal=True)} u"""


@query("union_rollup", _union_sql)
def union_rollup(spark, sf_dir):
    """A2 + A3 + O4 + J3: synthetic roll-up unioned with the fact roll-up, regrouped, course flags added."""
    dm = drv.dims(spark)
    return drv.regular(spark, sf_dir, dm, include_seasonal=True).select(
        "PERIODO", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL", "CANT_ALUMNOS", "CANT_CLASES", "FLAG_ESTACIONAL",
        "FLAG_INICIAL")


# ---- raw sheets derived from the driver tables ---------------------------------

def _turn(h):
    return F.concat(F.lpad(h.cast("string"), 2, "0"), F.lit(":00 - "), F.lpad(h.cast("string"), 2, "0"),
                    F.lit(":30"))


def raw_slot_sheet(spark, sf_dir):
    """Raw slot sheet rows from orders: HORARIO, TURNO_1 (slot's own turn), TURNO_2 (data-dependent) ..."""
    o = drv.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    t1 = None
    for slot_, (a, _b) in drv.SLOT_TURNS.items():
        cond = F.col("o_orderpriority") == slot_
        t1 = F.when(cond, F.lit(a)) if t1 is None else t1.when(cond, F.lit(a))
    t2 = F.when(F.col("o_orderstatus") == "O", _turn(F.lit(7) + F.col("o_orderkey") % 15))
    return o.select(F.concat("o_orderpriority", F.lit("/"), "o_orderstatus").alias("HORARIO"),
                    t1.alias("TURNO_1"), t2.alias("TURNO_2"), F.lit(None).cast("string").alias("TURNO_3"),
                    F.lit(None).cast("string").alias("TURNO_4"))


def _turn_sql(h: str) -> str:
    return f"(lpad(CAST({h} AS VARCHAR), 2, '0') || ':00 - ' || lpad(CAST({h} AS VARCHAR), 2, '0') || ':30')"


def _hours_sql(col: str, which: str) -> str:
    pat = r"'(\d{2}):(\d{2}) - (\d{2}):(\d{2})'"
    a, b = (1, 2) if which == "start" else (3, 4)
    return (f"(CAST(regexp_extract({col}, {pat}, {a}) AS INTEGER) "
            f"+ CAST(regexp_extract({col}, {pat}, {b}) AS INTEGER) / CAST(60 AS DOUBLE))")


def _slot_hours_sql() -> str:
    case = " ".join(f"WHEN o_orderpriority = '{s}' THEN '{a}'" for s, (a, _b) in drv.SLOT_TURNS.items())
    return f"""
WITH sheet AS (
  SELECT o_orderpriority || '/' || o_orderstatus AS HORARIO, CASE {case} END AS TURNO_1,
         CASE WHEN o_orderstatus = 'O' THEN {_turn_sql('7 + o_orderkey % 15')} END AS TURNO_2
    FROM orders),
turns AS (SELECT HORARIO, TURNO_1 AS FRANJA FROM sheet WHERE TURNO_1 IS NOT NULL
          UNION ALL SELECT HORARIO, TURNO_2 FROM sheet WHERE TURNO_2 IS NOT NULL)
SELECT HORARIO, MIN({_hours_sql('FRANJA', 'start')}) AS HORA_MIN, MAX({_hours_sql('FRANJA', 'end')}) AS HORA_MAX
  FROM turns GROUP BY HORARIO"""


@query("slot_hours", _slot_hours_sql)
def slot_hours(spark, sf_dir):
    """R1 + X1 + A4: slot sheet turns unpivoted, parsed to decimal hours, earliest start / latest end."""
    sheet = raw_slot_sheet(spark, sf_dir)
    turns = reshape.unpivot_turns(sheet).select(
        "HORARIO", F.col("FRANJA"))
    from ..functions.scalars import slot_end_hours, slot_start_hours
    return rollup.hours_span(turns.select("HORARIO", slot_start_hours("FRANJA").alias("S"),
                                          slot_end_hours("FRANJA").alias("E")), ["HORARIO"], "S", "E")


def raw_availability_sheet(spark, sf_dir):
    """Raw opening-hours sheet from line items: SEDE, PERIODO_FRANJA, FRANJA, YEAR, month flags 1..12."""
    li = drv.read(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_shipdate")
    s = drv.read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = drv.read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = drv.read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    j = li.join(geo, li.l_suppkey == geo.s_suppkey)
    h0 = F.lit(5) + F.col("l_linenumber")
    franja = F.concat(F.lpad(h0.cast("string"), 2, "0"), F.lit(":00 - "),
                      F.lpad((h0 + 8).cast("string"), 2, "0"), F.lit(":00"))
    x = j.select(F.col("r_name").alias("SEDE"),
                 F.when(F.col("l_linenumber") % 2 == 0, "Tarde").otherwise("Mañana").alias("PERIODO_FRANJA"),
                 franja.alias("FRANJA"), F.year("l_shipdate").alias("YEAR"), F.month("l_shipdate").alias("M"))
    g = x.groupBy("SEDE", "PERIODO_FRANJA", "FRANJA", "YEAR").agg(
        *[F.sum(F.when(F.col("M") == m, 1).otherwise(0)).alias(str(m)) for m in range(1, 13)])
    for m in range(1, 13):
        c = F.col(f"`{m}`")
        g = g.withColumn(str(m), F.when(c == 0, 0).when(c == 1, F.lit(None)).otherwise(c % 3))
    return g


def _site_hours_sql() -> str:
    months = ", ".join(f"SUM(CASE WHEN M = {m} THEN 1 ELSE 0 END) AS m{m}" for m in range(1, 13))
    flags = " UNION ALL ".join(
        f"SELECT SEDE, FRANJA, YEAR, {m} AS MONTH, CASE WHEN m{m} = 0 THEN 0 WHEN m{m} = 1 THEN NULL "
        f"ELSE m{m} % 3 END AS FLAG FROM sheet" for m in range(1, 13))
    return f"""
WITH x AS (
  SELECT r.r_name AS SEDE, CASE WHEN l.l_linenumber % 2 = 0 THEN 'Tarde' ELSE 'Mañana' END AS PERIODO_FRANJA,
         lpad(CAST(5 + l.l_linenumber AS VARCHAR), 2, '0') || ':00 - ' || lpad(CAST(13 + l.l_linenumber AS VARCHAR), 2, '0')
           || ':00' AS FRANJA, year(l.l_shipdate) AS YEAR, month(l.l_shipdate) AS M
    FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey),
sheet AS (SELECT SEDE, PERIODO_FRANJA, FRANJA, YEAR, {months} FROM x GROUP BY SEDE, PERIODO_FRANJA, FRANJA, YEAR),
longf AS ({flags})
SELECT CAST(YEAR * 100 + MONTH AS INTEGER) AS PERIODO, SEDE, MIN({_hours_sql('FRANJA', 'start')}) AS HORA_MIN,
       MAX({_hours_sql('FRANJA', 'end')}) AS HORA_MAX
  FROM longf WHERE FLAG IS DISTINCT FROM 0 GROUP BY YEAR * 100 + MONTH, SEDE"""


@query("site_hours", _site_hours_sql)
def site_hours(spark, sf_dir):
    """R2 + F4 + X2 + X1 + A5: month flags unpivoted, unavailable months dropped, opening hours per (month, site)."""
    return reshape.site_hours(raw_availability_sheet(spark, sf_dir))


# ---- headers, schema, calendar -------------------------------------------------

MESSY_PART_HEADERS = {"p_partkey": " Código Parte ", "p_name": "nombre.", "p_brand": "Marca  Comercial",
                      "p_type": "Tipo", "p_size": " tamaño", "p_retailprice": "Precio. Público"}


def _header_sql() -> str:
    cols = ", ".join(f"{c} AS {ingest.normalise_name(m)}" for c, m in MESSY_PART_HEADERS.items())
    return f"SELECT {cols} FROM part"


@query("header_normalise", _header_sql)
def header_normalise(spark, sf_dir):
    """A sheet with messy headers (spaces, dots, accents, case) normalised to canonical names."""
    part = drv.read(spark, sf_dir, "part")
    messy = part.select(*[F.col(c).alias(m) for c, m in MESSY_PART_HEADERS.items()])
    return ingest.normalise_headers(messy)


def _schema_sql() -> str:
    return f"""
WITH raw AS {drv.RAW_CLASS_ROWS_SQL}
SELECT CAST(CAST(PERIODO AS VARCHAR) AS INTEGER) AS PERIODO, PERIODO // 100 AS YEAR, PERIODO % 100 AS MONTH,
       SEDE, CODIGO_DE_CURSO, HORARIO, CAST(CAST(CANT_MATRICULADOS AS VARCHAR) AS INTEGER) AS CANT_MATRICULADOS,
       CAST(CAST(CANT_MATRICULADOS AS VARCHAR) AS DOUBLE) AS AFORO, ESTADO
  FROM raw"""


@query("schema_cast", _schema_sql)
def schema_cast(spark, sf_dir):
    """S2 + S3 + X4: raw rows as strings cast to the declared schema, year / month split of the month key."""
    from pyspark.sql import types as T
    raw = drv.raw_class_rows(spark, sf_dir)
    as_text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns],
                         F.col("CANT_MATRICULADOS").cast("string").alias("AFORO"))
    schema = T.StructType([f for f in ingest.RAW_CLASS_SCHEMA.fields
                           if f.name in ("PERIODO", "SEDE", "CODIGO_DE_CURSO", "HORARIO", "CANT_MATRICULADOS",
                                         "AFORO", "ESTADO")])
    typed = ingest.cast_to_schema(as_text, schema)
    return typed.select("PERIODO", F.floor(F.col("PERIODO") / 100).cast("int").alias("YEAR"),
                        (F.col("PERIODO") % 100).alias("MONTH"), "SEDE", "CODIGO_DE_CURSO", "HORARIO",
                        "CANT_MATRICULADOS", "AFORO", "ESTADO")


def calendar_rows(spark, sf_dir):
    """Run calendar from orders: the month after each order month runs on the order date."""
    o = drv.read(spark, sf_dir, "orders").select("o_orderdate")
    return o.select(shift_period(period_of_timestamp("o_orderdate"), -1).alias("periodo"),
                    F.to_date("o_orderdate").alias("fecha")).distinct()


CALENDAR_DATES = ("1997-05-28", "1999-01-16", "2030-01-01")


def _calendar_sql() -> str:
    parts = []
    for d in CALENDAR_DATES:
        parts.append(f"""SELECT DATE '{d}' AS as_of, COUNT(*) > 0 AS should_run,
       COALESCE(MIN({shift_sql('CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER)', -1)}), -1) AS periodo
  FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '{d}'""")
    return "\nUNION ALL\n".join(parts)


@query("calendar_gate", _calendar_sql)
def calendar_gate(spark, sf_dir):
    """Should the monthly run start on a given date, and for which month."""
    cal = calendar_rows(spark, sf_dir)
    out = None
    for d in CALENDAR_DATES:
        g = ingest.calendar_gate(cal, d).select(F.to_date(F.lit(d)).alias("as_of"), "should_run", "periodo")
        out = g if out is None else out.unionByName(g)
    return out


# ---- data quality ----------------------------------------------------------------

def _dup_sql() -> str:
    return f"""
WITH {_dims_sql()},
cm AS (SELECT CURSO_ANTERIOR, CURSO_ACTUAL FROM d_course_map
       UNION ALL SELECT p_type || '-' || CAST(p_size % 3 AS VARCHAR), p_type FROM part)
SELECT CURSO_ANTERIOR, COUNT(*) AS N_ROWS FROM cm GROUP BY CURSO_ANTERIOR HAVING COUNT(*) > 1"""


@query("dim_key_duplicates", _dup_sql)
def dim_key_duplicates(spark, sf_dir):
    """Q2 + F19: duplicate keys of a course map extended with codes derived from every part row."""
    dm = drv.dims(spark)
    part = drv.read(spark, sf_dir, "part")
    extra = part.select(F.concat("p_type", F.lit("-"), (F.col("p_size") % 3).cast("string")).alias("CURSO_ANTERIOR"),
                        F.col("p_type").alias("CURSO_ACTUAL"))
    cm = dm["course_map"].select("CURSO_ANTERIOR", "CURSO_ACTUAL").unionByName(extra)
    return quality.duplicate_keys(cm, ["CURSO_ANTERIOR"])


def _level_split_sql() -> str:
    return f"""
SELECT p_partkey, p_name, 'L_' || regexp_replace(p_name, '(.+) (.+)', '\\1') AS LEVEL,
       'IC_' || regexp_replace(p_name, '(.+) (.+)', '\\2') AS IDX_CURSO
  FROM part"""


@query("level_split", _level_split_sql)
def level_split(spark, sf_dir):
    """Level / index split at the last space (whole text when there is none), over every part name."""
    part = drv.read(spark, sf_dir, "part")
    return part.select("p_partkey", "p_name", level_of("p_name").alias("LEVEL"), course_index_of("p_name").alias("IDX_CURSO"))


# ---- sinks: write to the shared checkpoint folder and read back --------------------

def _scratch(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/cohortcast-{uuid.uuid4().hex}"


def _overwrite_sql() -> str:
    return _platinum_sql().replace(
        "SELECT PERIODO, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, COUNT(*) AS CANT_CLASES,",
        "SELECT PERIODO, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, "
        "CAST(COUNT(*) * CASE WHEN PERIODO // 100 = 1998 THEN 2 ELSE 1 END AS BIGINT) AS CANT_CLASES,")


@query("partition_overwrite", _overwrite_sql)
def partition_overwrite(spark, sf_dir):
    """S8 + S9: write all months, rewrite 1998 only (dynamic partition overwrite), read back."""
    root = _scratch(spark)
    cells = platinum.facts_rollup(drv.raw_class_rows(spark, sf_dir), drv.dims(spark), P)
    sinks.write_by_period(cells, root, "v1")
    redo = cells.where(F.floor(F.col("PERIODO") / 100) == 1998).withColumn("CANT_CLASES", F.col("CANT_CLASES") * 2)
    sinks.write_by_period(redo, root, "v1")
    back = spark.read.parquet(f"{root}/prog_acad/version=v1")
    return back.select("PERIODO", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL", "CANT_CLASES", "CANT_ALUMNOS")
