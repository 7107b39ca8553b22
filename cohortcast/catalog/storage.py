"""Queries over files that are written and read back: fact sheets, snapshots, layers, published outputs, verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.periods import from_ord, to_ord
from ..operators import clean
from ..plans import evaluate, first_level, platinum
from ..sources import driver as drv
from ..sources import ingest, sinks
from .etl import _platinum_sql, _scratch
from .families import first_level_features_sql
from .forecasting import (EVAL_COLUMNS, LO, SCORE_SQL, SK, classes_sql, clean_sql, first_level_forecast,
                          first_level_targets_in_range, first_level_targets_sql, join_target_sql)
from .registry import query

P = drv.PARAMS


# ---- raw fact sheets (S2, S3, S4) ---------------------------------------------------------------------

#: The 20 columns of a fact sheet, as expressions over the joined driver tables (Spark and DuckDB alike).
SHEET = {
    "PERIODO": "CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER)", "SEDE": "r_name",
    "MODALIDAD": "CASE WHEN l_linestatus = 'O' THEN 'Presencial' ELSE 'Virtual, en vivo' END", "FASE": "l_linestatus",
    "NIVEL": "CASE WHEN p_size >= 49 THEN 'Corporate' ELSE 'Regular' END", "CODIGO_DE_CURSO": "p_type",
    "DESCRIPCION": "p_name", "FRECUENCIA": "CASE WHEN l_linenumber % 2 = 0 THEN 'Diario' ELSE 'Interdiario' END",
    "INTENSIDAD": "CASE WHEN l_linenumber > 4 THEN 'Intensivo' END", "HORARIO": "concat(o_orderpriority, '/', o_orderstatus)",
    "AULA": "concat('A-', CAST(l_linenumber AS VARCHAR(9)))", "COD_DOCENTE": "CAST(s_suppkey AS VARCHAR(20))",
    "PROFESOR": "concat('Prof. \"', s_name, '\"')", "CANT_MATRICULADOS": "CAST(l_quantity AS INTEGER)",
    "VACANTES_USADAS": "CAST(l_quantity AS INTEGER)", "VACANTES_DISP": "CAST(50 - l_quantity AS INTEGER)",
    "VAC_HABILITADAS": "CAST(50 AS INTEGER)", "AFORO": "CAST(p_size AS DOUBLE) / 4", "ESTADO": "l_returnflag",
    "FECHA_CREACION": "CAST(CAST(l_shipdate AS DATE) AS VARCHAR(10))"}
SHEET_HEADER = {"PERIODO": "Periodo", "CODIGO_DE_CURSO": "Código de curso ", "DESCRIPCION": "Descripción",
                "COD_DOCENTE": "Cod. Docente", "CANT_MATRICULADOS": "Cant. Matriculados", "FECHA_CREACION": "Fecha creación"}


def _sheet_rows(spark, sf_dir):
    t = {n: drv.read(spark, sf_dir, n) for n in ("lineitem", "orders", "part", "supplier", "nation", "region")}
    j = (t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
         .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
         .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
         .join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
         .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")))
    return j.select(*[F.expr(e).alias(c) for c, e in SHEET.items()])


def write_sheets(rows, path: str) -> None:
    """CSV files as the source system leaves them, one a year and site (gzip): a title line, the header row, the rows."""
    names = ",".join(SHEET_HEADER.get(c, c.replace("_", " ").capitalize()) for c in SHEET)
    key = [F.floor(F.col("PERIODO") / 100).alias("anio"), F.regexp_replace("SEDE", " ", "-").alias("archivo")]
    body = rows.select(*key, F.lit(2).alias("place"), F.to_csv(F.struct(*SHEET)).alias("value"))
    top = body.select("anio", "archivo").distinct().select("anio", "archivo", F.explode(F.array(
        F.struct(F.lit(0).alias("place"), F.lit("Programación académica, exportada").alias("value")),
        F.struct(F.lit(1).alias("place"), F.lit(names).alias("value")))).alias("x")).select("anio", "archivo", "x.*")
    (body.unionByName(top).repartition("anio", "archivo").sortWithinPartitions("anio", "archivo", "place")
         .drop("place").write.partitionBy("anio", "archivo").text(path, compression="gzip"))


def _sheet_sql() -> str:
    cols = ", ".join(f"{e.replace('VARCHAR(9)', 'VARCHAR').replace('VARCHAR(20)', 'VARCHAR')} AS {c}" for c, e in SHEET.items())
    return f"""
SELECT {cols}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


@query("fact_sheet_scan", _sheet_sql)
def fact_sheet_scan(spark, sf_dir):
    """S1 + S2 + S3: fact sheets of all years and sites (title line, messy header row, 20 columns) in one scan, all cast."""
    path = f"{_scratch(spark)}/prog-acad"
    write_sheets(_sheet_rows(spark, sf_dir), path)
    return ingest.read_classes(spark, f"{path}/*/*", fmt="csv", skip_banner=True)


@query("dim_sheet_scan", lambda: f"""
SELECT CAST(HORARIO AS VARCHAR) AS HORARIO, CAST(HORARIO_ACTUAL AS VARCHAR) AS HORARIO_ACTUAL, COUNT(*) AS N_CLASES
  FROM (SELECT o_orderpriority || '/' || o_orderstatus AS HORARIO, o_orderpriority AS HORARIO_ACTUAL
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey) x
 GROUP BY HORARIO, HORARIO_ACTUAL""")
def dim_sheet_scan(spark, sf_dir):
    """S4 + J2: a slot sheet with a title line, read with its header normalised, and the classes of each of its slots."""
    path = f"{_scratch(spark)}/tabla_horario"
    rows = [("Tabla de horarios",), ("Horario , horario actual",)] + [
        (f"{h},{a}",) for h, a, *_ in drv.raw_slot_rows()]                       # the sheet itself: one small file
    spark.createDataFrame(rows, "value string").coalesce(1).write.text(path)
    sheet = ingest.read_sheet(spark, path, skip_banner=True)
    classes = drv.read(spark, sf_dir, "lineitem").join(drv.read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col(
        "o_orderkey")).groupBy(F.concat("o_orderpriority", F.lit("/"), "o_orderstatus").alias("HORARIO")).agg(
            F.count("*").alias("N_CLASES"))
    return classes.join(sheet, "HORARIO").select("HORARIO", "HORARIO_ACTUAL", "N_CLASES")


#: Files of CSV: gzip can't be split, so each holds a bounded number of rows (some 150 MB of text).
CSV_FILES = {"compression": "gzip", "maxRecordsPerFile": 1_000_000}


@query("csv_passthrough", lambda: _sheet_sql().replace("SELECT ", "SELECT COUNT(*) OVER () AS N_OBSERVED, ", 1))
def csv_passthrough(spark, sf_dir):
    """CSV files copied, their rows counted by an observation of that write; the copy with the count beside each row."""
    root = _scratch(spark)
    rows = _sheet_rows(spark, sf_dir)
    rows.write.options(**CSV_FILES).option("header", "true").csv(f"{root}/in")
    n = ingest.csv_passthrough(spark, f"{root}/in", f"{root}/out", **CSV_FILES)
    back = spark.read.schema(rows.schema).option("header", "true").csv(f"{root}/out")
    return back.withColumn("N_OBSERVED", F.lit(n).cast("long"))


# ---- snapshot (S6, S7, C1, S8, S9) --------------------------------------------------------------------

GAP = 199703                  # a month that the query takes out of the layer, so that one is missing


def _snapshot_sql() -> str:
    lo, hi = P.history_start_period, 200112
    months = ", ".join(f"({from_ord(o)})" for o in range(to_ord(lo), to_ord(hi) + 1))
    return f"""
WITH cells AS ({_platinum_sql()})
SELECT PERIODO, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, CANT_CLASES, CANT_ALUMNOS, FALSE AS FALTA FROM cells
 WHERE PERIODO BETWEEN {lo} AND {hi} AND PERIODO <> {GAP}
UNION ALL
SELECT m.PERIODO, NULL, NULL, NULL, NULL, NULL, TRUE FROM (VALUES {months}) m(PERIODO)
 WHERE m.PERIODO = {GAP} OR m.PERIODO NOT IN (SELECT PERIODO FROM cells)"""


@query("snapshot_load", _snapshot_sql)
def snapshot_load(spark, sf_dir):
    """S6 + S7: platinum written under two versions (C1 + S8 + S9), the last one pinned and loaded from the history start; months
    without facts are rows of their own (FALTA)."""
    root = _scratch(spark)
    dm = drv.dims(spark)
    raw, synth = drv.raw_class_rows(spark, sf_dir), drv.raw_synthetic(spark, sf_dir)
    platinum.build_and_write(raw.where(F.col("PERIODO") < 199601), synth, dm, root, "v1", P)
    platinum.build_and_write(raw.where(F.col("PERIODO") != GAP), synth, dm, root, "v2", P)
    s = ingest.load_versioned(spark, root, None, 200112, P)
    cols = ["PERIODO", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL", "CANT_CLASES", "CANT_ALUMNOS"]
    return s.facts.select(*cols, F.lit(False).alias("FALTA")).unionByName(
        s.missing.withColumn("FALTA", F.lit(True)), allowMissingColumns=True)


# ---- layers, published outputs, verdicts (S10-S13) ----------------------------------------------------

SPLIT = 200101


@query("layer_sinks", lambda: f"""
SELECT PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, CANT_ALUMNOS, CANT_ALUMNOS_LAG_12,
       CASE WHEN PERIODO_TARGET < {SPLIT} THEN 'train' ELSE 'test' END AS split
  FROM ({first_level_features_sql()}) q WHERE PERIODO_TARGET <= {SPLIT}""")
def layer_sinks(spark, sf_dir):
    """S10 + F12: train and test features written per (tipo, version, split, month), rewritten once, all read back."""
    root = f"{_scratch(spark)}/features"
    f = first_level.features(drv.regular(spark, sf_dir, drv.dims(spark)), drv.dims(spark), drv.TARGET_RANGE, P)
    train, test = clean.time_split(f, SPLIT)
    for _ in range(2):                                       # a rerun replaces its months, nothing doubles
        sinks.write_layer(train, root, first_level.FAMILY, "v1", "train")
        sinks.write_layer(test, root, first_level.FAMILY, "v1", "test")
    back = spark.read.parquet(f"{root}/tipo={first_level.FAMILY}/version=v1")
    return back.select("PERIODO_TARGET", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL", "CANT_ALUMNOS", "CANT_ALUMNOS_LAG_12", "split")


MODEL, REDONE = 200001, 200007


def _alias_sql() -> str:
    base = f"SELECT PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, CAST(CANT_ALUMNOS AS DOUBLE) AS V FROM ({first_level_features_sql()}) q"
    return f"""
WITH f AS ({base}), n AS (SELECT * FROM (VALUES ('v1'), ('v2'), ('dev')) x(NAME))
SELECT n.NAME, {MODEL} AS MODEL_PERIODO, f.PERIODO_TARGET, f.SEDE, f.CURSO_ACTUAL, f.HORARIO_ACTUAL,
       CASE WHEN n.NAME = 'v2' OR (n.NAME = 'dev' AND f.PERIODO_TARGET >= {REDONE}) THEN V + 0.5 ELSE V END AS CANT_ALUMNOS_PREDICT
  FROM f CROSS JOIN n WHERE f.PERIODO_TARGET >= {MODEL} AND (n.NAME <> 'v2' OR f.PERIODO_TARGET >= {REDONE})"""


@query("publish_alias", _alias_sql)
def publish_alias(spark, sf_dir):
    """A first version published with the dev alias, then a second one for later months; versions and alias read back."""
    root = f"{_scratch(spark)}/predict"
    dm = drv.dims(spark)
    f = first_level.features(drv.regular(spark, sf_dir, dm), dm, drv.TARGET_RANGE, P)
    out = f.where(F.col("PERIODO_TARGET") >= MODEL).select(*SK, F.col("CANT_ALUMNOS").cast("double").alias("CANT_ALUMNOS_PREDICT"))
    sinks.write_with_alias(out, root, first_level.FAMILY, "v1", MODEL, "dev")
    later = out.where(F.col("PERIODO_TARGET") >= REDONE).withColumn("CANT_ALUMNOS_PREDICT", F.col("CANT_ALUMNOS_PREDICT") + 0.5)
    sinks.write_with_alias(later, root, first_level.FAMILY, "v2", MODEL, "dev")
    back = None
    for name in ("v1", "v2", "dev"):
        x = sinks.read_published(spark, root, first_level.FAMILY, name).select(
            F.lit(name).alias("NAME"), "MODEL_PERIODO", *SK, "CANT_ALUMNOS_PREDICT")
        back = x if back is None else back.unionByName(x)
    return back


def _evaluation_sql() -> str:
    threshold = dict(P.thresholds)[first_level.FAMILY]
    return f"""
WITH b AS (SELECT * FROM ({first_level_features_sql()}) q), tgt AS {first_level_targets_sql()},
fc AS (SELECT PERIODO_TARGET, SEDE, CURSO_ACTUAL, HORARIO_ACTUAL, IDX, PE, VAC_ACAD_ESTANDAR,
              {clean_sql('CANT_ALUMNOS_LAG_01')} AS CANT_ALUMNOS_PREDICT FROM b),
c AS (SELECT *, {classes_sql('CANT_ALUMNOS_PREDICT', 'VAC_ACAD_ESTANDAR', 'PE')} AS CANT_CLASES_PREDICT FROM fc),
ev AS ({join_target_sql('c', 'tgt')}),
s AS (SELECT AVG(score) AS score FROM ({SCORE_SQL.format(ev='ev')}) m)
SELECT '{first_level.FAMILY}' AS TIPO, round(score, 6) AS score, CAST({threshold} AS DOUBLE) AS threshold,
       CASE WHEN score >= {threshold} THEN 'approved' ELSE 'rejected' END AS verdict,
       (SELECT COUNT(*) FROM ev) AS N_ROWS FROM s"""


@query("publish_evaluation", _evaluation_sql)
def publish_evaluation(spark, sf_dir):
    """S12 + S13 + C10: evaluation rows published with the prod alias, scored from what the alias holds, verdict written and
    read back."""
    root = _scratch(spark)
    ev = evaluate.join_target(first_level_forecast(spark, sf_dir), first_level_targets_in_range(spark, sf_dir), SK)
    sinks.write_with_alias(ev.select(*EVAL_COLUMNS), f"{root}/evaluation", first_level.FAMILY, "v1", LO, "prod")
    back = sinks.read_published(spark, f"{root}/evaluation", first_level.FAMILY, "prod")
    mean = evaluate.mean_score(evaluate.monthly_scores(back)).withColumn("TIPO", F.lit(first_level.FAMILY))
    sinks.write_verdict(evaluate.verdict(mean, P).select("TIPO", "score", "threshold", "verdict"), root)
    rows = back.groupBy(F.lit(first_level.FAMILY).alias("TIPO")).agg(F.count("*").alias("N_ROWS"))
    return sinks.read_verdict(spark, root).join(rows, "TIPO").withColumn("score", F.round("score", 6))
