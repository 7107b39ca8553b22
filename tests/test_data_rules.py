"""Rules that once lost or overfilled data: overflow, horizon, categories, sheet banners, course codes."""

import tempfile

import pytest
from pyspark.sql import functions as F

from cohortcast.operators import clean, shares
from cohortcast.plans import evaluate, model
from cohortcast.sources import ingest


def _seats(spark, rows):
    return spark.createDataFrame(
        [(200001, "A", c, float(k), v, s, 1.0, s, 1, 1, 1) for c, k, v, s in rows],
        "PERIODO_TARGET int, SEDE string, CURSO_ACTUAL string, CANT_CLASES_PREDICT double, VAC_ACAD_ESTANDAR int, "
        "CANT_ALUMNOS_PREDICT double, FAC_ALUMNOS_PREDICT double, CANT_ALUMNOS_ANTERIOR double, "
        "CANT_CLASES_ANTERIOR int, PE int, IDX int")


def test_overflow_without_seats_raises_or_is_reported(spark):
    df = _seats(spark, [("x", 1, 10, 25.0), ("y", 2, 10, 16.0)])
    with pytest.raises(Exception, match="free seats"):
        shares.overflow_reallocation(df).collect()
    got = {r.CURSO_ACTUAL: r for r in shares.overflow_reallocation(df, short="report").collect()}
    assert (got["x"].CANT_ALUMNOS_PREDICT, got["y"].CANT_ALUMNOS_PREDICT) == (10.0, 20.0)
    assert got["x"].CANT_ALUMNOS_SIN_CUPO == got["y"].CANT_ALUMNOS_SIN_CUPO == 11.0
    enough = shares.overflow_reallocation(_seats(spark, [("x", 1, 10, 12.0), ("y", 2, 10, 16.0)])).collect()
    assert sorted(r.CANT_ALUMNOS_PREDICT for r in enough) == [10.0, 18.0]


def test_missing_horizon_month_has_no_mean(spark):
    scores = spark.createDataFrame([(200001, 0.5), (200002, 0.7)], "PERIODO_TARGET int, score double")
    assert abs(evaluate.mean_score(scores, (), [200001, 200002]).first()[0] - 0.6) < 1e-9
    with pytest.raises(Exception, match="horizon"):
        evaluate.mean_score(scores, (), [200001, 200002, 200003]).collect()


def test_two_hundred_categories_fit(spark):
    df = spark.range(800).select(F.concat(F.lit("c"), F.col("id") % 200).alias("k"), (F.col("id") % 7).cast("double").alias("x"),
                                 (F.col("id") % 5).cast("double").alias("y"))
    spec = model.Spec(("x",), ("k",), "y")
    fitted = model.fit(df, spec, max_iter=1)
    assert model.score(fitted, df, spec).count() == 800


def test_every_sheet_loses_its_own_banner(spark):
    base = tempfile.mkdtemp(prefix="cohortcast-sheets-")
    for name, rows in (("a", "1,x\n2,y\n"), ("b", "3,\"p, q\"\n")):
        with open(f"{base}/{name}.csv", "w") as f:
            f.write("Title of the sheet\nCod A,Cod B\n" + rows)
    got = ingest.read_sheet(spark, base, "csv", skip_banner=True)
    assert sorted(tuple(r) for r in got.collect()) == [("1", "x"), ("2", "y"), ("3", "p, q")]


def test_regular_sale_endings(spark):
    p = clean.DEFAULT
    codes = ["A1", "A1HD", "a1pv", "A1P", "P", "PV", "HD", None]
    rows = [(c, "OK", "S", "L", m) for c in codes for m in (p.suffix_cutover_period - 1, p.suffix_cutover_period)]
    df = spark.createDataFrame(rows + [("A1", None, "S", "L", 202001), ("A1", p.cancelled_state, "S", "L", 202001)],
                               "CODIGO_DE_CURSO string, ESTADO string, SEDE string, NIVEL string, PERIODO int")
    got = sorted((r.CODIGO_DE_CURSO, r.PERIODO >= p.suffix_cutover_period) for r in clean.regular_sale(df).collect())
    assert got == sorted([("A1", False), ("A1", True), ("A1P", True), ("P", False), ("P", True), ("PV", False), ("PV", True), ("HD", False),
                          ("HD", True)])
