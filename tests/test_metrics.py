"""Evaluation metrics (A9), scores (A10, A11), verdicts."""

from pyspark.sql import functions as F

from cohortcast.plans import evaluate

SCHEMA = "PERIODO_TARGET int, SEDE string, CURSO_ACTUAL string, HORARIO_ACTUAL string, IDX int, " \
         "CANT_CLASES int, CANT_ALUMNOS int, CANT_CLASES_PREDICT double, CANT_ALUMNOS_PREDICT double"


def test_metrics_micro_case(spark):
    rows = [(1, "S", "C", "h1", 1, 2, 30, 1.0, 20.0), (1, "S", "C", "h2", 1, 0, 0, 1.0, 15.0),
            (1, "S", "C", "h3", 1, 1, 12, 1.0, 12.0), (1, "S", "C", "h4", 0, 0, 0, 0.0, 0.0)]
    m = evaluate.metrics(spark.createDataFrame(rows, SCHEMA)).first()
    assert (m.faltante, m.sobrante) == (1.0, 1.0)
    assert abs(m.precision - 1 / 3) < 1e-12
    assert m.total_clases == 3 and m.total_alumnos == 42 and m.total_alumnos_predict == 47.0
    assert m.pct_comb == 1.0 and m.total_comb == 2


def test_join_target_fills_both_sides(spark):
    fc = spark.createDataFrame([(1, "S", "C", "h1", 1, 2.0, 30.0)],
                               "PERIODO_TARGET int, SEDE string, CURSO_ACTUAL string, HORARIO_ACTUAL string, IDX int, "
                               "CANT_CLASES_PREDICT double, CANT_ALUMNOS_PREDICT double")
    tg = spark.createDataFrame([(1, "S", "C", "h2", 1, 10)],
                               "PERIODO_TARGET int, SEDE string, CURSO_ACTUAL string, HORARIO_ACTUAL string, "
                               "CANT_CLASES int, CANT_ALUMNOS int")
    j = evaluate.join_target(fc, tg, evaluate.EVAL_KEYS)
    got = sorted((r.HORARIO_ACTUAL, r.IDX, r.CANT_CLASES, r.CANT_CLASES_PREDICT) for r in j.collect())
    assert got == [("h1", 1, 0, 2.0), ("h2", 0, 1, 0.0)]


def test_verdict_and_compare(spark):
    means = spark.createDataFrame([("inicial_regular", "v1", 0.31), ("inicial_regular", "v2", 0.40),
                                   ("continuidad_regular_horario", "v1", 0.6),
                                   ("continuidad_regular_horario", "v2", 0.6)], "TIPO string, VERSION string, score double")
    v = {r.TIPO: r.verdict for r in evaluate.verdict(means.where("VERSION = 'v1'").drop("VERSION")).collect()}
    assert v == {"inicial_regular": "approved", "continuidad_regular_horario": "approved"}
    c = evaluate.compare(means, "v1", "v2").collect()
    assert {r.verdict for r in c} == {"rejected"}       # not strictly better in the slot family
    c2 = evaluate.compare(means.where("TIPO = 'inicial_regular'"), "v1", "v2", ("inicial_regular",)).collect()
    assert [r.verdict for r in c2] == ["approved"]
    empty = evaluate.compare(means.where("false"), "v1", "v2").collect()
    assert all(r.champion_score == 0.0 and r.verdict == "rejected" for r in empty)
