"""Scalar rules (X1, X3, X7, X9, X10) and filters (F1-F4, F7, F8) on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from cohortcast.config import DEFAULT
from cohortcast.functions import scalars as S
from cohortcast.operators import clean


def test_prediction_cleanup(spark):
    df = spark.createDataFrame([(-3.2,), (7.39,), (7.41,), (7.0,)], "p double")
    assert [r[0] for r in df.select(S.clean_prediction("p")).collect()] == [0.0, 7.0, 8.0, 7.0]


def test_students_to_classes(spark):
    df = spark.createDataFrame([(0.0, 18, 11), (29.0, 18, 11), (28.0, 18, 11), (5.0, 18, 11)], "s double, v int, pe int")
    assert [r[0] for r in df.select(S.students_to_classes("s", "v", "pe")).collect()] == [0.0, 2.0, 1.0, 0.0]


def test_slot_hours_and_bad_format(spark):
    df = spark.createDataFrame([("07:15 - 08:45",)], "f string")
    r = df.select(S.slot_start_hours("f"), S.slot_end_hours("f")).first()
    assert (r[0], r[1]) == (7.25, 8.75)
    bad = spark.createDataFrame([("7-8",)], "f string")
    with pytest.raises(Exception):
        bad.select(S.slot_start_hours("f")).collect()


def test_level_split(spark):
    df = spark.createDataFrame([("Basic Kids 01",), ("Summer",)], "c string")
    rows = df.select(S.level_of("c"), S.course_index_of("c")).collect()
    assert tuple(rows[0]) == ("L_Basic Kids", "IC_01") and tuple(rows[1]) == ("L_Summer", "IC_Summer")


def test_growth_zero_base(spark):
    df = spark.createDataFrame([(6.0, 4.0), (3.0, 0.0), (0.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(S.growth("a", "b")).collect()] == [0.5, None, None]
    inf = DEFAULT.with_(zero_base="inf")
    assert [r[0] for r in df.select(S.growth("a", "b", inf)).collect()] == [0.5, float("inf"), None]


def test_regular_sale_filter(spark):
    rows = [(202408, "B01P", "x", "A", "Regular"), (202409, "B01P", "x", "A", "Regular"),
            (202408, "B01PV", "x", "A", "Regular"), (202409, "B01PV", "x", "A", "Regular"),
            (202408, "P", "x", "A", "Regular"), (202409, "B01HD", "x", "A", "Regular"),
            (202409, "B01", "x", DEFAULT.cancelled_state, "Regular"), (202409, "B01", "VECOR", "A", "Regular"),
            (202409, "B01", "x", "A", "Corporate"), (202409, None, "x", "A", "Regular")]
    df = spark.createDataFrame(rows, "PERIODO int, CODIGO_DE_CURSO string, SEDE string, ESTADO string, NIVEL string")
    kept = {(r.PERIODO, r.CODIGO_DE_CURSO) for r in clean.regular_sale(df).collect()}
    assert kept == {(202409, "B01P"), (202408, "P")}


def test_satellites_keep_null_site_and_canonical_site(spark):
    df = spark.createDataFrame([("San Juan de Miraflores Satélite",), (None,), ("Provincias - Ica",),
                                ("Lima Norte",), ("Lima Norte Satélite 2",)], "SEDE string")
    out = clean.canonicalise_sites(clean.drop_satellites(df))
    assert sorted([r.SEDE for r in out.collect()], key=str) == sorted(
        [None, "Ica", "Lima Norte Satélite", "Lima Norte Satélite"], key=str)


def test_available_keeps_null_flag(spark):
    df = spark.createDataFrame([(0,), (None,), (1,)], "FLAG_DISPONIBLE int")
    assert clean.available(df).count() == 2


def test_terminal_and_march_predicates(spark):
    df = spark.createDataFrame([("END",), (None,), ("B02",)], "`POSTERIOR_(+1)` string")
    assert [r[0] for r in df.where(clean.not_terminal()).collect()] == ["B02"]
    m = spark.createDataFrame([("ST1", "Interdiario", "07:00 - 08:30"), ("ST1", "Diario", "07:00 - 08:30"),
                               (None, "Interdiario", "07:00 - 08:30")], "NIVEL string, FRECUENCIA string, H string")
    assert [r[0] for r in m.select(clean.march_excluded("NIVEL", "FRECUENCIA", "H")).collect()] == [True, False, False]


def test_seasonal_regime(spark):
    df = spark.createDataFrame([(p,) for p in (202401, 202402, 202403, 202404, 202501)], "PERIODO_TARGET int")
    assert [r[0] for r in clean.seasonal_regime(df, 202501).collect()] == [202401, 202501]
    assert [r[0] for r in clean.seasonal_regime(df, 202506).collect()] == [202404]
