"""Apportionment (W1-W4) micro-cases and invariants."""

from cohortcast.operators import shares

FAC_SCHEMA = ("PERIODO_TARGET int, SEDE string, CURSO_ACTUAL string, HORARIO_ACTUAL string, IDX int, PE int, "
              "VAC_ACAD_ESTANDAR int, FAC_ALUMNOS_PREDICT double, CANT_ALUMNOS_ANTERIOR double, "
              "CANT_CLASES_ANTERIOR double")
CANT_SCHEMA = "PERIODO_TARGET int, SEDE string, CURSO_ACTUAL string, CANT_ALUMNOS_PREDICT double, PE int"


def _run(spark, total, fac, pe=1):
    f = spark.createDataFrame([(202501, "S", "C", f"h{i + 1}", 1, pe, 20, x, 0.0, 0.0) for i, x in enumerate(fac)],
                              FAC_SCHEMA)
    c = spark.createDataFrame([(202501, "S", "C", float(total), pe)], CANT_SCHEMA)
    return {r.HORARIO_ACTUAL: r.CANT_ALUMNOS_PREDICT for r in shares.apportion(f, c).collect()}


def test_largest_remainder(spark):
    assert _run(spark, 21, [0.5, 0.3, 0.2]) == {"h1": 11.0, "h2": 6.0, "h3": 4.0}


def test_tie_goes_to_later_slot(spark):
    df = spark.createDataFrame([(202501, "S", "C", h, 0.5, 1.0) for h in ("h1", "h2")],
                               "PERIODO_TARGET int, SEDE string, CURSO_ACTUAL string, HORARIO_ACTUAL string, "
                               "FAC_ALUMNOS_PREDICT double, CANT_ALUMNOS_PREDICT double")
    got = {r.HORARIO_ACTUAL: r.CANT_ALUMNOS for r in shares.apportion_basic(df).collect()}
    assert got == {"h1": 0.0, "h2": 1.0}
    # through the full apportioner the empty slot is then below the minimum and dropped
    assert _run(spark, 1, [0.5, 0.5]) == {"h2": 1.0}


def test_all_zero_shares_split_equally(spark):
    assert _run(spark, 4, [0.0, 0.0]) == {"h1": 2.0, "h2": 2.0}


def test_sub_minimum_reallocation(spark):
    assert _run(spark, 20, [0.6, 0.25, 0.15], pe=5) == {"h1": 14.0, "h2": 6.0}


def test_no_slot_reaches_minimum(spark):
    assert _run(spark, 10, [0.5, 0.5], pe=8) == {}


def test_single_slot_passes(spark):
    assert _run(spark, 9, [1.0], pe=8) == {"h1": 9.0}


def test_course_below_break_even_is_not_apportioned(spark):
    assert _run(spark, 3, [0.5, 0.5], pe=8) == {}


def test_totals_preserved_and_minimum_respected(spark):
    import random
    rnd = random.Random(3)
    rows_f, rows_c = [], []
    for g in range(40):
        n = rnd.randint(1, 6)
        total = rnd.randint(10, 200)
        for i in range(n):
            rows_f.append((202501, "S", f"C{g}", f"h{i}", 1, 6, 20, rnd.random(), 0.0, 0.0))
        rows_c.append((202501, "S", f"C{g}", float(total), 6))
    out = shares.apportion(spark.createDataFrame(rows_f, FAC_SCHEMA), spark.createDataFrame(rows_c, CANT_SCHEMA))
    got = {}
    for r in out.collect():
        got.setdefault(r.CURSO_ACTUAL, []).append(r.CANT_ALUMNOS_PREDICT)
    totals = {c: t for (_p, _s, c, t, _pe) in rows_c}
    for c, vals in got.items():
        assert sum(vals) == totals[c]
        if len(vals) > 1:
            assert min(vals) >= 6


def test_course_without_slots_stops_or_is_reported(spark):
    import pytest
    f = spark.createDataFrame([(202501, "S", "C", "h1", 1, 1, 20, 1.0, 0.0, 0.0)], FAC_SCHEMA)
    c = spark.createDataFrame([(202501, "S", "C", 8.0, 1), (202501, "S", "D", 9.0, 1)], CANT_SCHEMA)
    with pytest.raises(Exception, match="null slot share"):
        shares.apportion(f, c).collect()
    got = {(r.CURSO_ACTUAL, r.HORARIO_ACTUAL): r.CANT_ALUMNOS_PREDICT for r in shares.apportion(f, c, missing="report").collect()}
    assert got == {("C", "h1"): 8.0, ("D", None): 9.0}
