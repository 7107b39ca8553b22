"""Hand-made fixtures for behaviours the driver tables never reach (FIXTURES.md §D 3 and 13)."""

from pyspark.sql import functions as F

from cohortcast.config import DEFAULT
from cohortcast.operators import rollup
from cohortcast.plans import continuing, slot
from cohortcast.sources.dims import Dims
from cohortcast.sources.local import local_frame

M = 202406          # target month; A (monthly) feeds from 202405, B (bimonthly) from 202404
CELL = "PERIODO int, SEDE string, CURSO_ACTUAL string, HORARIO_ACTUAL string, CANT_CLASES long, CANT_ALUMNOS long"


def _dims(spark):
    courses = [("A", "Teens 2", "L1", "Diario", "R", "Mensual", "Adultos", "Ad", "C"),
               ("B", "Teens 3", "L1", "Diario", "R", "Bimensual", "Adultos", "Ad", "C"),
               ("C", "Teens 4", "L1", "Diario", "R", "Mensual", "Adultos", "Ad", "END")]
    months = [202403, 202404, 202405, 202406]
    t = {
        "courses": local_frame(spark, courses, "CURSO_ACTUAL string, CURSO_2 string, NIVEL string, FRECUENCIA string, "
                               "INTENSIDAD string, DURACION string, PROGRAMA string, LINEA_DE_NEGOCIO string, "
                               "`POSTERIOR_(+1)` string"),
        "course_map": local_frame(spark, [(c, c, 0) for c in "ABC"],
                                  "CURSO_ANTERIOR string, CURSO_ACTUAL string, FLAG_ESTACIONAL int"),
        "initial_courses": local_frame(spark, [("Teens 1",)], "CURSOS_INICIALES string"),
        "seasonal_course_map": local_frame(spark, [], "CURSO_ACTUAL string, `POSTERIOR_(+1)` string"),
        "seasonal_slot_map": local_frame(spark, [], "HORARIO string, `HORARIO_(+1)` string"),
        "slots": local_frame(spark, [("h1", "h1", 8.0, 9.0), ("h2", "h2", 9.0, 10.0)],
                             "HORARIO string, HORARIO_ACTUAL string, HORA_MIN double, HORA_MAX double"),
        "site_hours": local_frame(spark, [(p, "S", 7.0, 22.0) for p in months],
                                  "PERIODO int, SEDE string, HORA_MIN double, HORA_MAX double"),
        "seats": local_frame(spark, [(p, "L1", "Ad", 20) for p in months],
                             "PERIODO int, NIVEL string, LINEA_DE_NEGOCIO string, VAC_ACAD_ESTANDAR int"),
        # break-even changes between the two predecessor months
        "pe": local_frame(spark, [(p, "Adultos", 8 if p <= 202404 else 9) for p in months] +
                          [(p, "Niños", 5) for p in months], "PERIODO int, PROGRAMA string, PE int"),
    }
    return Dims(t)


def _full(spark):
    cells = [(202405, "S", "A", "h1", 1, 10), (202404, "S", "B", "h1", 1, 6), (202404, "S", "B", "h2", 1, 4)]
    facts = local_frame(spark, cells, CELL)
    return rollup.regular_facts(facts, None, _dims(spark), include_seasonal=True)


def test_two_predecessors_with_different_break_even(spark):
    dm, full = _dims(spark), _full(spark)
    cand = continuing.candidates(full, dm, (M, M), DEFAULT)
    got = sorted((r.CURSO_ANTERIOR, r.PERIODO, r.PE_ANTERIOR, r.PE) for r in cand.collect())
    assert got == [("A", 202405, 9, 9), ("B", 202404, 8, 9)]
    ant = continuing.anterior(cand, full)
    assert sorted((r.PE_ANTERIOR, r.CANT_ALUMNOS_ANTERIOR) for r in ant.collect()) == [(8, 10.0), (9, 10.0)]


def test_slot_shares_many_to_many_is_kept_or_summed(spark):
    dm, full = _dims(spark), _full(spark)
    cand = slot.candidates(full, dm, (M, M), DEFAULT)
    kept = slot.anterior_shares(cand, full)
    rows = sorted((r.HORARIO_ACTUAL, r.CANT_ALUMNOS_ANTERIOR, r.PE_ANTERIOR, r.FAC_ALUMNOS_ANTERIOR)
                  for r in kept.collect())
    # per slot: 2 totals (one per PE_ANTERIOR) x 2 shares (one per PE_ANTERIOR)
    assert rows == [("h1", 6.0, 8, 0.6), ("h1", 6.0, 9, 1.0), ("h1", 10.0, 8, 0.6), ("h1", 10.0, 9, 1.0),
                    ("h2", 0.0, 8, 0.4), ("h2", 0.0, 9, 0.0), ("h2", 4.0, 8, 0.4), ("h2", 4.0, 9, 0.0)]
    summed = slot.anterior_shares(cand, full, dedupe=True)
    assert sorted((r.HORARIO_ACTUAL, r.CANT_ALUMNOS_ANTERIOR, r.FAC_ALUMNOS_ANTERIOR) for r in summed.collect()) == \
        [("h1", 16.0, 0.8), ("h2", 4.0, 0.2)]


def test_null_keys_dropped_by_platinum_kept_by_union(spark):
    raw = local_frame(spark, [(202401, "S", "C", "h1", 5), (202401, None, "C", "h1", 7), (202401, None, "C", "h1", 1)],
                      "PERIODO int, SEDE string, CURSO_ACTUAL string, HORARIO_ACTUAL string, CANT_MATRICULADOS int")
    plat = rollup.platinum_rollup(raw)
    assert [tuple(r) for r in plat.collect()] == [(202401, "S", "C", "h1", 1, 5)]
    cells = local_frame(spark, [(202401, None, "C", "h1", 2, 8), (202401, "S", "C", "h1", 1, 5)], CELL)
    synth = local_frame(spark, [(202401, None, "C", "h1", 1, 3)], CELL)
    u = {r.SEDE: (r.CANT_CLASES, r.CANT_ALUMNOS) for r in rollup.union_rollup(cells, synth).collect()}
    assert u == {None: (3, 11), "S": (1, 5)}


def test_missing_successor_flags_fail_the_run(spark):
    import pytest
    dm, full = _dims(spark), _full(spark)
    broken = Dims(dict(dm.tables, course_map=local_frame(spark, [("A", "A", 0), ("B", "B", 0)],
                                                          "CURSO_ANTERIOR string, CURSO_ACTUAL string, "
                                                          "FLAG_ESTACIONAL int")))
    with pytest.raises(Exception, match="course flags for _SUCC=C"):
        continuing.candidates(full, broken, (M, M), DEFAULT).collect()
