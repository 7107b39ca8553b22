"""Family plans on the driver tables (sf0.001): a month computed alone equals its slice of the
all-months plan (target months 1, 2, 3 and 6 take different code paths), plus March behaviour."""

import pytest
from pyspark.sql import functions as F

from cohortcast.plans import continuing, first_level, slot
from cohortcast.sources import driver as drv

SF = "/root/testdata/sf0.001"
P = drv.PARAMS
MONTHS = [199801, 199802, 199803, 199806, 200003]


@pytest.fixture(scope="module")
def base(spark):
    dm = drv.dims(spark)
    drv.reset_base()
    return dm, drv.regular(spark, SF, dm, include_seasonal=True)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("month", MONTHS)
def test_first_level_month_alone_equals_slice(base, month):
    dm, full = base
    reg = full.where(F.col("FLAG_ESTACIONAL") == 0)
    sliced = first_level.features(reg, dm, drv.TARGET_RANGE, P).where(F.col("PERIODO_TARGET") == month)
    alone = first_level.features(reg, dm, (month, month), P)
    assert _rows(sliced) == _rows(alone)


@pytest.mark.parametrize("month", MONTHS)
def test_continuing_month_alone_equals_slice(base, month):
    dm, full = base
    sliced = continuing.features(full, dm, drv.TARGET_RANGE, P).where(F.col("PERIODO_TARGET") == month)
    alone = continuing.features(full, dm, (month, month), P)
    assert _rows(sliced) == _rows(alone)


@pytest.mark.parametrize("month", MONTHS)
def test_slot_month_alone_equals_slice(base, month):
    dm, full = base
    sliced = slot.features(full, dm, drv.TARGET_RANGE, P).where(F.col("PERIODO_TARGET") == month)
    alone = slot.features(full, dm, (month, month), P)
    assert _rows(sliced) == _rows(alone)


def test_seasonal_courses_hand_over_only_in_march(base):
    dm, full = base
    c = continuing.candidates(full, dm, drv.TARGET_RANGE, P)
    seasonal = c.where(F.col("CURSO_ANTERIOR").isin(list(drv.SEASONAL_COURSES))).select(
        (F.col("PERIODO_TARGET") % 100).alias("m"), "CURSO_ACTUAL").distinct().collect()
    assert seasonal and all(r.m == P.substitution_month for r in seasonal)
    assert {r.CURSO_ACTUAL for r in seasonal} == {s for (_c, s) in drv.SEASONAL_COURSE_MAP}


def test_terminal_courses_have_no_successor_rows(base):
    dm, full = base
    c = continuing.candidates(full, dm, drv.TARGET_RANGE, P)
    terminal = [name for (name, *_r, succ) in drv.COURSES if succ in (None, P.terminal_course)
                and name not in drv.SEASONAL_COURSES]
    assert c.where(F.col("CURSO_ANTERIOR").isin(terminal)).count() == 0


def test_first_level_only_initial_courses(base):
    dm, full = base
    reg = full.where(F.col("FLAG_ESTACIONAL") == 0)
    courses = {r[0] for r in first_level.candidates(reg, dm, drv.TARGET_RANGE, P).select("CURSO_ACTUAL")
               .distinct().collect()}
    initial = {name for (name, c2, *_r) in drv.COURSES if c2 in drv.INITIAL_COURSES}
    assert courses and courses <= initial


def test_opening_hours_limits(base):
    dm, full = base
    c = slot.candidates(full, dm, drv.TARGET_RANGE, P)
    me = {r[0] for r in c.where(F.col("SEDE") == "MIDDLE EAST").select("HORARIO_ACTUAL").distinct().collect()}
    # opens 8:45 (exactly the start of 2-HIGH), closes 20:30 (exactly the end of 4-NOT SPECIFIED)
    assert "1-URGENT" not in me and "5-LOW" not in me
    assert me <= {"2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"}
