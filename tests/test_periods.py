"""Month algebra: the production unit tests as golden cases, plus column forms."""

from pyspark.sql import functions as F

from cohortcast.config import DEFAULT
from cohortcast.functions import periods as per


def test_shift_back_three():
    assert per.shift(202306, 3) == 202303


def test_last_three_includes_given_month():
    assert per.last_n(202306, 3) == [202306, 202305, 202304]


def test_all_periods_from_history_start():
    assert per.all_periods(202306, DEFAULT) == [202211, 202212, 202301, 202302, 202303, 202304, 202305, 202306]


def test_selector_both_ways():
    assert per.select_periods(3, 202306, False) == [202306, 202305, 202304]
    assert per.select_periods(None, 202306, True) == per.all_periods(202306)


def test_year_boundaries():
    assert per.shift(202501, 12) == 202401
    assert per.shift(202512, -1) == 202601
    assert per.ahead_n(202511, 3) == [202511, 202512, 202601]
    assert per.training_periods(202405)[:3] == [202403, 202404, 202405]


def test_column_forms_match_scalars(spark):
    months = [199501, 199512, 200001, 200112]
    df = spark.createDataFrame([(m,) for m in months], "P int")
    rows = df.select("P", per.shift_period("P", 1).alias("a"), per.shift_period("P", 12).alias("b"),
                     per.shift_period("P", -1).alias("c"), per.period_ord("P").alias("o")).collect()
    for r in rows:
        assert r.a == per.shift(r.P, 1) and r.b == per.shift(r.P, 12) and r.c == per.shift(r.P, -1)
        assert r.o == per.to_ord(r.P)


def test_period_frame(spark):
    got = [r.PERIODO for r in per.period_frame(spark, 199911, 200002).collect()]
    assert got == [199911, 199912, 200001, 200002]


def test_schedule_map():
    jan, feb, jun = per.schedule_for(202501), per.schedule_for(202502), per.schedule_for(202506)
    assert jan["inicial_estacional"] and not jan["continuidad_estacional"]
    assert feb["inicial_estacional"] and feb["continuidad_estacional"]
    assert not jun["inicial_estacional"] and all(jun[f] for f in per.REGULAR_FAMILIES)
    assert per.horizon(202506, 5) == [202506, 202507, 202508, 202509, 202510]
    assert per.horizon(202506, 5, 202508) == [202508]
