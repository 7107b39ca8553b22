"""Ingest (S1-S7, S14-S16), sinks (S8-S13) and the model plan (M1-M4) on small data."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cohortcast.config import DEFAULT
from cohortcast.plans import first_level, model, platinum
from cohortcast.sources import driver as drv
from cohortcast.sources import ingest, sinks

SF = "/root/testdata/sf0.001"


def _tmp():
    return tempfile.mkdtemp(prefix="cohortcast-test-")


def test_header_normalisation_and_duplicates(spark):
    assert ingest.normalise_name(" Cant. Matrículados ") == "CANT_MATRICULADOS"
    assert ingest.normalise_name("posterior (+1)") == "POSTERIOR_(+1)"
    df = spark.createDataFrame([(1, 2)], "`a b` int, `A.B` int")
    with pytest.raises(ValueError):
        ingest.normalise_headers(df.toDF("a b", "a_b"))


def test_csv_sheet_with_banner_and_schema_cast(spark):
    d = _tmp()
    with open(os.path.join(d, "sheet.csv"), "w", encoding="utf-8") as f:
        f.write("Programación académica\n")
        f.write("Periodo,Sede,Cant. Matriculados,Aforo\n202501,Ica,12,1.5\n202502,Lima,7,\n")
    df = ingest.read_sheet(spark, os.path.join(d, "sheet.csv"), "csv", skip_banner=True)
    assert df.columns == ["PERIODO", "SEDE", "CANT_MATRICULADOS", "AFORO"]
    from pyspark.sql import types as T
    schema = T.StructType([f for f in ingest.RAW_CLASS_SCHEMA.fields if f.name in df.columns])
    typed = ingest.cast_to_schema(df, schema)
    assert [tuple(r) for r in typed.orderBy("PERIODO").collect()] == [(202501, "Ica", 12, 1.5), (202502, "Lima", 7, None)]
    bad = spark.createDataFrame([("x",)], "PERIODO string")
    with pytest.raises(Exception):
        ingest.cast_to_schema(bad, T.StructType([T.StructField("PERIODO", T.IntegerType())])).collect()


def test_missing_periods_and_calendar(spark):
    facts = spark.createDataFrame([(202501,), (202503,)], "PERIODO int")
    assert [r[0] for r in ingest.missing_periods(spark, facts, [202501, 202502, 202503]).collect()] == [202502]
    cal = spark.createDataFrame([(202507, "2025-06-05"), (202512, "2026-02-06"), (202512, "2026-02-07")],
                                "periodo int, fecha string")
    assert tuple(ingest.calendar_gate(cal, "2026-02-07").first()) == (True, 202512)
    assert tuple(ingest.calendar_gate(cal, "2026-03-01").first()) == (False, -1)


def test_platinum_write_and_snapshot_roundtrip(spark):
    root = _tmp()
    dm = drv.dims(spark)
    raw = drv.raw_class_rows(spark, SF)
    out = platinum.build_and_write(raw, drv.raw_synthetic(spark, SF), dm, root, "v1", drv.PARAMS)
    assert set(out) >= {"prog_acad", "synthetic", "courses", "pe"}
    facts, synth, dims2 = ingest.load_snapshot(spark, root, "v1", 199912, drv.PARAMS)
    assert facts.agg(F.max("PERIODO")).first()[0] <= 199912
    want = platinum.facts_rollup(raw, dm, drv.PARAMS).where(F.col("PERIODO") <= 199912)
    assert facts.count() == want.count()
    assert dims2["initial_courses"].count() == len(drv.INITIAL_COURSES)


def test_dynamic_overwrite_replaces_only_batch_months(spark):
    root = _tmp()
    cells = spark.createDataFrame([(202501, "S", "C", "H", 1, 10), (202502, "S", "C", "H", 2, 20)], ingest.CELL_SCHEMA)
    sinks.write_by_period(cells, root, "v1")
    sinks.write_by_period(cells.where("PERIODO = 202502").withColumn("CANT_CLASES", F.lit(9).cast("long")), root, "v1")
    back = {r.PERIODO: r.CANT_CLASES for r in spark.read.parquet(f"{root}/prog_acad/version=v1").collect()}
    assert back == {202501: 1, 202502: 9}


def test_alias_sink_requires_known_mode(spark):
    df = spark.createDataFrame([(202501, 1)], "PERIODO_TARGET int, X int")
    with pytest.raises(ValueError):
        sinks.write_with_alias(df, _tmp(), "t", "v1", 202501, "staging")


def test_alias_and_version_change_together(spark):
    root = _tmp()
    first = spark.createDataFrame([(202501, 1), (202502, 2), (202502, 3)], "PERIODO_TARGET int, X int")
    sinks.write_with_alias(first, root, "t", "v1", 202501, "prod")
    sinks.write_with_alias(first.where("PERIODO_TARGET = 202502").withColumn("X", F.lit(9)), root, "t", "v2", 202501, "prod")
    rows = lambda name: sorted((r.PERIODO_TARGET, r.X) for r in sinks.read_published(spark, root, "t", name).collect())
    assert rows("v1") == [(202501, 1), (202502, 2), (202502, 3)]
    assert rows("v2") == [(202502, 9), (202502, 9)]
    assert rows("prod") == [(202501, 1), (202502, 9), (202502, 9)]
    before = sinks.published(spark, root, "t")
    with pytest.raises(Exception):                            # a failed write leaves what is published as it was
        sinks.write_with_alias(first.withColumn("X", F.raise_error(F.lit("lost")).cast("int")), root, "t", "v3", 202501, "prod")
    assert sinks.published(spark, root, "t") == before and rows("prod")[0] == (202501, 1)
    with pytest.raises(ValueError):
        sinks.read_published(spark, root, "t", "v3")


def test_sheets_with_banners_in_several_files(spark):
    d = _tmp()
    for i, header in enumerate(["Periodo,Sede"] * 2):
        with open(os.path.join(d, f"{i}.csv"), "w", encoding="utf-8") as f:
            f.write(f"Title {i}\n{header}\n20250{i + 1},Ica\nPeriodo,Sede{i}\n")
    got = sorted(map(tuple, ingest.read_sheet(spark, d, "csv", skip_banner=True).collect()))
    assert got == [("202501", "Ica"), ("202502", "Ica"), ("Periodo", "Sede0"), ("Periodo", "Sede1")]
    with open(os.path.join(d, "2.csv"), "w", encoding="utf-8") as f:
        f.write("Title\nSede,Periodo\nIca,202503\n")
    with pytest.raises(ValueError, match="2 of 3 files"):
        ingest.read_sheet(spark, d, "csv", skip_banner=True)


def test_snapshot_pins_the_last_whole_version_and_reports_missing_months(spark):
    root = _tmp()
    dm = drv.dims(spark)
    raw, synth = drv.raw_class_rows(spark, SF), drv.raw_synthetic(spark, SF)
    for v in ("v1", "v2"):
        platinum.build_and_write(raw.where("PERIODO <> 199705") if v == "v2" else raw, synth, dm, root, v, drv.PARAMS)
    sinks.write_by_period(platinum.facts_rollup(raw, dm, drv.PARAMS), root, "v3")     # no planner rows: not whole
    s = ingest.load_versioned(spark, root, None, 199912, drv.PARAMS)
    months = {r[0] for r in s.facts.select("PERIODO").distinct().collect()}
    missing = {r[0] for r in s.missing.collect()}
    assert 199705 in missing and not months & missing
    assert months | missing == set(ingest.history_periods(199912, drv.PARAMS))


def test_feature_specs_follow_the_regime():
    assert "CANT_ALUMNOS_LAG_12" in model.feature_spec("inicial_regular", 202501).numeric
    assert "CANT_ALUMNOS_LAG_12" not in model.feature_spec("inicial_regular", 202506).numeric
    assert model.feature_spec("continuidad_regular", 202503).target == "PCT_ALUMNOS"
    assert model.feature_spec("continuidad_regular", 202502).target == "CANT_ALUMNOS"
    assert model.feature_spec("continuidad_regular_horario", 202501).numeric == ("FAC_ALUMNOS_ANTERIOR",
                                                                                 "FAC_ALUMNOS_LAG_12")


def test_gbt_fit_save_load_score(spark):
    dm = drv.dims(spark)
    drv.reset_base()
    reg = drv.regular(spark, SF, dm)
    f = first_level.features(reg, dm, drv.TARGET_RANGE, drv.PARAMS)
    spec = model.feature_spec(first_level.FAMILY, 199906)
    train = f.where(F.col("PERIODO_TARGET") < 199906)
    m = model.fit(train, spec, max_iter=3)
    root = _tmp()
    model.save(m, root, first_level.FAMILY, "v1", 199906)
    scored = model.score(model.load(root, first_level.FAMILY, "v1", 199906),
                         f.where(F.col("PERIODO_TARGET") == 199906), spec)
    assert "prediction" in scored.columns and scored.where(F.col("prediction").isNull()).count() == 0
    rep = model.holdout_report(train, spec, max_iter=3)
    assert rep["rmse"] >= 0 and 0 < rep["n"] < train.count()


def test_registry_checks_what_it_loads(spark):
    rows = spark.createDataFrame([(float(i), "a" if i % 3 else "b", float(i * 2)) for i in range(40)], "x double, c string, y double")
    spec = model.Spec(("x",), ("c",), "y")
    fitted = model.fit_layer(rows, spec, max_iter=3)
    plain = model.fit(rows, spec, max_iter=3)
    of = lambda m: [r[0] for r in model.score(m, rows, spec).orderBy("x").select("prediction").collect()]
    assert of(fitted) == of(plain)
    root = _tmp()
    path = model.register(fitted, root, "t", "v1", 202501, "champion")
    assert of(model.registered(root, "t", "champion", 202501)) == of(model.registered(root, "t", "v1", 202501)) == of(fitted)
    with pytest.raises(ValueError, match="no model"):
        model.registered(root, "t", "v2", 202501)
    model.fit(rows, spec, max_iter=2).write().overwrite().save(path)
    with pytest.raises(ValueError, match="not those"):
        model.registered(root, "t", "v1", 202501)


def test_holdout_split_and_metrics(spark):
    x = model.with_holdout(spark.range(4000).withColumn("y", F.col("id") % 7), ["id"])
    share = x.where("HOLDOUT").count() / 4000
    assert 0.17 < share < 0.23
    again = model.with_holdout(spark.range(4000).repartition(13), ["id"]).where("HOLDOUT")
    assert {r[0] for r in again.select("id").collect()} == {r[0] for r in x.where("HOLDOUT").select("id").collect()}
    m = model.regression_metrics(spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0), (None, 1.0)], "y double, p double"), "p", "y").first()
    assert m.n == 3 and abs(m.rmse - (5 / 3) ** 0.5) < 1e-12 and abs(m.mae - 1.0) < 1e-12 and abs(m.r2 - (1 - 5 / 8)) < 1e-12


def test_verdict_sink_and_csv_passthrough(spark):
    d = _tmp()
    v = spark.createDataFrame([("inicial_regular", 0.41, 0.3, "approved")],
                              "tipo string, score double, threshold double, verdict string")
    path = sinks.write_verdict(v, d)
    assert [tuple(r) for r in spark.read.json(path).select("tipo", "verdict").collect()] == [("inicial_regular", "approved")]
    with open(os.path.join(d, "in.csv"), "w") as f:
        f.write("a,b\n1,x\n2,y\n3,z\n")
    n = ingest.csv_passthrough(spark, os.path.join(d, "in.csv"), os.path.join(d, "out"))
    assert n == 3 and spark.read.option("header", "true").csv(os.path.join(d, "out")).count() == 3


def test_seasonal_training_months():
    from cohortcast.functions import periods as per
    assert per.seasonal_training_periods(202503, [1, 2, 3]) == [202403, 202501, 202502, 202503]


def test_sheets_and_passthrough_files_are_compressed_and_bounded(spark, monkeypatch, tmp_path):
    from cohortcast.catalog import storage
    monkeypatch.setattr(storage, "_scratch", lambda _: str(tmp_path))
    monkeypatch.setitem(storage.CSV_FILES, "maxRecordsPerFile", 2000)
    rows = storage._sheet_rows(spark, SF).count()
    text = storage._sheet_rows(spark, SF).select(F.sum(F.length(F.to_csv(F.struct(*storage.SHEET))))).first()[0]
    size = lambda pattern: sum(f.stat().st_size for f in tmp_path.glob(pattern))
    got = storage.csv_passthrough(spark, SF)
    assert got.count() == rows and {r[0] for r in got.select("N_OBSERVED").distinct().collect()} == {rows}
    for part in ("in", "out"):
        assert 0 < size(f"{part}/part-*") < text / 2
        files = spark.read.csv(f"{tmp_path}/{part}", header=True).groupBy(F.col("_metadata.file_path")).count()
        assert files.agg(F.max("count")).first()[0] <= 2000
    assert storage.fact_sheet_scan(spark, SF).count() == rows
    assert 0 < size("prog-acad/*/*/part-*") < text / 2
