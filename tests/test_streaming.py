"""Incremental monthly ingest: months land as files, a corrected month replaces only itself."""

import tempfile
import time

from pyspark.sql import functions as F

from cohortcast.plans import platinum
from cohortcast.sources import driver as drv
from cohortcast.sources.ingest import RAW_CLASS_SCHEMA
from cohortcast.streaming.monthly_ingest import start_monthly_ingest

SF = "/root/testdata/sf0.001"


def _raw_month(spark, month):
    raw = drv.raw_class_rows(spark, SF).where(F.col("PERIODO") == month)
    return raw.select(*[F.col(f.name).cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)
                        .alias(f.name) for f in RAW_CLASS_SCHEMA.fields])


def test_monthly_stream_replaces_only_resent_months(spark):
    base = tempfile.mkdtemp(prefix="cohortcast-stream-")
    landing, root, ckpt = f"{base}/landing", f"{base}/platinum", f"{base}/ckpt"
    dm = drv.dims(spark)
    a, b = 199803, 199804
    _raw_month(spark, a).repartition(4).write.parquet(f"{landing}/{a}")        # a month of several files
    _raw_month(spark, b).write.parquet(f"{landing}/{b}")
    q = start_monthly_ingest(spark, landing, root, "v1", dm, ckpt, drv.PARAMS)
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/prog_acad/version=v1")
    want = platinum.facts_rollup(drv.raw_class_rows(spark, SF).where(F.col("PERIODO").isin(a, b)), dm, drv.PARAMS)
    cols = ["PERIODO", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL", "CANT_CLASES", "CANT_ALUMNOS"]
    assert sorted(map(tuple, out.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))

    # month a is re-sent with the rows of one site only: month a is replaced, month b untouched
    time.sleep(1)
    _raw_month(spark, a).where(F.col("SEDE").endswith("AFRICA")).write.parquet(f"{landing}/{a}-fix")
    q = start_monthly_ingest(spark, landing, root, "v1", dm, ckpt, drv.PARAMS)
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/prog_acad/version=v1")
    sites_a = {r[0] for r in out.where(F.col("PERIODO") == a).select("SEDE").distinct().collect()}
    assert sites_a == {"AFRICA"}
    assert out.where(F.col("PERIODO") == b).count() == want.where(F.col("PERIODO") == b).count()
