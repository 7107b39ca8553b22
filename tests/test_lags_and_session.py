"""The two lag forms agree (J7), and session helpers."""

from pyspark.sql import functions as F

from cohortcast.operators import lags, rollup
from cohortcast.session import cluster_conf, ensure_checkpoint_dir
from cohortcast.sources import driver as drv

SF = "/root/testdata/sf0.001"
KEYS = ["SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL"]


def test_join_and_fanout_lags_agree(spark):
    cells = rollup.platinum_rollup(drv.class_rows(spark, SF))
    idx = cells.select(F.col("PERIODO").alias("PERIODO_TARGET"), *KEYS)
    joined = idx
    for n in (1, 2, 3, 12):
        joined = lags.lag_join(joined, cells, n, KEYS)
    fan = lags.lag_fanout(cells, KEYS, (0, 1, 2, 3, 12))
    g = fan.groupBy("PERIODO_TARGET", *KEYS).agg(
        F.max(F.col("LAG") == 0).alias("_HERE"),
        *[F.coalesce(lags.lag_value(n, v), F.lit(0)).cast("double").alias(f"{v}_LAG_{n:02d}")
          for n in (1, 2, 3, 12) for v in ("CANT_CLASES", "CANT_ALUMNOS")]).where("_HERE").drop("_HERE")
    cols = ["PERIODO_TARGET", *KEYS] + [f"{v}_LAG_{n:02d}" for n in (1, 2, 3, 12) for v in ("CANT_CLASES", "CANT_ALUMNOS")]
    a = sorted(tuple(r) for r in joined.select(*cols).collect())
    b = sorted(tuple(r) for r in g.select(*cols).collect())
    assert a == b and len(a) > 0


def test_cluster_conf_and_checkpoint_dir(spark):
    conf = cluster_conf(4000)
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert int(conf["spark.sql.shuffle.partitions"]) == 12000
    d = ensure_checkpoint_dir(spark)
    assert d and ensure_checkpoint_dir(spark) == d
