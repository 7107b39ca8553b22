"""Sinks (S8-S13): versioned, partitioned Parquet; never overwritten in place by month loops.

Writes are Spark jobs that executors can redo on failure: every sink writes through Spark's committer to a shared location.
Per-month outputs use dynamic partition overwrite, so a rerun replaces only the months in the batch; rows are rebalanced by month
before, so that a large month is written by several tasks and small ones share none of their files.

Published outputs (S11, S12) are batches that are written once and never changed, and one small file that says which batch holds
each month of each version and alias.  That file is replaced by an atomic rename, so a reader sees the state before or
after a publication, version and alias alike, and never a mixture.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODES = ("dev", "prod")


def write_versioned(df: DataFrame, root: str, name: str, version: str) -> str:
    """One dataset per version (overwrite of that version only)."""
    path = f"{root}/{name}/version={version}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_by_period(df: DataFrame, root: str, version: str, period_col: str = "PERIODO") -> str:
    """Per-month partitions; only the months present in ``df`` are replaced."""
    path = f"{root}/prog_acad/version={version}"
    (df.hint("rebalance", period_col)                 # AQE splits a large month over several writers
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(period_col).parquet(path))
    return path


def write_layer(df: DataFrame, root: str, tipo: str, version: str, split: str | None = None,
                period_col: str = "PERIODO_TARGET") -> str:
    """Features / targets keyed (tipo, version, split, month); months replaced dynamically."""
    parts = [f"tipo={tipo}", f"version={version}"] + ([f"split={split}"] if split else [])
    path = "/".join([root, *parts])
    (df.hint("rebalance", period_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(period_col).parquet(path))
    return path


def _catalog(root: str, tipo: str) -> str:
    return f"{root}/tipo={tipo}/published.json"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def published(spark: SparkSession, root: str, tipo: str) -> dict:
    """What is published: name of a version or alias -> "model month/month" -> batch."""
    p, fs = _path(spark, _catalog(root, tipo))
    if not fs.exists(p):
        return {}
    return json.loads(spark.read.text(p.toString(), wholetext=True).first()[0])


def _replace(spark: SparkSession, path: str, text: str) -> None:
    """The file's new text, put in place by one rename."""
    tmp, fs = _path(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(tmp)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    jvm = spark._jvm
    to = jvm.org.apache.hadoop.fs.Path(path)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(tmp), fs.makeQualified(to), how)


def replace_published(spark: SparkSession, root: str, tipo: str, state: dict) -> None:
    """The state that readers see from now on."""
    _replace(spark, _catalog(root, tipo), json.dumps(state, sort_keys=True))


def write_with_alias(df: DataFrame, root: str, tipo: str, version: str, model_period: int, mode: str,
                     period_col: str = "PERIODO_TARGET") -> str:
    """The months of ``df`` published under the model version and the ``dev`` / ``prod`` alias at once.

    The rows are written once; months that are not in ``df`` keep what they had under either name.  Returns the batch.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    spark, batch, model = df.sparkSession, uuid.uuid4().hex, int(model_period)
    path = f"{root}/tipo={tipo}/data/batch={batch}"
    (df.withColumn("MODEL_PERIODO", F.lit(model)).hint("rebalance", period_col)
       .write.partitionBy("MODEL_PERIODO", period_col).parquet(path))
    p, fs = _path(spark, f"{path}/MODEL_PERIODO={model}")
    months = [x.getPath().getName().split("=")[1] for x in fs.listStatus(p)] if fs.exists(p) else []   # calendar months
    state = published(spark, root, tipo)
    for name in (version, mode):
        state.setdefault(name, {}).update({f"{model}/{m}": batch for m in months})
    replace_published(spark, root, tipo, state)
    return batch


def read_published(spark: SparkSession, root: str, tipo: str, name: str, period_col: str = "PERIODO_TARGET") -> DataFrame:
    """The rows published under a version or alias, with MODEL_PERIODO and the month; only their folders are listed."""
    state = published(spark, root, tipo).get(name)
    if not state:
        raise ValueError(f"nothing is published under {name}")
    base = f"{root}/tipo={tipo}/data"
    paths = [f"{base}/batch={b}/MODEL_PERIODO={k.split('/')[0]}/{period_col}={k.split('/')[1]}" for k, b in state.items()]
    return spark.read.option("basePath", base).parquet(*paths).drop("batch")


def write_verdict(verdict: DataFrame, root: str, name: str = "response") -> str:
    """The one-row verdict frame (tipo, score, threshold, verdict)."""
    path = f"{root}/{name}"
    verdict.coalesce(1).write.mode("overwrite").json(path)    # one row a family
    return path


VERDICT_SCHEMA = "TIPO string, score double, threshold double, verdict string"


def read_verdict(spark: SparkSession, root: str, name: str = "response", schema: str = VERDICT_SCHEMA) -> DataFrame:
    """S13 read back; fields that a row leaves out (a null score) are null."""
    return spark.read.schema(schema).json(f"{root}/{name}")
