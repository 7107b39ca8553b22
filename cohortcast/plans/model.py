"""Boosted-tree models (M1-M4) as MLlib pipelines.

StringIndexer for the categoricals (unseen values kept as their own bucket),
VectorAssembler, GBTRegressor -- a distributed fit; scoring is a plain
``transform``.  Null numeric inputs (undefined shares) become -1, below every
real value, and rows with a null label (growth over a zero base) are dropped.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Params


@dataclass(frozen=True)
class Spec:
    numeric: tuple
    categorical: tuple
    target: str


def feature_spec(family: str, model_period: int, params: Params = DEFAULT) -> Spec:
    """M2: feature contract per family and regime (regime = month of the model month)."""
    m = model_period % 100
    seasonal = m in params.seasonal_months
    if family == "inicial_regular":
        num = ("CANT_ALUMNOS_LAG_12",) if seasonal else ()
        return Spec(num + ("CANT_ALUMNOS_LAG_01", "CANT_ALUMNOS_LAG_02", "CANT_ALUMNOS_LAG_03"),
                    ("NIVEL", "LEVEL", "IDX_CURSO", "SEDE", "FRECUENCIA", "DURACION"), "CANT_ALUMNOS")
    if family == "continuidad_regular":
        cat = ("LEVEL", "IDX_CURSO", "SEDE", "FRECUENCIA", "DURACION")
        if m in (1, 3):
            return Spec(("CANT_ALUMNOS_LAG_12", "CANT_ALUMNOS_ANTERIOR", "PCT_ALUMNOS_SPLY"), cat, "PCT_ALUMNOS")
        return Spec(("CANT_ALUMNOS_ANTERIOR",), cat, "CANT_ALUMNOS")
    if family == "continuidad_regular_horario":
        num = ("FAC_ALUMNOS_ANTERIOR",) + (("FAC_ALUMNOS_LAG_12",) if seasonal else ())
        return Spec(num, ("NIVEL", "LEVEL", "IDX_CURSO", "SEDE"), "FAC_ALUMNOS")
    raise ValueError(f"unknown family {family}")


def prepare(df: DataFrame, spec: Spec) -> DataFrame:
    """Null numerics -> -1 sentinel, label as double, rows without a label dropped."""
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(-1.0)).alias(c) for c in spec.numeric]
    keep = [c for c in df.columns if c not in spec.numeric]
    return (df.select(*keep, *cols).withColumn("label", F.col(spec.target).cast("double"))
              .where(F.col("label").isNotNull() & ~F.isnan("label")))


def build_pipeline(spec: Spec, indexer: StringIndexerModel, max_iter: int = 500, max_depth: int = 6, step: float = 0.1,
                   min_rows: int = 5, max_bins: int = 64, seed: int = 7) -> Pipeline:
    """M1: indexers + assembler + GBT (RMSE loss), the production hyper-parameters as defaults.

    There are at least as many bins as any categorical has values, unseen ones included, however many that is.
    """
    max_bins = max([max_bins, *(len(labels) + 1 for labels in indexer.labelsArray)])
    asm = VectorAssembler(inputCols=list(spec.numeric) + [f"{c}__idx" for c in spec.categorical],
                          outputCol="features", handleInvalid="keep")
    gbt = GBTRegressor(featuresCol="features", labelCol="label", maxIter=max_iter, maxDepth=max_depth,
                       stepSize=step, minInstancesPerNode=min_rows, maxBins=max_bins, lossType="squared", seed=seed)
    return Pipeline(stages=[indexer, asm, gbt])


def fit_prepared(rows: DataFrame, spec: Spec, **kw) -> PipelineModel:
    """All categoricals are indexed in one pass, then the trees are fitted."""
    indexer = StringIndexer(inputCols=list(spec.categorical), outputCols=[f"{c}__idx" for c in spec.categorical],
                            handleInvalid="keep").fit(rows)
    return build_pipeline(spec, indexer, **kw).fit(rows)


def fit(train: DataFrame, spec: Spec, **kw) -> PipelineModel:
    return fit_prepared(prepare(train, spec), spec, **kw)


def score(model: PipelineModel, test: DataFrame, spec: Spec) -> DataFrame:
    """Every test row is scored (rows whose label is undefined are kept; only training drops them)."""
    x = test.select(*[c for c in test.columns if c not in spec.numeric],
                    *[F.coalesce(F.col(c).cast("double"), F.lit(-1.0)).alias(c) for c in spec.numeric])
    return model.transform(x)


def assembled(rows: DataFrame, spec: Spec, indexer: StringIndexerModel, rows_per_task: int = 50_000) -> DataFrame:
    """The training layer, written once: label and vector of ``prepare``d rows, dealt evenly so that each of the hundreds of
    passes over it reads balanced partitions and nothing upstream is ever run again."""
    from ..session import cut_lineage
    asm = VectorAssembler(inputCols=list(spec.numeric) + [f"{c}__idx" for c in spec.categorical], outputCol="features",
                          handleInvalid="keep")
    layer = cut_lineage(asm.transform(indexer.transform(rows)).select("label", "features"))
    return layer.repartition(max(1, -(-layer.count() // rows_per_task)))


def fit_layer(train: DataFrame, spec: Spec, **kw) -> PipelineModel:
    """M1 + M2 for production sizes: index, assemble and write the layer once, then fit the trees on it (lineage checkpointed
    every ten trees into the shared folder).  The result scores raw feature rows like ``fit``'s."""
    from ..session import ensure_checkpoint_dir
    rows = prepare(train, spec)
    ensure_checkpoint_dir(rows.sparkSession)
    indexer = StringIndexer(inputCols=list(spec.categorical), outputCols=[f"{c}__idx" for c in spec.categorical],
                            handleInvalid="keep").fit(rows)
    pipeline = build_pipeline(spec, indexer, **kw)
    _, asm, gbt = pipeline.getStages()
    trees = gbt.setCheckpointInterval(10).fit(assembled(rows, spec, indexer))
    return PipelineModel(stages=[indexer, asm, trees])


# ---- M3: registry -------------------------------------------------------------------------------------

def save(model: PipelineModel, root: str, family: str, version: str, model_period: int) -> str:
    """M3: one model per (family, version, model month)."""
    path = f"{root}/tipo={family}/version={version}/model_periodo={model_period}"
    model.write().overwrite().save(path)
    return path


def load(root: str, family: str, version: str, model_period: int) -> PipelineModel:
    return PipelineModel.load(f"{root}/tipo={family}/version={version}/model_periodo={model_period}")


def digest(spark: SparkSession, path: str) -> str:
    """One SHA-256 over all data files below ``path`` (names that writers make up don't count, the contents do)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
             .select(F.regexp_replace(F.regexp_replace("path", r"part-.*$", ""), r"^.*/(?=(stages|metadata|data)/)", "").alias(
                 "place"), F.sha2("content", 256).alias("sha")))
    return files.agg(F.sha2(F.array_join(F.sort_array(F.collect_list(F.concat("place", F.lit(" "), "sha"))), "\n"),
                            256)).first()[0]                  # a model's files: some per stage


def register(model: PipelineModel, root: str, family: str, version: str, model_period: int, alias: str | None = None) -> str:
    """M3: the model saved under a path of its own and recorded with its digest under the version and, if given, an alias; one
    atomic replacement shows both."""
    from ..sources import sinks
    spark = SparkSession.active()
    path = f"{root}/tipo={family}/models/{uuid.uuid4().hex}"
    model.write().save(path)
    state = sinks.published(spark, f"{root}/registry", family)
    entry = {"path": path, "sha256": digest(spark, path)}
    for name in filter(None, (version, alias)):
        state.setdefault(name, {})[str(int(model_period))] = entry
    sinks.replace_published(spark, f"{root}/registry", family, state)
    return path


def registered(root: str, family: str, name: str, model_period: int) -> PipelineModel:
    """The model recorded under a version or alias; files that changed since then stop the loading."""
    from ..sources import sinks
    spark = SparkSession.active()
    entry = sinks.published(spark, f"{root}/registry", family).get(name, {}).get(str(int(model_period)))
    if entry is None:
        raise ValueError(f"no model of {family} for {model_period} under {name}")
    if digest(spark, entry["path"]) != entry["sha256"]:
        raise ValueError(f"the files of {entry['path']} are not those that were registered")
    return PipelineModel.load(entry["path"])


# ---- M4: hold-out -------------------------------------------------------------------------------------

def with_holdout(df: DataFrame, keys, share: float = 0.2, seed: int = 7, out: str = "HOLDOUT") -> DataFrame:
    """M4: a split that depends on the row's keys alone, not on partitions or engines: the first eight hex digits of the MD5 of the
    keys and the seed, below the share of 2 ** 32."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys], F.lit(str(seed)))
    return df.withColumn(out, F.substring(F.md5(text), 1, 8) < F.lit(f"{round(share * (1 << 32)):08x}"))


def regression_metrics(df: DataFrame, prediction: str, label: str, group=()) -> DataFrame:
    """n, rmse, mae and r2 in one aggregate (r2 is null where the label does not vary)."""
    y, e = F.col(label).cast("double"), F.col(label).cast("double") - F.col(prediction).cast("double")
    return df.groupBy(*group).agg(
        F.count(e).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (1 - F.try_divide(F.avg(e * e), F.var_pop(F.when(e.isNotNull(), y)))).alias("r2"))


def holdout_report(df: DataFrame, spec: Spec, keys=("PERIODO_TARGET", "SEDE", "CURSO_ACTUAL"), seed: int = 7, **kw) -> dict:
    """M4: fit on the rows outside the hold-out, metrics on those inside."""
    x = with_holdout(df, keys, seed=seed)
    fitted = fit_layer(x.where(~F.col("HOLDOUT")), spec, **kw)
    scored = score(fitted, x.where("HOLDOUT"), spec)
    return regression_metrics(scored, "prediction", spec.target).first().asDict()
