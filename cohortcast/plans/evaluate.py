"""Evaluation and model comparison (J15, A9-A11, F15, F16, X12, C10, C11, S13 frames).

Metrics are one aggregation pass with conditional aggregates -- a single
partial/final aggregate, never a collect.  Scores per month and their mean are
``groupBy``s; verdicts are one-row frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Params
from ..functions.scalars import excess, exact_match, shortage
from ..sources.local import local_frame

EVAL_KEYS = ["PERIODO_TARGET", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL"]


def join_target(forecast: DataFrame, target: DataFrame, on_cols) -> DataFrame:
    """Full outer join on ``on_cols`` (keys merged), missing values filled and cast."""
    j = forecast.join(target, list(on_cols), "full")
    return (j.withColumn("CANT_CLASES", F.coalesce("CANT_CLASES", F.lit(0)).cast("int"))
             .withColumn("CANT_ALUMNOS", F.coalesce("CANT_ALUMNOS", F.lit(0)).cast("int"))
             .withColumn("CANT_ALUMNOS_PREDICT", F.coalesce("CANT_ALUMNOS_PREDICT", F.lit(0.0)).cast("double"))
             .withColumn("CANT_CLASES_PREDICT", F.coalesce("CANT_CLASES_PREDICT", F.lit(0.0)).cast("double"))
             .withColumn("IDX", F.coalesce("IDX", F.lit(0)).cast("int")))


def metrics(joined: DataFrame, group_cols=()) -> DataFrame:
    """The eight forecast metrics in one pass (per group, or one row).

    pct_comb / total_comb over rows that actually opened (F16); the others over
    rows that are not zero-vs-zero (F15).  Empty input gives nulls.
    """
    opened = F.col("CANT_CLASES") > 0
    kept = ~((F.col("CANT_CLASES_PREDICT") == 0) & (F.col("CANT_CLASES") == 0))
    aggs = [
        F.avg(F.when(opened, F.col("IDX").cast("double"))).alias("pct_comb"),
        F.sum(F.when(opened, F.col("IDX").cast("long"))).alias("total_comb"),
        F.sum(F.when(kept, shortage("CANT_CLASES", "CANT_CLASES_PREDICT"))).alias("faltante"),
        F.sum(F.when(kept, excess("CANT_CLASES", "CANT_CLASES_PREDICT"))).alias("sobrante"),
        F.avg(F.when(kept, exact_match("CANT_CLASES", "CANT_CLASES_PREDICT").cast("double"))).alias("precision"),
        F.sum(F.when(kept, F.col("CANT_CLASES").cast("long"))).alias("total_clases"),
        F.sum(F.when(kept, F.col("CANT_ALUMNOS").cast("long"))).alias("total_alumnos"),
        F.sum(F.when(kept, F.col("CANT_ALUMNOS_PREDICT"))).alias("total_alumnos_predict"),
    ]
    g = list(group_cols)
    return joined.groupBy(*g).agg(*aggs) if g else joined.agg(*aggs)


def monthly_scores(evaluation: DataFrame, group_cols=("PERIODO_TARGET",)) -> DataFrame:
    """A10: exact-match rate per month after dropping zero-vs-zero rows."""
    kept = evaluation.where(~((F.col("CANT_CLASES_PREDICT") == 0) & (F.col("CANT_CLASES") == 0)))
    return kept.groupBy(*group_cols).agg(
        F.avg(exact_match("CANT_CLASES", "CANT_CLASES_PREDICT").cast("double")).alias("score"))


def mean_score(scores: DataFrame, group_cols=(), months=None, month_col: str = "PERIODO_TARGET") -> DataFrame:
    """Unweighted mean of monthly scores (null when there are none).

    With the horizon ``months`` given, a month without a score stops the query: an incomplete evaluation has no mean.
    """
    g = list(group_cols)
    agg = F.avg("score")
    if months is not None:
        want = sorted({int(m) for m in months})
        have = F.count_distinct(F.when(F.col(month_col).isin(want), F.col(month_col)))
        agg = F.when(have < len(want), F.raise_error(F.concat(
            F.lit(f"horizon {want} has months with a score: "), have.cast("string"))).cast("double")).otherwise(agg)
    agg = agg.alias("score")
    return scores.groupBy(*g).agg(agg) if g else scores.agg(agg)


def verdict(mean_scores: DataFrame, params: Params = DEFAULT, family_col: str = "TIPO") -> DataFrame:
    """Approve when the mean score reaches the family's threshold (a null score is rejected)."""
    spark = mean_scores.sparkSession
    th = local_frame(spark, [(f, float(t)) for f, t in params.thresholds], f"{family_col} string, threshold double")
    j = mean_scores.join(F.broadcast(th), family_col, "left")
    return j.withColumn("verdict", F.when(F.col("score") >= F.col("threshold"), "approved").otherwise("rejected"))


COMPARED = ("inicial_regular", "continuidad_regular_horario")


def compare(mean_scores: DataFrame, champion: str, challenger: str, compared=COMPARED,
            family_col: str = "TIPO", version_col: str = "VERSION") -> DataFrame:
    """C11: the challenger is approved only if strictly better in every compared family.

    Families with no score count as 0.0.  One row per family plus the decision.
    """
    spark: SparkSession = mean_scores.sparkSession
    fams = local_frame(spark, [(f,) for f in compared], f"{family_col} string")
    s = mean_scores.where(F.col(version_col).isin(champion, challenger))
    piv = s.groupBy(family_col).agg(
        F.max(F.when(F.col(version_col) == champion, F.col("score"))).alias("champion_score"),
        F.max(F.when(F.col(version_col) == challenger, F.col("score"))).alias("challenger_score"))
    rows = (fams.join(piv, family_col, "left")
                .withColumn("champion_score", F.coalesce("champion_score", F.lit(0.0)))
                .withColumn("challenger_score", F.coalesce("challenger_score", F.lit(0.0)))
                .withColumn("better", F.col("challenger_score") > F.col("champion_score")))
    # one row per compared family (a handful), so the decision window is tiny
    everywhere = F.min(F.col("better").cast("int")).over(Window.partitionBy(F.lit(1)))
    return rows.withColumn("verdict", F.when(everywhere == 1, "approved").otherwise("rejected"))
