"""Exploratory analyses (A12-A15, O2, O6) as distributed jobs.

The month-by-month correlation sums products per pair of months: partial sums travel, never pairs of rows, and nothing
comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.periods import month_of, year_of
from ..operators import reshape


def students_by_site_month(cells: DataFrame, sites: list[str]) -> DataFrame:
    """A12 + R3: students per (YEAR, MONTH) with one column per site, missing -> 0.  A site that is not listed stops the query."""
    site = F.when(F.col("SEDE").isin(sites) | F.col("SEDE").isNull(), F.col("SEDE")).otherwise(
        F.raise_error(F.concat(F.lit("site without a column: "), F.col("SEDE"))).cast("string")).alias("SEDE")
    x = cells.select(year_of("PERIODO").alias("YEAR"), month_of("PERIODO").alias("MONTH"), site, "CANT_ALUMNOS")
    return reshape.pivot_sum(x, ["YEAR", "MONTH"], "SEDE", sites, "CANT_ALUMNOS")


def match_rate_by_version(evaluations: DataFrame) -> DataFrame:
    """Exact-match rate and row count per version after dropping zero-vs-zero rows."""
    kept = evaluations.where(~((F.col("CANT_CLASES") == 0) & (F.col("CANT_CLASES_PREDICT") == 0)))
    return kept.groupBy("VERSION").agg(
        F.avg((F.col("CANT_CLASES") == F.col("CANT_CLASES_PREDICT")).cast("double")).alias("MATCH"),
        F.count("CANT_CLASES").alias("CANT_CLASES"))


def site_totals(cells: DataFrame) -> DataFrame:
    """Classes and students per (site, month)."""
    return cells.groupBy("SEDE", "PERIODO").agg(F.sum("CANT_CLASES").alias("CANT_CLASES"),
                                               F.sum("CANT_ALUMNOS").alias("CANT_ALUMNOS"))


def month_correlation(cells: DataFrame, keys, value: str = "CANT_ALUMNOS") -> DataFrame:
    """Pearson correlation between months over cell keys (missing -> 0), long format (M1, M2, CORR).

    A key's months (at most the calendar's) give their products, which are summed per pair of months with map-side
    combine: one scan of the cells and a Gram matrix of at most months x months rows, written once.  A month without
    variance has no correlation (null).
    """
    from ..session import cut_lineage
    month = F.struct(F.col("PERIODO").alias("m"), F.sum(value).alias("v"))
    per = cells.groupBy(*keys, "PERIODO").agg(month.alias("x")).groupBy(*keys).agg(F.collect_list("x").alias("x"))
    pairs = F.flatten(F.transform("x", lambda a: F.transform(F.filter("x", lambda b: b.m >= a.m), lambda b: F.struct(
        a.m.alias("M1"), b.m.alias("M2"), (a.v * b.v).alias("p"), F.when(a.m == b.m, a.v).alias("s")))))
    one = F.struct(F.lit(0).alias("M1"), F.lit(0).alias("M2"), F.lit(1).cast("long").alias("p"), F.lit(0).cast("long").alias("s"))
    gram = cut_lineage(per.select(F.explode(F.concat(pairs, F.array(one))).alias("r")).select("r.*").groupBy("M1", "M2").agg(
        F.sum("p").alias("p"), F.sum("s").alias("s")))
    # the pair (0, 0) counts the keys; months x months is bounded by the calendar
    every = gram.where("M1 = M2").agg(F.collect_list(F.struct("M1", "p", "s")).alias("x"))
    n = F.get(F.filter("x", lambda r: r.M1 == 0), F.lit(0)).p.alias("n")
    real = F.filter("x", lambda r: r.M1 > 0)
    grid = every.select(n, real.alias("x")).select("n", "x", F.explode("x").alias("a")).select("n", "a", F.explode("x").alias("b"))
    j = grid.select(F.col("a.M1").alias("M_A"), F.col("b.M1").alias("M_B"), "n", "a", "b").join(
        gram.select("M1", "M2", F.col("p").alias("ab")),
        (F.least("M_A", "M_B") == F.col("M1")) & (F.greatest("M_A", "M_B") == F.col("M2")), "left")
    d = lambda c: F.col(c).cast("double")
    cov = d("n") * F.coalesce(d("ab"), F.lit(0.0)) - d("a.s") * d("b.s")
    var = lambda x: d("n") * d(f"{x}.p") - d(f"{x}.s") * d(f"{x}.s")
    return j.select(F.col("M_A").alias("M1"), F.col("M_B").alias("M2"), F.when(F.col("M_A") == F.col("M_B"), F.lit(1.0)).otherwise(
        F.try_divide(cov, F.sqrt(var("a")) * F.sqrt(var("b")))).alias("CORR"))


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """One row per key, the first under an explicit total order (never an arbitrary dropDuplicates)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_RN", F.row_number().over(w)).where(F.col("_RN") == 1).drop("_RN")
