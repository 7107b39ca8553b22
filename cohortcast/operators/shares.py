"""Share normalisation and largest-remainder apportionment.

All windows of the apportioner are partitioned by the same course key
(PERIODO_TARGET, SEDE, CURSO_ACTUAL), so Spark shuffles once and only re-sorts
between window stages.  A window group holds the slots of one course in one
month -- bounded by the slot catalogue, never by the data volume.

Tie rule: among equal remainders the later slot wins (the production code
takes the top of a reversed ascending argsort over slot-sorted rows), so
ranks order by remainder desc, then slot desc, then every other column.
Remainders are compared after rounding to ``TIE_DIGITS`` decimals: shares
that are equal in exact arithmetic differ only by summation-order noise, and
the order of rows inside a window partition is not fixed, so without the
rounding such ties would be broken at random.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quality import require

COURSE_KEY = ["PERIODO_TARGET", "SEDE", "CURSO_ACTUAL"]
FAC_COLUMNS = ["PERIODO_TARGET", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL", "IDX", "PE", "VAC_ACAD_ESTANDAR",
               "FAC_ALUMNOS_PREDICT", "CANT_ALUMNOS_ANTERIOR", "CANT_CLASES_ANTERIOR"]


def share_of_parent(value: str, parent_keys) -> Column:
    """Value / sum(value) over the parent; 0/0 -> null."""
    return F.try_divide(F.col(value).cast("double"),
                        F.sum(value).over(Window.partitionBy(*parent_keys)).cast("double"))


TIE_DIGITS = 9
# Columns that complete the ordering when remainder and slot tie (duplicated slots).
TIEBREAK = ["CANT_ALUMNOS_PREDICT", "FAC_ALUMNOS_PREDICT", "CANT_ALUMNOS_ANTERIOR", "CANT_CLASES_ANTERIOR",
            "PE", "VAC_ACAD_ESTANDAR", "IDX", "HORARIO_ACTUAL"]


def largest_remainder(df: DataFrame, amount: str, out: str, keys=COURSE_KEY, slot: str = "HORARIO_ACTUAL",
                      eligible: Column | None = None) -> DataFrame:
    """floor(amount) plus one unit for the round(sum of remainders) largest remainders.

    ``amount`` is each row's fractional allotment; rows where ``eligible`` is
    false take no part (their ``out`` is null).  ``round`` is half-even.
    """
    elig = F.lit(True) if eligible is None else eligible
    x = df.withColumn("_ELIG", elig)
    x = x.withColumn("_Q", F.when(F.col("_ELIG"), F.floor(F.col(amount)).cast("double")))
    x = x.withColumn("_R", F.when(F.col("_ELIG"), F.col(amount) - F.col("_Q")))
    w = Window.partitionBy(*keys)
    x = x.withColumn("_K", F.bround(F.sum("_R").over(w), 0))
    order = [F.col("_ELIG").desc(), F.round("_R", TIE_DIGITS).desc_nulls_last(), F.col(slot).desc_nulls_last()]
    order += [F.col(c).desc_nulls_last() for c in TIEBREAK if c in df.columns and c not in keys and c != slot]
    x = x.withColumn("_RANK", F.row_number().over(w.orderBy(*order)))
    x = x.withColumn(out, F.when(F.col("_ELIG"), F.col("_Q") + F.when(F.col("_RANK") <= F.col("_K"), 1.0)
                                 .otherwise(0.0)))
    return x.drop("_ELIG", "_Q", "_R", "_K", "_RANK")


def normalise_shares(df: DataFrame, share: str = "FAC_ALUMNOS_PREDICT", keys=COURSE_KEY) -> DataFrame:
    """Shares divided by their course sum; an all-zero course gets equal weights.

    Like the production code, the emitted share column is overwritten with 1
    for all-zero courses.  Adds ``_W`` (normalised weight).
    """
    w = Window.partitionBy(*keys)
    total = F.sum(share).over(w)
    x = df.withColumn(share, F.when(total == 0, F.lit(1.0)).otherwise(F.col(share).cast("double")))
    return x.withColumn("_W", F.col(share) / F.sum(share).over(w))


def apportion_basic(df: DataFrame, total: str = "CANT_ALUMNOS_PREDICT", share: str = "FAC_ALUMNOS_PREDICT",
                    out: str = "CANT_ALUMNOS", keys=COURSE_KEY) -> DataFrame:
    """W1 + W2: split each course total over its slots by largest remainder."""
    x = normalise_shares(df, share, keys).withColumn("_AMT", F.col(total).cast("double") * F.col("_W"))
    return largest_remainder(x, "_AMT", out, keys).drop("_W", "_AMT")


def reallocate_below_minimum(df: DataFrame, students: str = "CANT_ALUMNOS", pe: str = "PE",
                             keys=COURSE_KEY) -> DataFrame:
    """Single-slot courses pass; otherwise slots under PE are dropped and their
    students spread over the kept slots in proportion to size (largest remainder).
    A course with no slot at PE disappears."""
    w = Window.partitionBy(*keys)
    x = (df.withColumn("_N", F.count(F.lit(1)).over(w))
           .withColumn("_GT", F.col(students) >= F.col(pe))
           .withColumn("_LT_TOTAL", F.sum(F.when(~F.col("_GT"), F.col(students)).otherwise(0.0)).over(w))
           .withColumn("_GT_TOTAL", F.sum(F.when(F.col("_GT"), F.col(students)).otherwise(0.0)).over(w)))
    x = x.where((F.col("_N") == 1) | F.col("_GT"))
    x = x.withColumn("_AMT", F.try_divide(F.col(students), F.col("_GT_TOTAL")) * F.col("_LT_TOTAL"))
    x = largest_remainder(x, "_AMT", "_ADD", keys, eligible=(F.col("_N") > 1) & (F.col("_LT_TOTAL") != 0))
    x = x.withColumn(students, F.col(students) + F.coalesce(F.col("_ADD"), F.lit(0.0)))
    return x.drop("_N", "_GT", "_LT_TOTAL", "_GT_TOTAL", "_AMT", "_ADD")


def apportion(forecast_fac: DataFrame, forecast_cant: DataFrame, missing: str = "raise") -> DataFrame:
    """Course forecast (students) -> slot forecast.

    F14 course forecast >= PE, J14 left join to the slot shares (must match), W1 normalise, W2 apportion, W3
    reallocate; output CANT_ALUMNOS_PREDICT per slot.  A course without slots stops the query (``missing="raise"``), or
    stays as one row without a slot that holds all its students (``missing="report"``): none are lost unseen.
    """
    if missing not in ("raise", "report"):
        raise ValueError(f"missing must be raise or report, not {missing}")
    fac = forecast_fac.select(*FAC_COLUMNS)
    cant = (forecast_cant.where(F.col("CANT_ALUMNOS_PREDICT") >= F.col("PE"))
                         .select(*COURSE_KEY, "CANT_ALUMNOS_PREDICT"))
    j = cant.join(fac, COURSE_KEY, "left")
    if missing == "raise":
        j = j.withColumn("FAC_ALUMNOS_PREDICT",
                         require("FAC_ALUMNOS_PREDICT", "slot share for course forecast", "CURSO_ACTUAL"))
    x = apportion_basic(j)
    if missing == "report":
        x = x.withColumn("CANT_ALUMNOS", F.when(F.col("HORARIO_ACTUAL").isNull(), F.col("CANT_ALUMNOS_PREDICT"))
                         .otherwise(F.col("CANT_ALUMNOS")))
    x = reallocate_below_minimum(x)
    return x.drop("CANT_ALUMNOS_PREDICT").withColumnRenamed("CANT_ALUMNOS", "CANT_ALUMNOS_PREDICT")


def overflow_reallocation(df: DataFrame, keys=("PERIODO_TARGET", "SEDE"), short: str = "raise") -> DataFrame:
    """Cap students at classes x seats, spread the overflow over free seats (largest remainder).

    The legacy rule worked frame-wide and demanded enough free seats; at scale it runs per group ``keys`` so no
    single task holds the whole frame, and a group may lack seats where the frame does not.  Such a group stops the
    query (``short="raise"``), or its seats are filled and the students left over are told in
    CANT_ALUMNOS_SIN_CUPO, one number per group (``short="report"``): no one is placed above capacity or lost.
    """
    if short not in ("raise", "report"):
        raise ValueError(f"short must be raise or report, not {short}")
    keys = list(keys)
    w = Window.partitionBy(*keys)
    cap = F.col("CANT_CLASES_PREDICT") * F.col("VAC_ACAD_ESTANDAR")
    x = df.withColumn("_NEW", F.when(F.col("CANT_CLASES_PREDICT") > 0,
                                     F.least(cap, F.col("CANT_ALUMNOS_PREDICT"))).otherwise(0.0))
    x = x.withColumn("_OVER", F.col("CANT_ALUMNOS_PREDICT") - F.col("_NEW"))
    x = x.withColumn("_SPACE", F.when((F.col("CANT_CLASES_PREDICT") > 0) & (F.col("_OVER") == 0),
                                      cap - F.col("_NEW")).otherwise(0.0))
    x = x.withColumn("_ALL", F.sum("_OVER").over(w)).withColumn("_FREE", F.sum("_SPACE").over(w))
    left = F.greatest(F.col("_ALL") - F.col("_FREE"), F.lit(0.0))
    if short == "raise":
        left = F.when(left > 0, F.raise_error(F.concat(F.lit("W5: free seats don't suffice, students left: "),
                                                       left.cast("string"))).cast("double")).otherwise(left)
    x = x.withColumn("CANT_ALUMNOS_SIN_CUPO", left)
    x = x.withColumn("_AMT", F.least("_ALL", "_FREE") * F.try_divide(F.col("_SPACE"), F.col("_FREE")))
    x = largest_remainder(x, "_AMT", "_ADD", keys, slot="CURSO_ACTUAL")
    x = x.withColumn("CANT_ALUMNOS_PREDICT", F.col("_NEW") + F.coalesce(F.col("_ADD"), F.lit(0.0)) +
                     F.when(F.col("CANT_ALUMNOS_SIN_CUPO") > 0, 0.0).otherwise(0.0))   # keeps the check in the plan
    return x.drop("_NEW", "_OVER", "_SPACE", "_ALL", "_FREE", "_AMT", "_ADD")
