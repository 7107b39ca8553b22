"""Continuing-course family (C4 candidates, C5 features, C8 targets), all months in one plan.

A cell of month m feeds the target month m+1 (monthly course) or m+2
(bimonthly course): the cohort base (F6) is a per-row target month, not a
join.  Its students move on to the successor course; in March seasonal
courses hand over to their mapped successor.  Every lookup is a broadcast
join; the predecessor roll-in (J8) and course totals are ``groupBy``s.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Params
from ..functions.periods import month_of, ord_period, period_ord, shift, shift_period
from ..functions.scalars import growth, program_group
from ..operators import clean, enrich
from ..operators.enrich import SUCC
from ..operators.quality import require
from ..operators.rollup import course_totals
from ..sources.dims import Dims

FAMILY = "continuidad_regular"
CANDIDATE_COLUMNS = ["PERIODO_TARGET", "PERIODO", "PERIODO_LAG_12", "SEDE", "CURSO_ANTERIOR", "CURSO_ACTUAL",
                     "IDX", "PE", "VAC_ACAD_ESTANDAR", "PE_ANTERIOR"]
ANTERIOR_KEYS = ["PERIODO_TARGET", "PERIODO_LAG_12", "SEDE", "CURSO_ACTUAL", "IDX", "PE", "PE_ANTERIOR",
                 "VAC_ACAD_ESTANDAR"]
COURSE_KEYS = ["PERIODO_TARGET", "SEDE", "CURSO_ACTUAL"]


def base_rows(full: DataFrame, dims: Dims, target_range: tuple[int, int], params: Params = DEFAULT) -> DataFrame:
    """each cell with the target month it feeds (+1 monthly, +2 bimonthly) and its course attributes."""
    attrs = enrich.course_attributes(dims, ["NIVEL", "FRECUENCIA", "DURACION", SUCC])
    step = (F.when(F.col("DURACION") == params.monthly, 1)
             .when(F.col("DURACION") == params.bimonthly, 2))
    lo, hi = target_range
    return (full.join(attrs, "CURSO_ACTUAL", "left")
                .withColumn("NIVEL", require("NIVEL", "course attributes", "CURSO_ACTUAL"))
                .withColumn("PERIODO_TARGET", ord_period(period_ord("PERIODO") + step))
                .where(F.col("PERIODO_TARGET").between(lo, hi)))


def finish_candidates(c: DataFrame, dims: Dims, params: Params) -> DataFrame:
    """Shared tail: predecessor PE on its own month, rename to the successor, PE / seats / flags on the target.

    J4 (twice), J5 and J3 fused into one pass: each catalogue table is joined
    once (broadcast), every looked-up value is checked, then one projection.
    """
    courses = dims["courses"]
    pred = dims.small("courses", courses.select(F.col("CURSO_ACTUAL").alias("_PRED"),
                                                F.col("PROGRAMA").alias("_PRED_PROG")))
    succ = dims.small("courses", courses.select(
        F.col("CURSO_ACTUAL").alias("_SUCC"), F.col("PROGRAMA").alias("_SUCC_PROG"),
        F.col("NIVEL").alias("_NIVEL"), F.col("LINEA_DE_NEGOCIO").alias("_LINEA"), F.col("CURSO_2").alias("_C2")))
    flag = dims.small("course_map", dims["course_map"].select(F.col("CURSO_ANTERIOR").alias("_SUCC"),
                                                              "FLAG_ESTACIONAL"))
    ini = dims.small("initial_courses", dims["initial_courses"].select(F.col("CURSOS_INICIALES").alias("_C2"),
                                                                       F.lit(1).alias("_INI")))
    x = (c.withColumnsRenamed({"CURSO_ACTUAL": "_PRED", SUCC: "_SUCC"})
          .join(pred, "_PRED", "left").join(succ, "_SUCC", "left").join(flag, "_SUCC", "left")
          .join(ini, "_C2", "left"))
    x = x.select(
        "*", program_group(require("_PRED_PROG", "programme", "_PRED"), params).alias("_PRED_PG"),
        program_group(require("_SUCC_PROG", "programme", "_SUCC"), params).alias("_SUCC_PG"),
        shift_period("PERIODO_TARGET", 12).alias("PERIODO_LAG_12"), F.lit(1).alias("IDX"))
    pe = dims["pe"]
    pe_prev = dims.small("pe", pe.select(F.col("PERIODO"), F.col("PROGRAMA").alias("_PRED_PG"),
                                         F.col("PE").alias("PE_ANTERIOR")))
    pe_tgt = dims.small("pe", pe.select(F.col("PERIODO").alias("PERIODO_TARGET"), F.col("PROGRAMA").alias("_SUCC_PG"),
                                        "PE"))
    seats = dims.small("seats", dims["seats"].select(
        F.col("PERIODO").alias("PERIODO_TARGET"), F.col("NIVEL").alias("_NIVEL"),
        F.col("LINEA_DE_NEGOCIO").alias("_LINEA"), "VAC_ACAD_ESTANDAR"))
    x = (x.join(pe_prev, ["PERIODO", "_PRED_PG"], "left").join(pe_tgt, ["PERIODO_TARGET", "_SUCC_PG"], "left")
          .join(seats, ["PERIODO_TARGET", "_NIVEL", "_LINEA"], "left"))
    keep = [k for k in c.columns if k not in ("CURSO_ACTUAL", SUCC)]
    out = x.select(
        *keep, F.col("_PRED").alias("CURSO_ANTERIOR"), F.col("_SUCC").alias("CURSO_ACTUAL"),
        "PERIODO_LAG_12", "IDX",
        require("PE_ANTERIOR", "break-even", "PERIODO").alias("PE_ANTERIOR"),
        require("PE", "break-even", "PERIODO_TARGET").alias("PE"),
        require("VAC_ACAD_ESTANDAR", "seats", "PERIODO_TARGET").alias("VAC_ACAD_ESTANDAR"),
        "FLAG_ESTACIONAL",
        # the flag checks ride on FLAG_INICIAL, which the filter below needs (an unused checked
        # column would be pruned away); a missing level shows up as a missing seats lookup
        F.when(require("FLAG_ESTACIONAL", "course flags", "_SUCC").isNotNull()
               & require("_C2", "course level index", "_SUCC").isNotNull() & F.col("_INI").isNotNull(), 1)
         .otherwise(0).alias("FLAG_INICIAL"))
    return out.where(F.col("FLAG_INICIAL") == 0)


def candidates(full: DataFrame, dims: Dims, target_range: tuple[int, int], params: Params = DEFAULT) -> DataFrame:
    """C4: (target, base month, site, predecessor, successor) rows."""
    b = base_rows(full, dims, target_range, params)
    march = month_of("PERIODO_TARGET") == params.substitution_month
    regular = (b.where((F.col("FLAG_ESTACIONAL") == 0) & clean.not_terminal(SUCC, params)
                       & ~(march & clean.march_excluded("NIVEL", "FRECUENCIA", "HORARIO_ACTUAL", params)))
                .select("PERIODO_TARGET", "PERIODO", "SEDE", "CURSO_ACTUAL", F.col(f"`{SUCC}`")).distinct())
    smap = dims.small("seasonal_course_map", dims["seasonal_course_map"].select("CURSO_ACTUAL", f"`{SUCC}`"))
    seasonal = (b.where((F.col("FLAG_ESTACIONAL") == 1) & march)
                 .select("PERIODO_TARGET", "PERIODO", "SEDE", "CURSO_ACTUAL")
                 .join(smap, "CURSO_ACTUAL", "left")
                 .withColumn(SUCC, require(f"`{SUCC}`", "seasonal successor", "CURSO_ACTUAL"))
                 .select("PERIODO_TARGET", "PERIODO", "SEDE", "CURSO_ACTUAL", F.col(f"`{SUCC}`")).distinct())
    return finish_candidates(regular.unionByName(seasonal), dims, params).select(*CANDIDATE_COLUMNS)


def targets(full: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Course-level actuals of non-initial regular courses, target blackout applied."""
    real = full.where((F.col("FLAG_ESTACIONAL") == 0) & (F.col("FLAG_INICIAL") == 0))
    t = course_totals(real).withColumnRenamed("PERIODO", "PERIODO_TARGET")
    return clean.drop_blackout(t, FAMILY, "target", params)


def anterior(cand: DataFrame, full: DataFrame) -> DataFrame:
    """J8 + A7: predecessor totals of the base month, re-aggregated to the successor."""
    tot = course_totals(full).withColumnRenamed("CURSO_ACTUAL", "CURSO_ANTERIOR")
    x = cand.join(tot, ["PERIODO", "SEDE", "CURSO_ANTERIOR"], "left")
    # partition on the successor course key: the roll-in aggregate (keys are a superset) and the
    # later joins on (target, site, course) all reuse it; a group is one course in one month
    x = x.repartition(*COURSE_KEYS)
    return x.groupBy(*ANTERIOR_KEYS).agg(
        F.sum(F.coalesce("CANT_CLASES", F.lit(0))).cast("double").alias("CANT_CLASES_ANTERIOR"),
        F.sum(F.coalesce("CANT_ALUMNOS", F.lit(0))).cast("double").alias("CANT_ALUMNOS_ANTERIOR"))


def features(full: DataFrame, dims: Dims, target_range: tuple[int, int], params: Params = DEFAULT,
             blackout: bool = True) -> DataFrame:
    """Candidates + predecessor roll-in + lag 12 + same period last year + actuals + growth targets."""
    lo, hi = target_range
    cand = candidates(full, dims, (shift(lo, 12), hi), params)
    ant = anterior(cand, full)
    tgt = targets(full, params)
    tot = course_totals(full)

    # Last year's predecessor totals vs last year's actuals, moved forward 12 months
    sply = (ant.select(*COURSE_KEYS, "CANT_CLASES_ANTERIOR", "CANT_ALUMNOS_ANTERIOR")
               .join(tgt, COURSE_KEYS, "left")
               .select(shift_period("PERIODO_TARGET", -12).alias("PERIODO_TARGET"), "SEDE", "CURSO_ACTUAL",
                       (F.coalesce("CANT_ALUMNOS", F.lit(0)) - F.col("CANT_ALUMNOS_ANTERIOR")).alias("DIFF_ALUMNOS_SPLY"),
                       growth(F.coalesce("CANT_ALUMNOS", F.lit(0)), "CANT_ALUMNOS_ANTERIOR", params).alias("PCT_ALUMNOS_SPLY"),
                       (F.coalesce("CANT_CLASES", F.lit(0)) - F.col("CANT_CLASES_ANTERIOR")).alias("DIFF_CLASES_SPLY"),
                       growth(F.coalesce("CANT_CLASES", F.lit(0)), "CANT_CLASES_ANTERIOR", params).alias("PCT_CLASES_SPLY")))

    f = ant.where(F.col("PERIODO_TARGET").between(lo, hi))
    lag12 = tot.select(F.col("PERIODO").alias("PERIODO_LAG_12"), "SEDE", "CURSO_ACTUAL",
                       F.col("CANT_CLASES").cast("double").alias("CANT_CLASES_LAG_12"),
                       F.col("CANT_ALUMNOS").cast("double").alias("CANT_ALUMNOS_LAG_12"))
    f = f.join(tgt, COURSE_KEYS, "left")          # co-partitioned with the roll-in
    f = f.join(sply, COURSE_KEYS, "left")
    f = f.join(lag12, ["PERIODO_LAG_12", "SEDE", "CURSO_ACTUAL"], "left")
    f = f.select(*ANTERIOR_KEYS, "CANT_CLASES_ANTERIOR", "CANT_ALUMNOS_ANTERIOR",
                 *[F.coalesce(c, F.lit(0.0)).alias(c) for c in
                   ("CANT_CLASES_LAG_12", "CANT_ALUMNOS_LAG_12", "DIFF_ALUMNOS_SPLY", "PCT_ALUMNOS_SPLY",
                    "DIFF_CLASES_SPLY", "PCT_CLASES_SPLY")],
                 F.coalesce("CANT_CLASES", F.lit(0)).cast("int").alias("CANT_CLASES"),
                 F.coalesce("CANT_ALUMNOS", F.lit(0)).cast("int").alias("CANT_ALUMNOS"))
    f = (f.withColumn("PCT_ALUMNOS", growth("CANT_ALUMNOS", "CANT_ALUMNOS_ANTERIOR", params))
          .withColumn("PCT_CLASES", growth("CANT_CLASES", "CANT_CLASES_ANTERIOR", params)))
    f = enrich.add_categoricals(f, dims, ("NIVEL", "CURSO_2", "FRECUENCIA", "DURACION"))
    if blackout:
        f = clean.drop_blackout(f, FAMILY, "features", params)
    return f
