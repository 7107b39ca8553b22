"""First-level family (C2 candidates, C3 features, C8 targets), all months in one plan.

Candidates for target month t are the (site, course, slot) cells of initial
courses seen in t-1..t-3 (plus t-12 in the listed months), minus the March
slot exclusion, that fit the site's opening hours.  Here every roll-up cell
is fanned out to the targets it feeds (lags 0, 1, 2, 3, 12) and a single
``groupBy`` yields, per target cell, whether it is a candidate, the four lag
values and the actuals -- one shuffle for the whole family.  Lookups are
broadcast joins against catalogue tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Params
from ..functions.periods import month_of, shift_period
from ..operators import clean, enrich
from ..operators.lags import lag_fanout, lag_value
from ..sources.dims import Dims

FAMILY = "inicial_regular"
KEYS = ["SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL"]
LAGS = (1, 2, 3, 12)
CANDIDATE_COLUMNS = ["PERIODO_TARGET", "PERIODO_LAG_01", "PERIODO_LAG_02", "PERIODO_LAG_03", "PERIODO_LAG_12",
                     "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL", "IDX", "PE", "VAC_ACAD_ESTANDAR"]
LAG_COLUMNS = [f"{v}_LAG_{n:02d}" for n in LAGS for v in ("CANT_CLASES", "CANT_ALUMNOS")]


def _blackout_flag(df: DataFrame, use: str, params: Params, name: str) -> DataFrame:
    bl = (clean.blackout_frame(df.sparkSession, params)
          .where((F.col("TIPO") == FAMILY) & (F.col("USE") == use))
          .select("SEDE", "PERIODO_TARGET", F.lit(True).alias(name)))
    return df.join(F.broadcast(bl), ["SEDE", "PERIODO_TARGET"], "left")


def grouped(regular: DataFrame, target_range: tuple[int, int], params: Params = DEFAULT) -> DataFrame:
    """One row per (target, cell) of initial courses: candidate flag, lag values, actuals."""
    ini = regular.where(F.col("FLAG_INICIAL") == 1)
    fan = lag_fanout(ini, KEYS, (0, *LAGS), target_range=target_range)
    aggs = [F.max(F.col("LAG").isin(1, 2, 3)).alias("_RECENT"),
            F.max(F.col("LAG") == 12).alias("_YEAR_AGO"),
            F.max(F.col("LAG") == 0).alias("_HAS_ACTUAL")]
    for n in LAGS:
        for v in ("CANT_CLASES", "CANT_ALUMNOS"):
            aggs.append(lag_value(n, v).alias(f"{v}_LAG_{n:02d}"))
    aggs += [lag_value(0, "CANT_CLASES").alias("CANT_CLASES"), lag_value(0, "CANT_ALUMNOS").alias("CANT_ALUMNOS")]
    return fan.groupBy("PERIODO_TARGET", *KEYS).agg(*aggs)


def candidates_from(g: DataFrame, dims: Dims, params: Params = DEFAULT) -> DataFrame:
    """C2 on the grouped frame: candidate rule, March exclusion, PE, seats, opening hours."""
    m = month_of("PERIODO_TARGET")
    is_cand = F.col("_RECENT") | (F.col("_YEAR_AGO") & m.isin(list(params.lag12_candidate_months)))
    c = g.where(is_cand)
    attrs = enrich.course_attributes(dims, ["NIVEL", "FRECUENCIA"])
    c = (c.join(attrs, "CURSO_ACTUAL", "left")
          .where(~((m == params.substitution_month)
                   & clean.march_excluded("NIVEL", "FRECUENCIA", "HORARIO_ACTUAL", params)))
          .drop("NIVEL", "FRECUENCIA"))
    for n in LAGS:
        c = c.withColumn(f"PERIODO_LAG_{n:02d}", shift_period("PERIODO_TARGET", n))
    c = c.withColumn("IDX", F.lit(1))
    c = enrich.add_pe(c, dims, "PERIODO_TARGET", params)
    c = enrich.add_seats(c, dims, "PERIODO_TARGET")
    return enrich.within_opening_hours(c, dims, "PERIODO_TARGET")


def candidates(regular: DataFrame, dims: Dims, target_range: tuple[int, int], params: Params = DEFAULT) -> DataFrame:
    """Candidate cells for every target month in ``target_range``."""
    return candidates_from(grouped(regular, target_range, params), dims, params).select(*CANDIDATE_COLUMNS)


def features(regular: DataFrame, dims: Dims, target_range: tuple[int, int], params: Params = DEFAULT,
             blackout: bool = True) -> DataFrame:
    """Candidates + lags 1, 2, 3, 12 + actuals (J11) + categoricals (J12, X3), features blackout."""
    c = candidates_from(grouped(regular, target_range, params), dims, params)
    c = _blackout_flag(c, "target", params, "_TGT_OUT")
    for col in LAG_COLUMNS:
        c = c.withColumn(col, F.coalesce(F.col(col).cast("double"), F.lit(0.0)))
    for col in ("CANT_CLASES", "CANT_ALUMNOS"):
        c = c.withColumn(col, F.when(F.col("_TGT_OUT").isNull(), F.coalesce(F.col(col), F.lit(0)))
                         .otherwise(F.lit(0)).cast("int"))
    c = c.select(*CANDIDATE_COLUMNS, *LAG_COLUMNS, "CANT_CLASES", "CANT_ALUMNOS")
    c = enrich.add_categoricals(c, dims, ("NIVEL", "CURSO_2", "FRECUENCIA", "DURACION"))
    if blackout:
        c = clean.drop_blackout(c, FAMILY, "features", params)
    return c


def targets(regular: DataFrame, periods_range: tuple[int, int], params: Params = DEFAULT) -> DataFrame:
    """Slot-level actuals of initial courses per target month, target blackout applied."""
    lo, hi = periods_range
    t = (regular.where((F.col("FLAG_INICIAL") == 1) & F.col("PERIODO").between(lo, hi))
         .select(F.col("PERIODO").alias("PERIODO_TARGET"), *KEYS, "CANT_CLASES", "CANT_ALUMNOS"))
    return clean.drop_blackout(t, FAMILY, "target", params)
