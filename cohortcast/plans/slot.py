"""Slot family (C6 candidates, C7 features, C8 targets), all months in one plan.

Like the continuing family, but the successor course is expanded to every
slot historically seen at the site for the same frequency / intensity /
programme (J10).  The slot catalogue is one ``groupBy`` keeping the first
month a slot was seen, so "seen before the target month" is a range predicate
on top of an equi-join -- bounded fan-out, no nested loop.  Shares of a
course's total (A8) are window sums over the parent key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Params
from ..functions.periods import month_of
from ..functions.scalars import program_group
from ..operators import clean, enrich
from ..operators.enrich import SLOT_SUCC, SUCC
from ..operators.quality import require
from ..sources.dims import Dims
from . import continuing

FAMILY = "continuidad_regular_horario"
CANDIDATE_COLUMNS = ["PERIODO_TARGET", "PERIODO", "PERIODO_LAG_12", "SEDE", "CURSO_ANTERIOR", "CURSO_ACTUAL",
                     "HORARIO_ANTERIOR", "HORARIO_ACTUAL", "IDX", "VAC_ACAD_ESTANDAR", "PE", "PE_ANTERIOR"]
SLOT_KEYS = ["PERIODO_TARGET", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL"]
G9 = ["PERIODO_TARGET", "PERIODO_LAG_12", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL", "IDX", "PE",
      "VAC_ACAD_ESTANDAR", "PE_ANTERIOR"]
G8 = [k for k in G9 if k != "HORARIO_ACTUAL"]
SIX = ["PERIODO_TARGET", "PERIODO", "SEDE", "CURSO_ACTUAL", SUCC, "HORARIO_ACTUAL", SLOT_SUCC]


def _q(c: str):
    return F.col(f"`{c}`")


def slot_catalogue(full: DataFrame, dims: Dims, params: Params = DEFAULT) -> DataFrame:
    """F18 / J10 input: first month each (site, slot, frequency, intensity, programme) was seen."""
    attrs = enrich.course_attributes(dims, ["FRECUENCIA", "INTENSIDAD", "PROGRAMA"])
    return (full.join(attrs, "CURSO_ACTUAL", "left")
                .withColumn("PROGRAMA", program_group(require("PROGRAMA", "programme", "CURSO_ACTUAL"), params))
                .groupBy("SEDE", "HORARIO_ACTUAL", "FRECUENCIA", "INTENSIDAD", "PROGRAMA")
                .agg(F.min("PERIODO").alias("FIRST_SEEN")))


def candidates(full: DataFrame, dims: Dims, target_range: tuple[int, int], params: Params = DEFAULT) -> DataFrame:
    """(target, base month, site, predecessor course/slot, successor course/slot) rows."""
    b = continuing.base_rows(full, dims, target_range, params)
    march = month_of("PERIODO_TARGET") == params.substitution_month

    reg = (b.where((F.col("FLAG_ESTACIONAL") == 0) & clean.not_terminal(SUCC, params))
            .select("PERIODO_TARGET", "PERIODO", "SEDE", "CURSO_ACTUAL", _q(SUCC)).distinct())
    succ_attrs = enrich.course_attributes(dims, ["FRECUENCIA", "INTENSIDAD", "PROGRAMA", "NIVEL"], rename=SUCC)
    reg = (reg.join(succ_attrs, SUCC, "left")
              .withColumn("PROGRAMA", program_group(require("PROGRAMA", "successor programme", f"`{SUCC}`"), params)))
    cat = slot_catalogue(full, dims, params).select(
        F.col("SEDE").alias("_S"), F.col("FRECUENCIA").alias("_F"), F.col("INTENSIDAD").alias("_I"),
        F.col("PROGRAMA").alias("_P"), "HORARIO_ACTUAL", "FIRST_SEEN")
    cond = ((reg["SEDE"] == cat["_S"]) & (reg["FRECUENCIA"] == cat["_F"]) & (reg["INTENSIDAD"] == cat["_I"])
            & (reg["PROGRAMA"] == cat["_P"]) & (cat["FIRST_SEEN"] < reg["PERIODO_TARGET"]))
    reg = (reg.join(cat, cond, "left")
              .withColumn("HORARIO_ACTUAL", require("HORARIO_ACTUAL", "historical slot", "SEDE"))
              .withColumn(SLOT_SUCC, F.col("HORARIO_ACTUAL"))
              .where(~(march & clean.march_excluded("NIVEL", "FRECUENCIA", "HORARIO_ACTUAL", params)))
              .select(*[_q(c) for c in SIX]).distinct())

    cmap = dims.small("seasonal_course_map", dims["seasonal_course_map"].select("CURSO_ACTUAL", _q(SUCC)))
    hmap = dims.small("seasonal_slot_map", dims["seasonal_slot_map"].select(
        F.col("HORARIO").alias("HORARIO_ACTUAL"), _q(SLOT_SUCC)))
    sea = (b.where((F.col("FLAG_ESTACIONAL") == 1) & march)
            .select("PERIODO_TARGET", "PERIODO", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL")
            .join(cmap, "CURSO_ACTUAL", "left")
            .withColumn(SUCC, require(f"`{SUCC}`", "seasonal successor", "CURSO_ACTUAL"))
            .join(hmap, "HORARIO_ACTUAL", "left")
            .select(*[_q(c) for c in SIX]).distinct())

    c = reg.unionByName(sea)
    c = c.withColumnRenamed("HORARIO_ACTUAL", "HORARIO_ANTERIOR").withColumnRenamed(SLOT_SUCC, "HORARIO_ACTUAL")
    c = continuing.finish_candidates(c, dims, params)
    c = enrich.within_opening_hours(c, dims, "PERIODO_TARGET")
    return c.select(*CANDIDATE_COLUMNS)


def _share(value: str, parent_keys) -> F.Column:
    return F.try_divide(F.col(value).cast("double"), F.sum(value).over(Window.partitionBy(*parent_keys)).cast("double"))


def targets(full: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Slot-level actuals of non-initial regular courses with their share of the course."""
    real = full.where((F.col("FLAG_ESTACIONAL") == 0) & (F.col("FLAG_INICIAL") == 0))
    parent = ["PERIODO", "SEDE", "CURSO_ACTUAL"]
    t = (real.select("PERIODO", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL", "CANT_CLASES", "CANT_ALUMNOS")
             .withColumn("FAC_CLASES", _share("CANT_CLASES", parent))
              .withColumn("FAC_ALUMNOS", _share("CANT_ALUMNOS", parent))
              .withColumnRenamed("PERIODO", "PERIODO_TARGET"))
    return clean.drop_blackout(t, FAMILY, "target", params)


def anterior_shares(cand: DataFrame, full: DataFrame, dedupe: bool = False) -> DataFrame:
    """J8 + A7 + A8 + J16: predecessor slot totals and their share of the successor course.

    The production rule re-joins totals and shares on the four slot keys; when
    one slot carries two PE_ANTERIOR values this is many-to-many and is kept
    (``dedupe=True`` sums them into one row instead).
    """
    cells = full.select("PERIODO", "SEDE", F.col("CURSO_ACTUAL").alias("CURSO_ANTERIOR"),
                        F.col("HORARIO_ACTUAL").alias("HORARIO_ANTERIOR"), "CANT_CLASES", "CANT_ALUMNOS")
    x = cand.join(cells, ["PERIODO", "SEDE", "CURSO_ANTERIOR", "HORARIO_ANTERIOR"], "left")
    keys = G9
    if dedupe:
        keys = [k for k in G9 if k != "PE_ANTERIOR"]
    g2 = x.groupBy(*keys).agg(
        F.sum(F.coalesce("CANT_CLASES", F.lit(0))).cast("double").alias("CANT_CLASES_ANTERIOR"),
        F.sum(F.coalesce("CANT_ALUMNOS", F.lit(0))).cast("double").alias("CANT_ALUMNOS_ANTERIOR"))
    parent = [k for k in keys if k != "HORARIO_ACTUAL"]
    shares = (g2.withColumn("FAC_CLASES_ANTERIOR", _share("CANT_CLASES_ANTERIOR", parent))
                .withColumn("FAC_ALUMNOS_ANTERIOR", _share("CANT_ALUMNOS_ANTERIOR", parent)))
    if dedupe:
        return shares
    left = g2.select(*SLOT_KEYS, "CANT_CLASES_ANTERIOR", "CANT_ALUMNOS_ANTERIOR")
    right = shares.drop("CANT_CLASES_ANTERIOR", "CANT_ALUMNOS_ANTERIOR")
    return left.join(right, SLOT_KEYS, "left")


def features(full: DataFrame, dims: Dims, target_range: tuple[int, int], params: Params = DEFAULT,
             blackout: bool = True, dedupe: bool = False, materialize=None) -> DataFrame:
    """Slot candidates + predecessor shares + lag-12 shares + actuals and shares + categoricals.

    The candidate table feeds both sides of the totals/shares re-join; ``materialize``
    (e.g. ``session.cut_lineage``) writes it once instead of planning it twice.
    """
    cand = candidates(full, dims, target_range, params)
    if materialize is not None:
        cand = materialize(cand)
    f = anterior_shares(cand, full, dedupe)
    parent = ["PERIODO", "SEDE", "CURSO_ACTUAL"]
    lag12 = full.select(F.col("PERIODO").alias("PERIODO_LAG_12"), "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL",
                         _share("CANT_CLASES", parent).alias("FAC_CLASES_LAG_12"),
                         _share("CANT_ALUMNOS", parent).alias("FAC_ALUMNOS_LAG_12"))
    f = f.join(lag12, ["PERIODO_LAG_12", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL"], "left")
    f = f.withColumn("FAC_CLASES_LAG_12", F.coalesce("FAC_CLASES_LAG_12", F.lit(0.0))).withColumn(
        "FAC_ALUMNOS_LAG_12", F.coalesce("FAC_ALUMNOS_LAG_12", F.lit(0.0)))
    t = targets(full, params)
    f = f.join(t, SLOT_KEYS, "left")
    f = (f.withColumn("CANT_CLASES", F.coalesce("CANT_CLASES", F.lit(0)).cast("int"))
          .withColumn("CANT_ALUMNOS", F.coalesce("CANT_ALUMNOS", F.lit(0)).cast("int"))
          .withColumn("FAC_CLASES", F.coalesce("FAC_CLASES", F.lit(0.0)).cast("float"))
          .withColumn("FAC_ALUMNOS", F.coalesce("FAC_ALUMNOS", F.lit(0.0)).cast("float")))
    f = enrich.add_categoricals(f, dims, ("NIVEL", "CURSO_2"))
    if blackout:
        f = clean.drop_blackout(f, FAMILY, "features", params)
    return f
