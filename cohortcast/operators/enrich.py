"""Lookups against reference tables.

All of them are equi-joins against catalogue tables, broadcast when their size
is proven small (``Dims.small``), so the fact side is never shuffled for them.
Lookups that must match wrap the looked-up column in ``require`` (the task
fails on a miss, like the production asserts); ``*_misses`` functions return
the offending keys instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Params
from ..functions.scalars import course_index_of, level_of, program_group
from ..sources.dims import Dims
from .quality import require

SUCC = "POSTERIOR_(+1)"
SLOT_SUCC = "HORARIO_(+1)"


def _q(name: str) -> str:
    return f"`{name}`"


# ---- J1 / J2: recode raw codes to current codes ---------------------------

def recode_course(df: DataFrame, dims: Dims, strict: bool = True) -> DataFrame:
    """CODIGO_DE_CURSO -> CURSO_ACTUAL (left join; must match when strict)."""
    m = dims.small("course_map", dims["course_map"].select(
        F.col("CURSO_ANTERIOR").alias("CODIGO_DE_CURSO"), "CURSO_ACTUAL"))
    out = df.join(m, "CODIGO_DE_CURSO", "left")
    return out.withColumn("CURSO_ACTUAL", require("CURSO_ACTUAL", "course recode", "CODIGO_DE_CURSO")) if strict else out


def recode_slot(df: DataFrame, dims: Dims, strict: bool = True) -> DataFrame:
    """HORARIO -> HORARIO_ACTUAL (left join; must match when strict)."""
    m = dims.small("slots", dims["slots"].select("HORARIO", "HORARIO_ACTUAL"))
    out = df.join(m, "HORARIO", "left")
    return out.withColumn("HORARIO_ACTUAL", require("HORARIO_ACTUAL", "slot recode", "HORARIO")) if strict else out


# ---- J3: course flags -----------------------------------------------------

def add_flags(df: DataFrame, dims: Dims) -> DataFrame:
    """FLAG_ESTACIONAL (by course) and FLAG_INICIAL (CURSO_2 among the initial courses)."""
    if any(c in df.columns for c in ("FLAG_ESTACIONAL", "FLAG_INICIAL", "CURSO_2")):
        raise ValueError("frame already carries course flags")
    seasonal = dims.small("course_map", dims["course_map"].select(
        F.col("CURSO_ANTERIOR").alias("CURSO_ACTUAL"), "FLAG_ESTACIONAL"))
    # the initial-course table is a set (deduplicated when loaded), so the join cannot fan out
    initial = dims.small("initial_courses", dims["initial_courses"].select(
        F.col("CURSOS_INICIALES").alias("CURSO_2"), F.lit(1).alias("_INI")))
    c2 = dims.small("courses", dims["courses"].select("CURSO_ACTUAL", "CURSO_2"))
    out = (df.join(seasonal, "CURSO_ACTUAL", "left")
             .join(c2, "CURSO_ACTUAL", "left")
             .join(initial, "CURSO_2", "left"))
    # both checks ride on FLAG_INICIAL as well, so they survive even when a caller drops the flags
    flag_ok = require("FLAG_ESTACIONAL", "course flags", "CURSO_ACTUAL").isNotNull()
    return (out.withColumn("FLAG_INICIAL", F.when(flag_ok & require("CURSO_2", "course level index", "CURSO_ACTUAL")
                                                  .isNotNull() & F.col("_INI").isNotNull(), 1).otherwise(0))
               .withColumn("FLAG_ESTACIONAL", require("FLAG_ESTACIONAL", "course flags", "CURSO_ACTUAL"))
               .drop("CURSO_2", "_INI"))


def is_member(df: DataFrame, col: str, members: DataFrame, member_col: str, dims: Dims | None = None,
              name: str = "FLAG_MEMBER") -> DataFrame:
    """Membership of ``col`` in a set, as a 0/1 column (left join to the distinct set)."""
    s = members.select(F.col(member_col).alias(col), F.lit(1).alias("_M")).distinct()
    return (df.join(F.broadcast(s), col, "left")
              .withColumn(name, F.when(F.col("_M").isNotNull(), 1).otherwise(0)).drop("_M"))


# ---- J4 / J5: break-even and seats ----------------------------------------

def add_pe(df: DataFrame, dims: Dims, period_col: str = "PERIODO", params: Params = DEFAULT,
           out: str = "PE") -> DataFrame:
    """(month, programme group) -> PE, the month column chosen by the caller."""
    prog = dims.small("courses", dims["courses"].select("CURSO_ACTUAL", "PROGRAMA"))
    pe = dims.small("pe", dims["pe"].select(F.col("PERIODO").alias(period_col), "PROGRAMA",
                                            F.col("PE").alias(out)))
    x = (df.join(prog, "CURSO_ACTUAL", "left")
           .withColumn("PROGRAMA", program_group(require("PROGRAMA", "programme", "CURSO_ACTUAL"), params)))
    return x.join(pe, [period_col, "PROGRAMA"], "left").withColumn(out, require(out, "break-even", period_col)).drop("PROGRAMA")


def add_seats(df: DataFrame, dims: Dims, period_col: str = "PERIODO") -> DataFrame:
    """(month, level, business line) -> VAC_ACAD_ESTANDAR."""
    attrs = dims.small("courses", dims["courses"].select("CURSO_ACTUAL", "NIVEL", "LINEA_DE_NEGOCIO"))
    seats = dims.small("seats", dims["seats"].select(F.col("PERIODO").alias(period_col), "NIVEL",
                                                     "LINEA_DE_NEGOCIO", "VAC_ACAD_ESTANDAR"))
    x = df.join(attrs, "CURSO_ACTUAL", "left").withColumn("NIVEL", require("NIVEL", "level", "CURSO_ACTUAL"))
    return (x.join(seats, [period_col, "NIVEL", "LINEA_DE_NEGOCIO"], "left")
             .withColumn("VAC_ACAD_ESTANDAR", require("VAC_ACAD_ESTANDAR", "seats", period_col))
             .drop("NIVEL", "LINEA_DE_NEGOCIO"))


# ---- J6: opening hours ----------------------------------------------------

def within_opening_hours(df: DataFrame, dims: Dims, period_col: str = "PERIODO_TARGET") -> DataFrame:
    """Keep slots whose hours lie inside the site's hours of the month (closed interval).

    Two broadcast equi-joins plus a range predicate; no range join is needed.
    """
    slot = dims.small("slots", dims["slots"].select(
        F.col("HORARIO").alias("HORARIO_ACTUAL"), F.col("HORA_MIN").alias("_SLOT_START"),
        F.col("HORA_MAX").alias("_SLOT_END")))
    site = dims.small("site_hours", dims["site_hours"].select(
        F.col("PERIODO").alias(period_col), "SEDE", F.col("HORA_MIN").alias("_SITE_OPEN"),
        F.col("HORA_MAX").alias("_SITE_CLOSE")))
    x = df.join(slot, "HORARIO_ACTUAL", "left").join(site, [period_col, "SEDE"], "left")
    ok = ((require("_SITE_CLOSE", "site hours", "SEDE") >= require("_SLOT_END", "slot hours", "HORARIO_ACTUAL"))
          & (F.col("_SITE_OPEN") <= require("_SLOT_START", "slot hours", "HORARIO_ACTUAL")))
    return x.where(ok).drop("_SLOT_START", "_SLOT_END", "_SITE_OPEN", "_SITE_CLOSE")


# ---- J12: categorical attributes ------------------------------------------

def add_categoricals(df: DataFrame, dims: Dims, cols=("NIVEL", "CURSO_2", "FRECUENCIA", "DURACION"),
                     with_level_split: bool = True) -> DataFrame:
    """J12 (+ X3): course attributes as model categoricals, LEVEL / IDX_CURSO from CURSO_2."""
    attrs = dims.small("courses", dims["courses"].select("CURSO_ACTUAL", *cols))
    out = df.join(attrs, "CURSO_ACTUAL", "left").withColumn(cols[0], require(cols[0], "course attributes", "CURSO_ACTUAL"))
    if with_level_split:
        out = out.withColumn("LEVEL", level_of("CURSO_2")).withColumn("IDX_CURSO", course_index_of("CURSO_2"))
    return out


def course_attributes(dims: Dims, cols, rename: str | None = None) -> DataFrame:
    """Projection of the course catalogue, optionally keyed by another column name."""
    df = dims["courses"].select("CURSO_ACTUAL", *[_q(c) for c in cols])
    if rename:
        df = df.withColumnRenamed("CURSO_ACTUAL", rename)
    return dims.small("courses", df)
