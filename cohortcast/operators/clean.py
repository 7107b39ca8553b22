"""Row filters and canonicalisation.

Every filter is a plain ``where`` over built-in expressions, so Catalyst pushes
the column predicates into the Parquet scan.  SQL three-valued logic matches
the pandas masks of the production rules: a null predicate drops the row,
except where pandas ``isin`` treats null as "not in", which is spelled out with
``coalesce(..., false)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Params
from ..functions.periods import month_of


def _isin(col: str | Column, values) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.isin(list(values)), F.lit(False))


# fixed values of F1: course-code endings that never were regular sales, and the one dropped only before the cut-over
DROPPED_ENDINGS = ("HD", "PV")
EARLY_DROPPED_ENDING = "P"


def _ends_in(code: Column, endings) -> Column:
    """The code, in any case, ends in one of ``endings`` (all of one length) and has something before it."""
    size = len(endings[0])
    return (F.length(code) > size) & F.upper(F.right(code, F.lit(size))).isin(list(endings))


def regular_sale_predicate(params: Params = DEFAULT) -> Column:
    """F1 as a keep-predicate: no excluded state, site or level, and no dropped ending (null means drop)."""
    keep = F.lit(True)
    for column, label in (("ESTADO", params.cancelled_state), ("SEDE", params.excluded_site),
                          ("NIVEL", params.excluded_level)):
        keep = keep & (F.col(column) != label)
    code = F.col("CODIGO_DE_CURSO")
    early = _ends_in(code, (EARLY_DROPPED_ENDING,)) & (F.col("PERIODO") < params.suffix_cutover_period)
    return keep & ~_ends_in(code, DROPPED_ENDINGS) & ~early


def regular_sale(df: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """keep regular sales."""
    return df.where(regular_sale_predicate(params))


def drop_satellites(df: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """drop the satellite sites; a null site is kept."""
    return df.where(~_isin("SEDE", params.satellite_sites))


def canonical_site(col: str = "SEDE", params: Params = DEFAULT) -> Column:
    """Strip the province prefix, merge the listed sites into one."""
    stripped = F.replace(F.col(col), F.lit(params.site_prefix_to_strip), F.lit(""))
    return F.when(_isin(stripped, params.site_merge_sources), F.lit(params.site_merge_target)).otherwise(stripped)


def canonicalise_sites(df: DataFrame, params: Params = DEFAULT) -> DataFrame:
    return df.withColumn("SEDE", canonical_site("SEDE", params))


def available(df: DataFrame, flag: str = "FLAG_DISPONIBLE") -> DataFrame:
    """flag != 0, a null flag counts as available."""
    return df.where(~F.col(flag).eqNullSafe(0))


def blackout_frame(spark: SparkSession, params: Params = DEFAULT) -> DataFrame:
    from ..sources.local import local_frame
    return local_frame(spark, params.blackout, "TIPO string, USE string, SEDE string, PERIODO_TARGET int")


def drop_blackout(df: DataFrame, family: str, use: str, params: Params = DEFAULT,
                  period_col: str = "PERIODO_TARGET") -> DataFrame:
    """left-anti join on the (site, month) blackout list of one family and use.

    The list is a parameter (a few dozen rows), so it is broadcast.
    """
    bl = (blackout_frame(df.sparkSession, params)
          .where((F.col("TIPO") == family) & (F.col("USE") == use))
          .select("SEDE", F.col("PERIODO_TARGET").alias(period_col)))
    return df.join(F.broadcast(bl), on=["SEDE", period_col], how="left_anti")


def not_terminal(succ_col: str = "POSTERIOR_(+1)", params: Params = DEFAULT) -> Column:
    """F7 keep-predicate: a successor exists and is not the terminal label."""
    s = F.col(f"`{succ_col}`")
    return s.isNotNull() & (s != params.terminal_course)


def march_excluded(level_col: str, freq_col: str, slot_col: str, params: Params = DEFAULT) -> Column:
    """F8: level in the listed levels, interdaily, and one of the day slots."""
    return (_isin(level_col, params.march_levels) & _isin(freq_col, [params.march_frequency])
            & _isin(slot_col, params.march_day_slots))


def time_split(df: DataFrame, period: int, col: str = "PERIODO_TARGET") -> tuple[DataFrame, DataFrame]:
    """train = months before ``period``, test = ``period``."""
    return df.where(F.col(col) < period), df.where(F.col(col) == period)


def seasonal_regime(df: DataFrame, period: int, params: Params = DEFAULT, col: str = "PERIODO_TARGET") -> DataFrame:
    """seasonal target month -> same month number only; otherwise drop the seasonal months."""
    m = period % 100
    if m in params.seasonal_months:
        return df.where(month_of(col) == m)
    return df.where(~month_of(col).isin(list(params.seasonal_months)))


def seasonal_regime_predicate(target_col: str, model_col: str, params: Params = DEFAULT) -> Column:
    """F13 for many model months at once (model month held in a column)."""
    mm = month_of(model_col)
    tm = month_of(target_col)
    seasonal = mm.isin(list(params.seasonal_months))
    return F.when(seasonal, tm == mm).otherwise(~tm.isin(list(params.seasonal_months)))


def drop_zero_zero(df: DataFrame, predicted: str = "CANT_CLASES_PREDICT", actual: str = "CANT_CLASES") -> DataFrame:
    """drop rows where both prediction and actual are zero."""
    return df.where(~((F.col(predicted) == 0) & (F.col(actual) == 0)))


PUBLISH_COLUMNS = ["PERIODO_TARGET", "SEDE", "CURSO_ACTUAL", "HORARIO_ACTUAL",
                   "CANT_CLASES_PREDICT", "CANT_ALUMNOS_PREDICT"]


def publish(df: DataFrame) -> DataFrame:
    """rows with at least one predicted class, six published columns."""
    return df.where(F.col("CANT_CLASES_PREDICT") > 0).select(*PUBLISH_COLUMNS)
