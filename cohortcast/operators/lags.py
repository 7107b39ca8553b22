"""Lag lookups (J7) and target attach.

A lag is the value of the same key ``n`` months earlier, 0 when that month has
no row (months may be missing, so this is never ``F.lag`` over rows).

``lag_join`` is the direct form: one left join per lag on (month - n, keys).
``lag_fanout`` is the form the plans use: every cell is sent to each target
month it feeds (month + n for n in the lag set) and one ``groupBy`` collects
all lags of a target at once -- one shuffle for any number of lags, with
map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.periods import ord_period, period_ord, shift_period


def lag_name(n: int) -> str:
    return f"{n:02d}"


def lag_join(idx: DataFrame, cells: DataFrame, n: int, keys, values=("CANT_CLASES", "CANT_ALUMNOS"),
             prefix_from: str = "CANT", prefix_to: str = "CANT") -> DataFrame:
    """J7 direct: left join ``cells`` at PERIODO_LAG_nn = PERIODO; missing -> 0."""
    if not 1 <= n <= 12:
        raise ValueError("lag must be within 1..12")
    nn = lag_name(n)
    lag_col = f"PERIODO_LAG_{nn}"
    if lag_col not in idx.columns:
        idx = idx.withColumn(lag_col, shift_period("PERIODO_TARGET", n))
    renamed = cells.select(F.col("PERIODO").alias(lag_col), *keys,
                           *[F.col(v).alias(v.replace(prefix_from, prefix_to, 1) + f"_LAG_{nn}") for v in values])
    out = idx.join(renamed, [lag_col, *keys], "left")
    for v in values:
        c = v.replace(prefix_from, prefix_to, 1) + f"_LAG_{nn}"
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(0.0)))
    return out


def lag_fanout(cells: DataFrame, keys, lags, values=("CANT_CLASES", "CANT_ALUMNOS"),
               target_range: tuple[int, int] | None = None) -> DataFrame:
    """Every cell copied to the target months it feeds, tagged with its lag.

    Output: PERIODO_TARGET, keys, LAG, values.  ``lags`` may include 0 (the
    target month itself, used for the actuals).
    """
    fan = cells.select(*keys, period_ord("PERIODO").alias("_ORD"), *values).withColumn(
        "LAG", F.explode(F.array(*[F.lit(int(n)) for n in lags])))
    fan = fan.withColumn("PERIODO_TARGET", ord_period(F.col("_ORD") + F.col("LAG"))).drop("_ORD")
    if target_range is not None:
        lo, hi = target_range
        fan = fan.where(F.col("PERIODO_TARGET").between(lo, hi))
    return fan


def lag_value(n: int, value: str) -> Column:
    """Conditional aggregate picking the lag-``n`` value of a fanned-out group."""
    return F.sum(F.when(F.col("LAG") == n, F.col(value)))


def attach_target(idx: DataFrame, target: DataFrame, keys, values=("CANT_CLASES", "CANT_ALUMNOS"),
                  cast: str = "int") -> DataFrame:
    """Left join actuals on the grain, missing -> 0."""
    out = idx.join(target.select(*keys, *values), list(keys), "left")
    for v in values:
        out = out.withColumn(v, F.coalesce(F.col(v), F.lit(0)).cast(cast))
    return out
