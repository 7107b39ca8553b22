"""Month (yyyymm) algebra, as column expressions and as small period frames.

Months are ints ``yyyymm``.  Arithmetic goes through the month ordinal
``y*12 + m - 1`` so that shifts cross year boundaries; yyyymm ints are never
subtracted directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Params


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def period_ord(p) -> Column:
    """yyyymm -> month ordinal (int)."""
    p = _c(p)
    return (F.floor(p / 100) * 12 + p % 100 - 1).cast("int")


def ord_period(o) -> Column:
    """month ordinal -> yyyymm (int)."""
    o = _c(o)
    return (F.floor(o / 12) * 100 + o % 12 + 1).cast("int")


def shift_period(p, n) -> Column:
    """The month ``n`` months before ``p`` (negative ``n`` moves forward)."""
    n = F.lit(n) if isinstance(n, int) else _c(n)
    return ord_period(period_ord(p) - n)


def month_of(p) -> Column:
    return (_c(p) % 100).cast("int")


def year_of(p) -> Column:
    return F.floor(_c(p) / 100).cast("int")


def period_of_timestamp(ts) -> Column:
    ts = _c(ts)
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


# ---- scalar helpers (driver-side parameters only, never data) -------------

def to_ord(p: int) -> int:
    return (p // 100) * 12 + p % 100 - 1


def from_ord(o: int) -> int:
    return (o // 12) * 100 + o % 12 + 1


def shift(p: int, n: int) -> int:
    return from_ord(to_ord(p) - n)


def last_n(p: int, n: int) -> list[int]:
    """``n`` months ending at ``p``, newest first, ``p`` included."""
    return [shift(p, k) for k in range(n)]


def ahead_n(p: int, n: int) -> list[int]:
    """``n`` months starting at ``p``, ``p`` included."""
    return [shift(p, -k) for k in range(n)]


def months_between(start: int, end: int) -> list[int]:
    return [from_ord(o) for o in range(to_ord(start), to_ord(end) + 1)]


def all_periods(p: int, params: Params = DEFAULT) -> list[int]:
    """Every month from the history start to ``p``."""
    return months_between(params.history_start_period, p)


def training_periods(p: int, params: Params = DEFAULT) -> list[int]:
    """P5: training months, training start .. ``p``."""
    return months_between(params.training_start_period, p)


def seasonal_training_periods(p: int, months, params: Params = DEFAULT) -> list[int]:
    """Training months whose month number is in ``months``."""
    return [q for q in training_periods(p, params) if q % 100 in set(months)]


def select_periods(n: int | None, last: int, all_: bool, params: Params = DEFAULT) -> list[int]:
    """``n`` given -> last ``n``; otherwise ``all_`` must hold -> full history."""
    if n is not None:
        return last_n(last, n)
    if not all_:
        raise ValueError("either n or all_ must be given")
    return all_periods(last, params)


def horizon(model_period: int, n: int, explicit: int | None = None) -> list[int]:
    """An explicit month wins, otherwise ``n`` months from the model month."""
    if explicit is not None and explicit != -1:
        return [explicit]
    return ahead_n(model_period, n)


# ---- period frames (distributed; a few hundred rows at most) --------------

def period_frame(spark: SparkSession, start: int, end: int, name: str = "PERIODO") -> DataFrame:
    """All months start..end inclusive as a one-column frame."""
    return spark.range(to_ord(start), to_ord(end) + 1, numPartitions=1).select(
        ord_period("id").alias(name))


def period_list_frame(spark: SparkSession, periods, name: str = "PERIODO") -> DataFrame:
    from ..sources.local import local_frame
    return local_frame(spark, [(int(p),) for p in periods], f"{name} int")


# Which model families run in a given month (P8).  Fixed values.
SCHEDULE = {
    1: {"inicial_estacional": True, "continuidad_estacional": False},
    2: {"inicial_estacional": True, "continuidad_estacional": True},
}
REGULAR_FAMILIES = ("inicial_regular", "continuidad_regular", "continuidad_regular_horario")
SEASONAL_FAMILIES = ("inicial_estacional", "continuidad_estacional")


def schedule_rows() -> list[tuple[int, str, bool]]:
    rows = []
    for m in range(1, 13):
        special = SCHEDULE.get(m, {})
        for fam in SEASONAL_FAMILIES:
            rows.append((m, fam, bool(special.get(fam, False))))
        for fam in REGULAR_FAMILIES:
            rows.append((m, fam, True))
    return rows


def schedule_frame(spark: SparkSession) -> DataFrame:
    """P8 as a dim: (MONTH, TIPO, RUNS)."""
    from ..sources.local import local_frame
    return local_frame(spark, schedule_rows(), "MONTH int, TIPO string, RUNS boolean")


def schedule_for(period: int) -> dict[str, bool]:
    m = period % 100
    return {fam: runs for (mm, fam, runs) in schedule_rows() if mm == m}
