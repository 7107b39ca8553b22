"""Scalar column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT, Params

# "HH:MM - HH:MM"
SLOT_PATTERN = r"(\d{2}):(\d{2}) - (\d{2}):(\d{2})"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def slot_start_hours(c) -> Column:
    """Decimal start hour of "HH:MM - HH:MM"; a bad format raises (ANSI cast of '')."""
    c = _c(c)
    return F.regexp_extract(c, SLOT_PATTERN, 1).cast("int") + F.regexp_extract(c, SLOT_PATTERN, 2).cast("int") / 60.0


def slot_end_hours(c) -> Column:
    c = _c(c)
    return F.regexp_extract(c, SLOT_PATTERN, 3).cast("int") + F.regexp_extract(c, SLOT_PATTERN, 4).cast("int") / 60.0


def month_key(year, month) -> Column:
    """YEAR || zero-padded MONTH as int."""
    return F.concat(_c(year).cast("string"), F.lpad(_c(month).cast("string"), 2, "0")).cast("int")


def level_of(curso_2) -> Column:
    """X3: 'L_' + text before the last space (whole text when there is no space)."""
    return F.concat(F.lit("L_"), F.regexp_replace(_c(curso_2), r"(.+) (.+)", "$1"))


def course_index_of(curso_2) -> Column:
    """X3: 'IC_' + text after the last space (whole text when there is no space)."""
    return F.concat(F.lit("IC_"), F.regexp_replace(_c(curso_2), r"(.+) (.+)", "$2"))


def program_group(programa, params: Params = DEFAULT) -> Column:
    """Collapse the programme to kids / adults (anything else, null included, is adults)."""
    return F.when(_c(programa) == params.kids_program, F.lit(params.kids_program)).otherwise(
        F.lit(params.adults_program))


def growth(a, b, params: Params = DEFAULT) -> Column:
    """A / b - 1 with a guarded zero base.

    ``zero_base='null'``: b == 0 gives null (0/0 is NaN in pandas, filled later).
    ``zero_base='inf'``: b == 0 and a != 0 gives +/-inf, 0/0 gives null.
    """
    a, b = _c(a).cast("double"), _c(b).cast("double")
    ratio = F.when(b != 0, a / F.when(b != 0, b) - 1)
    if params.zero_base == "inf":
        ratio = ratio.when((b == 0) & (a > 0), F.lit(float("inf"))).when((b == 0) & (a < 0), F.lit(float("-inf")))
    return ratio


def clean_prediction(p, params: Params = DEFAULT) -> Column:
    """Clamp at 0, then floor + 1 when the fraction is >= the round-up fraction."""
    p = F.greatest(_c(p).cast("double"), F.lit(0.0))
    return F.floor(p).cast("double") + F.when(p % 1 >= params.round_up_fraction, 1.0).otherwise(0.0)


def clamp_zero(p) -> Column:
    return F.greatest(_c(p).cast("double"), F.lit(0.0))


def students_to_classes(students, seats, pe) -> Column:
    """S div seats + (s mod seats >= PE), 0 when s <= 0; null when seats is 0."""
    s, v, pe = _c(students).cast("double"), _c(seats).cast("double"), _c(pe).cast("double")
    safe_v = F.when(v != 0, v)
    full = F.floor(s / safe_v).cast("double")
    rest = s - full * safe_v
    return F.when(s > 0, full + F.when(rest >= pe, 1.0).otherwise(0.0)).otherwise(
        F.when(safe_v.isNotNull(), F.lit(0.0)))


def shortage(actual, predicted) -> Column:
    """max(actual - predicted, 0)."""
    return F.greatest(_c(actual).cast("double") - _c(predicted).cast("double"), F.lit(0.0))


def excess(actual, predicted) -> Column:
    return F.greatest(_c(predicted).cast("double") - _c(actual).cast("double"), F.lit(0.0))


def exact_match(actual, predicted) -> Column:
    return (_c(actual).cast("double") == _c(predicted).cast("double")).cast("int")


def denormalise_growth(previous, predicted_growth) -> Column:
    """X11: previous * (1 + predicted growth)."""
    return _c(previous).cast("double") * (1 + _c(predicted_growth).cast("double"))
