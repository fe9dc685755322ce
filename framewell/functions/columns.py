"""Column helpers: missing-value policy, ADC predicates, small arithmetic.

Missing values are NaN in results (as in array programs) and NULL inside
aggregates (Spark skips NULL but ranks NaN above every number), so the helpers
below convert between both and compare without ever treating NaN as large.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")
INF = float("inf")


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(c: Column | str, divisor: int) -> Column:
    """Whole-number division of a non-negative column, as INT."""
    return F.call_function("div", as_col(c), F.lit(divisor)).cast("int")


def f32(c: Column | str) -> Column:
    return as_col(c).cast("float")


# -- finiteness ------------------------------------------------------------------
def is_finite(c: Column | str) -> Column:
    """True for ordinary numbers; False for NULL, NaN and infinities."""
    return F.coalesce(F.abs(as_col(c)) < F.lit(INF), F.lit(False))


def finite_or_null(c: Column | str) -> Column:
    return F.when(is_finite(c), as_col(c))


def nan_if_null(c: Column | str, dtype: str = "double") -> Column:
    return F.coalesce(as_col(c).cast(dtype), F.lit(NAN).cast(dtype))


def keep_where(condition: Column, c: Column | str, dtype: str = "float") -> Column:
    """The value where ``condition`` holds, NaN elsewhere (maps for output)."""
    return F.when(condition, as_col(c).cast(dtype)).otherwise(F.lit(NAN).cast(dtype))


# -- comparisons with NaN never true ----------------------------------------------
def exceeds(c: Column | str, limit: Column) -> Column:
    c = as_col(c)
    return F.coalesce(~F.isnan(c) & (c > limit), F.lit(False))


def falls_below(c: Column | str, limit: Column) -> Column:
    c = as_col(c)
    return F.coalesce(~F.isnan(limit) & (c < limit), F.lit(False))


# -- ADC sentinels -----------------------------------------------------------------
def is_underflow(adc: Column | str, geometry) -> Column:
    return as_col(adc) == F.lit(geometry.underflow)


def is_overflow(adc: Column | str, geometry) -> Column:
    return as_col(adc) == F.lit(geometry.overflow)


def is_valid_adc(adc: Column | str, geometry) -> Column:
    """Neither underflow nor overflow.  NaN counts as valid."""
    return (as_col(adc) != F.lit(geometry.underflow)) & (as_col(adc) != F.lit(geometry.overflow))


def any_flag(*flags: Column | str | None) -> Column | None:
    """OR of the given flags (NULL as False); None when all are absent."""
    present = [F.coalesce(as_col(f), F.lit(False)) for f in flags if f is not None]
    if not present:
        return None
    out = present[0]
    for flag in present[1:]:
        out = out | flag
    return out
