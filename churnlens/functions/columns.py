"""Scalar column helpers with pandas-compatible NULL semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from .asof import as_date


def normalize_key(c: Column) -> Column:
    """lower(trim(id)); NULL stays NULL."""
    return F.lower(F.trim(c.cast("string")))


def clip(c: Column, lo: float, hi: float) -> Column:
    """Clamp to [lo, hi]; NULL stays NULL (bare greatest/least would skip the NULL)."""
    return F.when(c.isNotNull(), F.greatest(F.lit(float(lo)), F.least(c, F.lit(float(hi)))))


def pdiv(a: Column, b: Column) -> Column:
    """Float division with numpy semantics under ANSI mode: x/0 -> +-inf, 0/0 -> NULL."""
    a = a.cast("double")
    b = b.cast("double")
    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
            .when(b != 0, a / b)
            .when(a > 0, F.lit(float("inf")))
            .when(a < 0, F.lit(float("-inf")))
            .otherwise(F.lit(None).cast("double")))


def coerce_numeric(c: Column) -> Column:
    """to_numeric(errors='coerce'): unparsable -> NULL."""
    return c.cast("string").try_cast("double")


def coerce_date(c: Column) -> Column:
    return c.cast("string").try_cast("date")


def coalesce_visits(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def payment_band(amount: Column) -> Column:
    expr = None
    for ub, label in C.PAYMENT_BANDS:
        cond = amount <= F.lit(ub)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(C.PAYMENT_BAND_ELSE)


def _prefix_group(c: Column, groups, case_insensitive: bool) -> Column:
    s = F.lower(c) if case_insensitive else c
    expr = None
    for prefix, label in groups:
        p = prefix.lower() if case_insensitive else prefix
        cond = s.startswith(p)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(C.UNDEFINED)


def frequency_group(c: Column, case_insensitive: bool = True) -> Column:
    """LIKE 'Fort%' / 'Mon%' / 'Wee%'. The warehouse collation is case-insensitive."""
    return _prefix_group(c, C.FREQUENCY_GROUPS, case_insensitive)


def term_group(c: Column, case_insensitive: bool = True) -> Column:
    return _prefix_group(c, C.TERM_GROUPS, case_insensitive)


def literal_map(c: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def payment_band_to_number(c: Column) -> Column:
    return literal_map(c, C.PAYMENT_BAND_TO_NUMBER)


def frequency_to_number(c: Column) -> Column:
    return literal_map(c, C.FREQUENCY_TO_NUMBER)


def days_since_last_accessed(last: Column, T) -> Column:
    T = as_date(T)
    return (F.when(last.isNull() | (last > T), F.lit(C.NO_ACCESS_SENTINEL))
            .otherwise(F.datediff(T, last)))


def age_years(dob: Column, T) -> Column:
    """Calendar-year difference to the as-of date (reproducible for past cohorts)."""
    return F.year(as_date(T)) - F.year(dob)


def season_sin_cos(week: Column) -> tuple[Column, Column]:
    woy = F.weekofyear(week).cast("double")
    ang = F.lit(2.0 * 3.141592653589793) * woy / F.lit(52.0)
    return F.sin(ang), F.cos(ang)


def normalize_band(c: Column) -> Column:
    """strip + capitalise (first char upper, rest lower) + two typo repairs."""
    s = F.trim(c.cast("string"))
    cap = F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 1 << 30)))
    expr = F.when(cap.isNull(), cap)
    for bad, good in C.BAND_TYPO_FIXES.items():
        expr = expr.when(cap == bad, good)
    return expr.otherwise(cap)
