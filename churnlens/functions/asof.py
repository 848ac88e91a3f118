"""Point-in-time predicates and labels, parameterised by the as-of date ``T``: one date for
all rows, or a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def as_date(value) -> Column:
    """A date, or the column that holds each row's own as-of date."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def active_at_weekly(start: Column, end: Column, T) -> Column:
    """Inclusive on both ends: start <= T and (end >= T or end is NULL)."""
    T = as_date(T)
    return (start <= T) & (end.isNull() | (end >= T))


def active_at_profile(start: Column, end: Column, T) -> Column:
    """Exclusive on both ends: start < T and (end > T or end is NULL)."""
    T = as_date(T)
    return (start < T) & (end.isNull() | (end > T))


def exclude_values(c: Column, values: list[str], case_insensitive: bool = False) -> Column:
    """``c NOT IN values`` with SQL three-valued logic: a NULL ``c`` is dropped."""
    if case_insensitive:
        return ~F.lower(c).isin([v.lower() for v in values])
    return ~c.isin(values)


def include_values(c: Column, values: list[str], case_insensitive: bool = False) -> Column:
    if case_insensitive:
        return F.lower(c).isin([v.lower() for v in values])
    return c.isin(values)


def exclude_subcategories(c: Column, case_insensitive: bool = False) -> Column:
    return exclude_values(c, C.EXCLUDED_SUBCATEGORIES, case_insensitive)


def contract_only(c: Column, case_insensitive: bool = False) -> Column:
    return include_values(c, C.CONTRACT_CATEGORIES, case_insensitive)


def exclude_origin_transfer(c: Column, case_insensitive: bool = False) -> Column:
    return exclude_values(c, C.EXCLUDED_ORIGINS, case_insensitive)


def trailing_year(week: Column, T) -> Column:
    """T - 1 year <= week < T (month-end clamping as the SQL DATEADD)."""
    T = as_date(T)
    return (week >= F.add_months(T, -12)) & (week < T)


def before_as_of(week: Column, T) -> Column:
    return week < as_date(T)


def end_month_bucket(end: Column, T, months: int = 12) -> Column:
    """1..months: the first m with end <= T + m months; NULL if open, past or later."""
    T = as_date(T)
    expr = F.when(end.isNull() | (end <= T), F.lit(None).cast("int"))
    for m in range(1, months + 1):
        expr = expr.when(end <= F.add_months(T, m), F.lit(m))
    return expr.otherwise(F.lit(None).cast("int"))


def churn_flag_52w(end: Column, T, weeks: int = C.CHURN_WINDOW_WEEKS) -> Column:
    """1 when T < end < T + 52 weeks."""
    T = as_date(T)
    return F.when(end.isNotNull() & (end > T) & (end < F.date_add(T, 7 * weeks)), 1).otherwise(0)


def churn_class_3(end: Column, T) -> Column:
    """1: end in [T, T+3m]; 2: (T+3m, T+6m]; 3: otherwise, including open memberships."""
    T = as_date(T)
    end = end.cast("date")
    return (F.when(end.between(T, F.add_months(T, 3)), 1)
            .when((end > F.add_months(T, 3)) & (end <= F.add_months(T, 6)), 2)
            .otherwise(3))


def actual_churn_label(end: Column, run_date: Column) -> Column:
    """Validation label comparing EndDate with RunDate (documented consumer query)."""
    return (F.when((end > run_date) & (end <= F.add_months(run_date, 3)), "Actual_Churn_0-3mo")
            .when((end > F.add_months(run_date, 3)) & (end <= F.add_months(run_date, 6)), "Actual_Churn_3-6mo")
            .otherwise("No_Churn_Or_Later"))
