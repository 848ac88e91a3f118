"""The twelve business features published with every prediction (pandas semantics:
fillna defaults, clip keeps NULL, x/0 -> inf before clipping)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import clip, coerce_numeric, pdiv

ENGINEERED = ["Engagement_Rate", "Recent_Activity_Ratio", "Declining_Engagement", "Monthly_Avg_Visits",
              "Payment_to_Attendance_Ratio", "Recent_Payment_to_Visits", "Tenure_Quartile", "Early_Churn_Risk",
              "Inactivity_Ratio", "Attendance_Dropoff", "Access_Gap_Months", "High_Inactivity"]


def _n(df: DataFrame, name: str) -> Column:
    return coerce_numeric(F.col(f"`{name}`")) if name in df.columns else F.lit(None).cast("double")


def quartile_edges(df: DataFrame, col: str = "TenureDays") -> list[float]:
    """Exact linear quantiles q0, q25, q50, q75, q100 of coalesce(col, 0), from
    distributed prefix counts (``ranking.exact_quantiles``)."""
    from ..operators.ranking import exact_quantiles
    t = df.select(F.coalesce(coerce_numeric(F.col(col)), F.lit(0.0)).alias("_t"))
    q = exact_quantiles(t, "_t", [0.0, 0.25, 0.5, 0.75, 1.0])
    return [] if q[0] is None else q


def quartile_label(t: Column, edges: list[float]) -> Column:
    """qcut(q=4, labels 1..4, duplicates='drop') with collapsed bins instead of an error:
    1 + number of distinct interior edges strictly below t."""
    if not edges:
        return F.lit(None).cast("long")
    lo, hi = edges[0], edges[-1]
    interior = sorted({e for e in edges[1:-1] if lo < e < hi})
    lab = F.lit(1)
    for e in interior:
        lab = lab + F.when(t > F.lit(e), 1).otherwise(0)
    return lab.cast("long")


def engineer_features(df: DataFrame, payment_col: str = "RegularPayment", tenure_edges: list[float] | None = None
                      ) -> DataFrame:
    """Adds the 12 features. ``payment_col`` defaults to the reference's band column
    (which coerces to NULL -> 0); pass a numeric column to use real amounts."""
    tenure, total = _n(df, "TenureDays"), _n(df, "TotalAttendanceToDate")
    v30, v90 = _n(df, "Visits_Last30d"), _n(df, "Visits_Last90d")
    days, pay = _n(df, "DaysSinceLastAccessed"), _n(df, payment_col)
    if tenure_edges is None:
        # the edges need their own pass over the frame: materialise it once (one row per membership)
        from ..session import cut_lineage
        df = cut_lineage(df)
        edges = quartile_edges(df)
    else:
        edges = tenure_edges
    avg90 = F.coalesce(v90, F.lit(0.0)) / 3
    months = F.coalesce(tenure, F.lit(1.0)) / 30
    rate = clip(pdiv(total, F.coalesce(tenure, F.lit(1.0)) + 1), 0, 10)
    declining = (F.coalesce(v30, F.lit(0.0)) < avg90 * 0.7)
    days0 = F.coalesce(days, F.lit(0.0))
    cols = {
        "Engagement_Rate": rate,
        "Recent_Activity_Ratio": clip(pdiv(F.coalesce(v30, F.lit(0.0)), avg90 + 0.001), 0, 5),
        "Declining_Engagement": declining.cast("int"),
        "Monthly_Avg_Visits": clip(pdiv(total, months + 0.1), 0, 30),
        "Payment_to_Attendance_Ratio": clip(pdiv(F.coalesce(pay, F.lit(0.0)), F.coalesce(total, F.lit(1.0)) + 1), 0, 100),
        "Recent_Payment_to_Visits": clip(pdiv(F.coalesce(pay, F.lit(0.0)), F.coalesce(v30, F.lit(1.0)) + 1), 0, 100),
        "Tenure_Quartile": quartile_label(F.coalesce(tenure, F.lit(0.0)), edges),
        "Early_Churn_Risk": ((days0 > 90) & F.coalesce(rate < 0.5, F.lit(False)) & declining).cast("int"),
        "Inactivity_Ratio": clip(pdiv(days0, F.coalesce(tenure, F.lit(1.0)) + 1), 0, 10),
        "Attendance_Dropoff": F.coalesce(F.coalesce(v30, F.lit(0.0)) < pdiv(total, months + 0.1) * 0.5,
                                         F.lit(False)).cast("int"),
        "Access_Gap_Months": clip(days0 / 30, 0, 36),
        "High_Inactivity": (days0 > 90).cast("int"),
    }
    out = df.withColumns(cols)
    return out
