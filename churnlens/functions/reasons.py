"""Reason codes, primary reason, severity, risk band, playbook — all native
expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C


def _num(df_cols, name: str, default) -> Column:
    return F.col(name) if name in df_cols else F.lit(default)


def reason_codes(df: DataFrame, k_weeks: int = C.K_WEEKS) -> Column:
    """'paused_state' for paused weeks, else '|'-joined tags, 'none' when no tag fires.
    A NULL z-score never fires (NaN comparisons are false)."""
    cols = set(df.columns)
    dcol = "drought_active" if "drought_active" in cols else "drought"
    tags = [
        F.when(_num(cols, "momentum_z", 0) < C.MOMENTUM_Z_CUT, F.lit("negative_momentum")),
        F.when(_num(cols, dcol, 0) >= max(2, k_weeks // 2), F.lit("drought_streak")),
        F.when(_num(cols, "volatility_z", 0) > C.VOLATILITY_Z_CUT, F.lit("erratic_usage")),
        F.when(_num(cols, "payment_failed", 0) == 1, F.lit("payment_issue")),
        F.when((_num(cols, "price_change", 0) == 1) & (_num(cols, "discount_active", 1) == 0),
               F.lit("price_sensitivity")),
    ]
    joined = F.concat_ws("|", *tags)
    paused = F.coalesce(_num(cols, "paused", 0), F.lit(0)).cast("int") == 1
    return F.when(paused, F.lit("paused_state")).when(joined == "", F.lit("none")).otherwise(joined)


def reason_array(reasons: Column) -> Column:
    return F.filter(F.transform(F.split(reasons, r"\|"), lambda x: F.trim(x)), lambda x: x != "")


def primary_reason(reasons: Column) -> Column:
    arr = reason_array(reasons)
    picks = [F.when(F.array_contains(arr, r), F.lit(r)) for r in C.PRIMARY_REASON_ORDER]
    return F.when(F.size(arr) == 0, F.lit("none")).otherwise(F.coalesce(*picks, F.element_at(arr, 1)))


def severity_rank(reason: Column) -> Column:
    pos = F.array_position(F.array(*[F.lit(r) for r in C.SEVERITY_ORDER]), reason)
    return F.when(pos > 0, pos - 1).otherwise(F.lit(C.SEVERITY_UNKNOWN)).cast("int")


def risk_band(pct: Column) -> Column:
    expr = None
    for cut, label in C.RISK_BANDS:
        expr = F.when(pct >= cut, label) if expr is None else expr.when(pct >= cut, label)
    return expr.otherwise(C.RISK_BAND_ELSE)


def relabel_reason(c: Column) -> Column:
    """Whole-string replacement only (a tag inside a '|' list is left as is)."""
    expr = None
    for old, new in C.REASON_RELABEL.items():
        expr = F.when(c == old, new) if expr is None else expr.when(c == old, new)
    return expr.otherwise(c)


def playbook(spark: SparkSession) -> DataFrame:
    """Five-row reason -> (action_tag, subject, message) table (fixed size: broadcastable)."""
    return spark.createDataFrame(C.PLAYBOOK, "reason string, action_tag string, subject string, message string")


def attach_playbook(df: DataFrame, reason_col: str = "main_reason") -> DataFrame:
    """Broadcast join to the 5-row playbook; unknown reasons take the 'none' entry."""
    pb = playbook(df.sparkSession)
    none = [r for r in C.PLAYBOOK if r[0] == "none"][0]
    j = df.join(F.broadcast(pb), df[reason_col] == pb["reason"], "left")
    return j.select(*[df[c] for c in df.columns],
                    F.coalesce(pb["action_tag"], F.lit(none[1])).alias("action_tag"),
                    F.coalesce(pb["subject"], F.lit(none[2])).alias("subject"),
                    F.coalesce(pb["message"], F.lit(none[3])).alias("message"))
