"""Risk band x churn month evaluation matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import normalize_band
from .snapshot import latest_per_member

MONTHS = list(range(1, 13))


def month_label(m: int) -> str:
    return f"pct_churned_{m}month" if m == 1 else f"pct_churned_{m}months"


def churn_per_member(churned: DataFrame) -> DataFrame:
    """First non-NULL month bucket in week order, and the max churn flag."""
    first = F.min(F.when(F.col("end_month_bucket").isNotNull(),
                         F.struct(F.col("week"), F.col("end_month_bucket").alias("b"))))
    return churned.groupBy("member_id").agg(first["b"].cast("int").alias("end_month_bucket"),
                                            F.max("churn_flag").alias("churn_flag"))


def snapshot_latest_band(snapshots: DataFrame) -> DataFrame:
    return latest_per_member(snapshots.select("member_id", "week", "risk_band")).select(
        "member_id", normalize_band(F.col("risk_band")).alias("risk_band"))


def band_month_matrix(snapshots: DataFrame, churned: DataFrame) -> DataFrame:
    """One row per band in the fixed order Low, Medium, High, Critical (bands absent
    from the data appear with zeros; other spellings are dropped).

    The universe is the snapshot: members are unique after the latest-per-member step,
    so distinct counts reduce to conditional counts in a single aggregation (no
    Expand for 14 distinct aggregates)."""
    snap = snapshot_latest_band(snapshots)
    churn = churn_per_member(churned)
    merged = (snap.join(churn, "member_id", "left")
              .withColumn("churn_flag", F.coalesce(F.col("churn_flag"), F.lit(0)).cast("int"))
              .where(F.col("risk_band").isin(C.BAND_ORDER)))
    b = F.col("end_month_bucket")
    aggs = [F.count(F.when(b == m, F.col("member_id"))).alias(f"m{m}") for m in MONTHS]
    aggs += [F.count(F.when(b.isNull(), F.col("member_id"))).alias("null_bucket"),
             F.count(F.col("member_id")).alias("Total_Members")]
    per = merged.groupBy("risk_band").agg(*aggs)
    spine = snapshots.sparkSession.createDataFrame(
        [(band, i) for i, band in enumerate(C.BAND_ORDER)], "risk_band string, band_order int")
    # the spine has 4 rows: broadcasting it is size-bounded
    full = F.broadcast(spine).join(per, "risk_band", "left")
    counts = [F.coalesce(F.col(f"m{m}"), F.lit(0)).alias(f"m{m}") for m in MONTHS]
    full = full.select("risk_band", "band_order", *counts,
                       F.coalesce(F.col("null_bucket"), F.lit(0)).alias("null_bucket"),
                       F.coalesce(F.col("Total_Members"), F.lit(0)).alias("Total_Members"))
    churned_total = sum((F.col(f"m{m}") for m in MONTHS), F.lit(0))
    full = full.withColumn("Total_Churned", churned_total)
    tm = F.col("Total_Members")

    def pct(x):
        return F.bround(F.coalesce(x.cast("double") / F.when(tm != 0, tm), F.lit(0.0)), 4)

    return full.select(
        "risk_band", "band_order", *[F.col(f"m{m}") for m in MONTHS], "null_bucket",
        *[pct(F.col(f"m{m}")).alias(month_label(m)) for m in MONTHS],
        "Total_Members", "Total_Churned", (tm - F.col("Total_Churned")).alias("Total_Not_Churned"),
        tm.alias("Total_Churned_And_Not"), pct(F.col("Total_Churned")).alias("pct_Churned"))


def csv_headers(df: DataFrame) -> DataFrame:
    """Rename to the published CSV headers ('1'..'12', 'null', '%churned_1month', ...)."""
    ren = {f"m{m}": str(m) for m in MONTHS}
    ren.update({month_label(m): "%" + month_label(m)[4:] for m in MONTHS})
    ren.update({"null_bucket": "null", "pct_Churned": "%_Churned"})
    return df.select(*[F.col(c).alias(ren.get(c, c)) for c in df.columns])
