"""Prediction helpers: confidence, class labels, label encoding, sink mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.asof import actual_churn_label
from ..functions.columns import literal_map


def confidence(probs: list[Column]) -> Column:
    return F.greatest(*probs)


def class_label(pred: Column) -> Column:
    return literal_map(pred, C.CLASS_LABELS)


def label_encode(churned: Column) -> Column:
    """Classes 1, 2, 3 -> 0, 1, 2 (sorted label encoding)."""
    return (churned - 1).cast("int")


# 38-column prediction table: (sink column, source column or None, Spark type).
# Column names and order of the published table.
SINK_SPEC = [
    ("RunDate", "RunDate", "date"), ("MembershipID", "MembershipID", "string"), ("MemberId", "member_id", "string"),
    ("Gender", "Gender", "string"), ("Age", "Age", "bigint"), ("SubCategory", "SubCategory", "string"),
    ("Channel", "Channel", "string"), ("ClubName", "ClubName", "string"),
    ("MembershipTypeDesc", "MembershipTypeDesc", "string"), ("Term", "Term", "string"),
    ("TermDays", "TermDays", "bigint"), ("Lump Sum Flag", "Lump Sum Flag", "bigint"),
    ("RegularPayment", "RegularPayment", "double"), ("Base Amount", "BaseAmountNumber", "double"),
    ("TenureDays", "TenureDays", "bigint"), ("DaysSinceOriginalStart", "DaysSinceOriginalStart", "bigint"),
    ("DaysSinceLastAccessed", "DaysSinceLastAccessed", "bigint"),
    ("TotalAttendanceToDate", "TotalAttendanceToDate", "bigint"), ("Visits_Last90d", "Visits_Last90d", "bigint"),
    ("Visits_Last30d", "Visits_Last30d", "bigint"), ("EndedWithinCoolingPeriod", "EndedWithinCoolingPeriod", "bigint"),
    ("EWS_Pct", "ews_pct", "double"), ("Risk_Band", "risk_band", "string"),
    ("Engagement_Rate", "Engagement_Rate", "double"), ("Recent_Activity_Ratio", "Recent_Activity_Ratio", "double"),
    ("Declining_Engagement", "Declining_Engagement", "double"), ("Monthly_Avg_Visits", "Monthly_Avg_Visits", "double"),
    ("Payment_to_Attendance_Ratio", "Payment_to_Attendance_Ratio", "double"),
    ("Recent_Payment_to_Visits", "Recent_Payment_to_Visits", "double"),
    ("Tenure_Quartile", "Tenure_Quartile", "bigint"), ("Early_Churn_Risk", "Early_Churn_Risk", "bigint"),
    ("Inactivity_Ratio", "Inactivity_Ratio", "double"), ("Attendance_Dropoff", "Attendance_Dropoff", "bigint"),
    ("Access_Gap_Months", "Access_Gap_Months", "double"), ("High_Inactivity", "High_Inactivity", "bigint"),
    ("Prediction", "PredictedClass", "bigint"), ("PredictionConfidence", "Confidence", "double"),
    ("EndDate", "end_date", "date"),
]
KEY_COLUMNS = ["MembershipID", "ChurnedPrediction", "EndDate", "RunDate"]


def predictions_frame(probs: DataFrame, thresholds: dict[int, float] | None, id_col: str = "MembershipID",
                      prob_cols=("p0", "p1", "p2")) -> DataFrame:
    """MembershipID, Class{0,1,2}_Prob, PredictedClass, Confidence, ClassLabel. Thresholds
    (a per-class dict) when given, else argmax."""
    from .thresholds import apply_thresholds, argmax_class
    p = [F.col(c) for c in prob_cols]
    pred = apply_thresholds(p, thresholds) if thresholds else argmax_class(p)
    return probs.select(id_col, *[F.col(c).alias(f"Class{i}_Prob") for i, c in enumerate(prob_cols)],
                        pred.alias("PredictedClass"), confidence(p).alias("Confidence"),
                        class_label(pred).alias("ClassLabel"))


def join_predictions_features(features: DataFrame, predictions: DataFrame) -> DataFrame:
    """features ⟕ predictions on MembershipID (rows keep their features even without a
    prediction). Replaces the source's attach-by-position."""
    return features.join(predictions.select("MembershipID", "PredictedClass", "Confidence", "ClassLabel"),
                         "MembershipID", "left")


def match_counts(merged: DataFrame) -> DataFrame:
    return merged.agg(F.count(F.lit(1)).alias("rows"),
                      F.count("PredictedClass").alias("with_prediction"),
                      F.sum(F.col("PredictedClass").isNull().cast("long")).alias("missing_prediction"))


def add_run_date(df: DataFrame, run_date) -> DataFrame:
    return df.withColumn("RunDate", F.lit(str(run_date)).cast("date"))


def map_to_sink_schema(df: DataFrame, run_date=None, spec=SINK_SPEC) -> DataFrame:
    """One select from the column spec: rename, ``try_cast`` into the sink type, absent
    or unmapped columns become typed NULLs (Spark has no NaN-vs-NULL split to repair).
    ``RegularPayment`` prefers a numeric amount column when present."""
    if run_date is not None:
        df = add_run_date(df, run_date)
    cols = set(df.columns)
    out = []
    for name, src, typ in spec:
        if name == "RegularPayment" and "RegularPaymentAmount" in cols:
            src = "RegularPaymentAmount"
        if src is not None and src in cols:
            c = F.col(f"`{src}`")
            expr = c.cast(typ) if typ == "string" else c.try_cast(typ)
        else:
            expr = F.lit(None).cast(typ)
        out.append(expr.alias(name))
    return df.select(*out)


def reorder_key_first(df: DataFrame) -> DataFrame:
    keys = [c for c in KEY_COLUMNS if c in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in keys + [c for c in df.columns if c not in keys]])


def saved_predictions(features: DataFrame, predictions: DataFrame, run_date) -> DataFrame:
    """CSV export shape: features + ChurnedPrediction + RunDate, end_date -> EndDate,
    key columns first."""
    j = features.join(predictions.select("MembershipID", F.col("PredictedClass").alias("ChurnedPrediction")),
                      "MembershipID", "left")
    j = add_run_date(j, run_date)
    if "end_date" in j.columns:
        j = j.withColumnRenamed("end_date", "EndDate").withColumn("EndDate", F.col("EndDate").cast("date"))
    return reorder_key_first(j)


#: The documented consumer reports; names are fixed, each is a function of saved predictions.
CAMPAIGNS = ("high_risk", "validation", "high_ews_low_band", "export")


def campaign_query(predictions: DataFrame, name: str) -> DataFrame:
    """One consumer report: ``high_risk`` (members predicted to leave first), ``validation``
    (prediction beside what happened), ``high_ews_low_band`` (ten largest scores among
    low-band members) or ``export`` (contact list of both risk classes)."""
    by_score = F.col("ews_pct").desc()
    if name == "high_risk":
        return (predictions.where(F.col("ChurnedPrediction") == 0).orderBy(by_score)
                .select("MembershipID", "EndDate", "ews_pct", "risk_band"))
    if name == "validation":
        return predictions.select("MembershipID", "ChurnedPrediction", "EndDate",
                                  actual_churn_label(F.col("EndDate"), F.col("RunDate")).alias("ActualChurn"))
    if name == "high_ews_low_band":
        return (predictions.where((F.col("ews_pct") > 0.8) & (F.col("risk_band") == "Low"))
                .orderBy(by_score, "MembershipID").limit(10)
                .select("MembershipID", "ews_pct", "risk_band", "ChurnedPrediction"))
    if name == "export":
        return (predictions.where(F.col("ChurnedPrediction").isin(0, 1)).orderBy(by_score)
                .select("MembershipID", "Gender", "Age", "ClubName", "ews_pct"))
    raise ValueError(f"unknown campaign report: {name}")
