"""Per-membership profile at an as-of date: exclusive active rule, attendance
aggregates, CASE bands, 3-class label; join with the weekly snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import asof
from ..functions import columns as X

PROFILE_COLUMNS = ["MembershipID", "Gender", "Age", "SubCategory", "Channel", "ClubName", "MembershipTypeDesc",
                   "RegularPayment", "Base Amount", "Term", "TermDays", "Lump Sum Flag", "DaysSinceLastAccessed",
                   "TenureDays", "DaysSinceOriginalStart", "TotalAttendanceToDate", "Visits_Last30d",
                   "Visits_Last90d", "EndedWithinCoolingPeriod", "end_date", "Churned"]


def attendance_features(attendance: DataFrame, T, extended: bool = False) -> DataFrame:
    """Per membership over weeks < T: total visits, visits in the last 30/90 days
    (SQL SUM semantics: NULL visits are skipped; all-NULL -> NULL), optionally the last
    week, days since it and paused weeks. Partial aggregation happens map-side."""
    Td = asof.as_date(T)
    wk = F.col("WeekBeginningDate")
    v = F.col("WeekVisits")
    aggs = [F.sum(v).cast("long").alias("TotalAttendanceToDate"),
            F.sum(F.when(wk >= F.date_sub(Td, 30), v).otherwise(F.lit(0))).cast("long").alias("Visits_Last30d"),
            F.sum(F.when(wk >= F.date_sub(Td, 90), v).otherwise(F.lit(0))).cast("long").alias("Visits_Last90d")]
    if extended:
        aggs += [F.max(wk).alias("LastVisitDate"),
                 F.datediff(Td, F.max(wk)).alias("DaysSinceLastVisit"),
                 F.sum(F.when(F.col("OnPauseThisWeek") == 1, 1).otherwise(0)).cast("long").alias("WeeksPausedToDate")]
    return attendance.where(asof.before_as_of(wk, T)).groupBy("MembershipID").agg(*aggs)


def base_memberships(memberships: DataFrame, T, case_insensitive: bool = False) -> DataFrame:
    return memberships.where(
        asof.active_at_profile(F.col("Start Date").cast("date"), F.col("End Date").cast("date"), T)
        & asof.exclude_subcategories(F.col("SubCategory"), case_insensitive))


def profile(memberships: DataFrame, attendance: DataFrame, T, case_insensitive_like: bool = True,
            extended: bool = False, keep_payment_amount: bool = False) -> DataFrame:
    """The 21-column profile. Tenure and the class label are columns of the base rows
    (no self-joins); the only join is base ⋈ attendance aggregates, made inner by the
    TotalAttendanceToDate > 0 filter."""
    Td = asof.as_date(T)
    base = not_transferred(memberships, T)
    if not extended:
        # weeks without visits add nothing to the three sums, and members with only such
        # weeks fail TotalAttendanceToDate > 0: dropping them is output-neutral and becomes a
        # pushed-down scan filter on a stored attendance table
        attendance = attendance.where(F.col("WeekVisits").isNotNull())
    att = attendance_features(attendance, T, extended)
    j = base.join(att, "MembershipID").where(F.col("TotalAttendanceToDate") > 0)
    end = F.col("End Date")
    cols = profile_columns(T, case_insensitive_like)
    if extended:
        cols += ["LastVisitDate", "DaysSinceLastVisit", "WeeksPausedToDate",
                 F.datediff(end.cast("date"), Td).alias("DaysToContractEnd")]
    if keep_payment_amount:
        cols += [F.col("RegularPayment").alias("RegularPaymentAmount"), F.col("Base Amount").alias("BaseAmountNumber")]
    return j.select(*cols)


def not_transferred(memberships: DataFrame, T) -> DataFrame:
    return base_memberships(memberships, T).where(F.col("Transferred_OUT").isNull())


def profile_columns(T, case_insensitive_like: bool = True) -> list:
    """The 21 columns, from memberships joined to their attendance sums."""
    Td, end = asof.as_date(T), F.col("End Date")
    return [
        F.col("MembershipID"), F.col("Gender"), X.age_years(F.col("DOB"), T).alias("Age"),
        "SubCategory", "Channel", "ClubName", "MembershipTypeDesc",
        X.payment_band(F.col("RegularPayment")).alias("RegularPayment"),
        X.frequency_group(F.col("PaymentFrequency"), case_insensitive_like).alias("Base Amount"),
        X.term_group(F.col("Term"), case_insensitive_like).alias("Term"),
        "TermDays", "Lump Sum Flag",
        X.days_since_last_accessed(F.col("DateLastAccessed").cast("date"), T).alias("DaysSinceLastAccessed"),
        F.datediff(Td, F.col("Start Date")).alias("TenureDays"),
        F.datediff(Td, F.col("Original Start Date")).alias("DaysSinceOriginalStart"),
        "TotalAttendanceToDate", "Visits_Last30d", "Visits_Last90d", "EndedWithinCoolingPeriod",
        end.cast("date").alias("end_date"),
        asof.churn_class_3(end, T).cast("int").alias("Churned"),
    ]


def join_profile_snapshot(prof: DataFrame, snap: DataFrame) -> DataFrame:
    """profile ⋈ snapshot(ews_pct, risk_band) on the normalised key lower(trim(id))."""
    s = snap.select(X.normalize_key(F.col("member_id")).alias("member_id"), "ews_pct", "risk_band")
    p = prof.withColumn("member_id", X.normalize_key(F.col("MembershipID")))
    return p.join(s, "member_id")
