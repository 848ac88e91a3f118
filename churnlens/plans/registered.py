"""Registered queries (inventory id -> Spark query + DuckDB twin)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import config as C

from ..operators import weekly as WK
from ..sources import fixtures as FX
from ..sources import typed as TY
from . import oracle as O
from .registry import AS_OF, att_year, members, register


# --- scans / sources ---------------------------------------------------------

@register("scan_memberships", lambda: f"SELECT * FROM ({O.sql_memberships(AS_OF)}) m")
def q_scan_memberships(spark, sf_dir):
    return TY.typed(FX.memberships(spark, sf_dir, AS_OF), TY.MEMBERSHIPS).good


@register("scan_attendance", lambda: f"SELECT * FROM ({O.sql_attendance(O.prev_year(AS_OF), AS_OF)}) a")
def q_scan_attendance(spark, sf_dir):
    return TY.typed(att_year(spark, sf_dir), TY.ATTENDANCE).good


def _scan_rejects_sql():
    n = "CAST(substr(trim(MembershipID), 2) AS BIGINT)"
    m = f"({O.sql_memberships(AS_OF)}) m"
    return (f"SELECT 'End Date' AS field, count(*) AS n FROM {m} WHERE {n} % 7 = 0 UNION ALL "
            f"SELECT 'RegularPayment', count(*) FROM {m} WHERE {n} % 11 = 0 UNION ALL "
            f"SELECT '<good>', count(*) FROM {m} WHERE {n} % 7 <> 0 AND {n} % 11 <> 0")


@register("scan_rejects", _scan_rejects_sql)
def q_scan_rejects(spark, sf_dir):
    """Memberships from a CSV file in which some dates and numbers are no such thing: good
    rows, and rejected rows by field."""
    from ..sources import io as IO
    rows = FX.memberships(spark, sf_dir, AS_OF)
    n = F.substring(F.trim("MembershipID"), 2, 20).cast("long")
    rows = rows.withColumns({"End Date": F.when(n % 7 == 0, "2001-31-12").otherwise(F.col("End Date").cast("string")),
                             "RegularPayment": F.when(n % 11 == 0, "n/a").otherwise(F.col("RegularPayment").cast("string"))})
    path = _scratch(spark, "memberships-csv")
    IO.write_csv(rows, path)
    scan = TY.scan_csv(spark, path, TY.MEMBERSHIPS)
    rejects = scan.rejects.select(F.explode("fields").alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("n"))
    return rejects.unionByName(scan.good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("<good>").alias("field"), "n"))


# --- weekly panel ------------------------------------------------------------

@register("job_weekly_panel", lambda: O.sql_panel(AS_OF, labels=True, flags=False))
def q_weekly_panel(spark, sf_dir):
    return WK.weekly_panel(members(spark, sf_dir), att_year(spark, sf_dir), AS_OF, labels=True)


# --- weekly features ---------------------------------------------------------

from ..functions import reasons as R  # noqa: E402
from ..operators import evaluate as EV  # noqa: E402
from ..operators import outreach as OR  # noqa: E402
from ..operators import ranking as RK  # noqa: E402
from ..operators import snapshot as SN  # noqa: E402


def _panel_flags(spark, sf_dir, labels=False):
    return WK.weekly_panel(members(spark, sf_dir), att_year(spark, sf_dir), AS_OF, labels=labels, flags=True)


def _features(spark, sf_dir):
    return WK.member_features(_panel_flags(spark, sf_dir))


def _feature_query(key: str, cols: list[str]):
    sel = ", ".join(["member_id", "week"] + [c if c.isidentifier() else f'"{c}"' for c in cols])

    def sql():
        out = []
        for c in cols:
            out.append(O.r6(c) + f" AS {c}" if c in DOUBLE_FEATURES else c)
        return O.sql_features(AS_OF) + f"SELECT member_id, week, {', '.join(out)} FROM f"

    def fn(spark, sf_dir):
        return _features(spark, sf_dir).select("member_id", "week", *cols)

    register(key, sql)(fn)


DOUBLE_FEATURES = {"ema", "momentum", "volatility", "pct_self", "sin_woy", "cos_woy",
                   "engagement_z", "ema_z", "momentum_z", "volatility_z"}

_feature_query("ema", ["engagement", "ema"])
_feature_query("momentum", ["ema", "momentum"])
_feature_query("volatility", ["volatility"])
_feature_query("drought", ["engagement", "drought"])
_feature_query("drought_active", ["engagement", "paused", "drought_active"])
_feature_query("pct_self", ["engagement", "pct_self"])
_feature_query("tenure_weeks", ["tenure_weeks"])


@register("pct_self_causal", lambda: f"WITH p AS ({O.sql_panel(AS_OF)}) SELECT a.member_id, a.week, a.engagement, "
          f"{O.r6('(count(CASE WHEN b.engagement < a.engagement THEN 1 END) + (count(CASE WHEN b.engagement = a.engagement THEN 1 END) + 1) / 2.0) / count(*)')} "
          f"AS pct_self_causal FROM p a JOIN p b ON a.member_id = b.member_id AND b.week <= a.week GROUP BY 1, 2, 3")
def q_pct_causal(spark, sf_dir):
    """Rank of each week's visits among the member's weeks so far."""
    panel = WK.weekly_panel(members(spark, sf_dir), att_year(spark, sf_dir), AS_OF).select("member_id", "week", "engagement")
    return WK.pct_self_causal(panel)


_feature_query("zscore_by_member", ["engagement_z", "ema_z", "momentum_z", "volatility_z"])
_feature_query("member_stats", ["engagement", "engagement_z"])
_feature_query("season_sin_cos", ["sin_woy", "cos_woy"])
_feature_query("default_flags", ["payment_failed", "discount_active", "price_change", "negative_feedback",
                                 "campaign_exposed"])
_feature_query("sort_panel", ["engagement", "paused"])


@register("future_k_label", lambda: O.sql_features(AS_OF) +
          f"SELECT member_id, week, drought_active, canceled, {O.sql_future_label()} AS y_nextk FROM f")
def q_future_k_label(spark, sf_dir):
    return WK.future_k_label(_features(spark, sf_dir)).select("member_id", "week", "drought_active", "canceled", "y_nextk")


@register("churn_event_proxy", lambda: O.sql_features(AS_OF) +
          "SELECT member_id, week, CASE WHEN coalesce(canceled, 0) = 1 THEN 1 ELSE "
          f"CAST(drought_active >= {C.DROUGHT_EVENT_WEEKS} AS INTEGER) END AS churn_this_week FROM f")
def q_churn_event(spark, sf_dir):
    f = _features(spark, sf_dir)
    return f.select("member_id", "week", WK.churn_event(f).cast("int").alias("churn_this_week"))


# --- scores, reasons, snapshot ----------------------------------------------

def _scores(spark, sf_dir):
    return SN.score_frame(WK.surrogate_ews(_features(spark, sf_dir)))


def _snapshot(spark, sf_dir, relabel=False):
    snap = SN.build_snapshots(_scores(spark, sf_dir))
    return SN.relabel_snapshot(snap) if relabel else snap


@register("reason_codes", lambda: O.sql_scores(AS_OF) + "SELECT member_id, week, reasons FROM sc")
def q_reason_codes(spark, sf_dir):
    return _scores(spark, sf_dir).select("member_id", "week", "reasons")


@register("score_surrogate", lambda: O.sql_scores(AS_OF) + f"SELECT member_id, week, {O.r6('EWS')} AS EWS, "
          f"{O.r6('prob_churn_6w')} AS prob_churn_6w FROM sc")
def q_score(spark, sf_dir):
    return _scores(spark, sf_dir).select("member_id", "week", "EWS", "prob_churn_6w")


@register("primary_reason", lambda: O.sql_scores(AS_OF) +
          f"SELECT member_id, week, reasons, {O.sql_primary_reason('reasons')} AS main_reason FROM sc")
def q_primary_reason(spark, sf_dir):
    s = _scores(spark, sf_dir)
    return s.select("member_id", "week", "reasons", R.primary_reason(F.col("reasons")).alias("main_reason"))


@register("severity_rank", lambda: O.sql_scores(AS_OF) +
          f"SELECT member_id, week, {O.sql_severity('(' + O.sql_primary_reason('reasons') + ')')} AS sev_rank FROM sc")
def q_severity(spark, sf_dir):
    s = _scores(spark, sf_dir)
    return s.select("member_id", "week", R.severity_rank(R.primary_reason(F.col("reasons"))).alias("sev_rank"))


@register("latest_preferring_nonpaused", lambda: O.sql_snapshot(AS_OF) +
          "SELECT member_id, week, engagement, paused FROM lt")
def q_latest_np(spark, sf_dir):
    return SN.latest_preferring_nonpaused(_scores(spark, sf_dir)).select("member_id", "week", "engagement", "paused")


@register("ews_percentile", lambda: O.sql_snapshot(AS_OF) + f"SELECT member_id, {O.r6('EWS')} AS EWS, "
          f"{O.r6('ews_pct')} AS ews_pct FROM snap")
def q_ews_pct(spark, sf_dir):
    return _snapshot(spark, sf_dir).select("member_id", "EWS", "ews_pct")


@register("risk_band", lambda: O.sql_snapshot(AS_OF) + "SELECT member_id, risk_band FROM snap")
def q_risk_band(spark, sf_dir):
    return _snapshot(spark, sf_dir).select("member_id", "risk_band")


SNAP_SQL_COLS = (f"member_id, week, {O.r6('prob_churn_6w')} AS prob_churn_6w, {O.r6('EWS')} AS EWS, reasons, "
                 f"engagement, paused, {O.r6('ews_pct')} AS ews_pct, risk_band, main_reason")


@register("job_snapshots", lambda: O.sql_snapshot(AS_OF, relabel=True) + f"SELECT {SNAP_SQL_COLS} FROM snap")
def q_snapshots(spark, sf_dir):
    return _snapshot(spark, sf_dir, relabel=True)


@register("relabel_reasons", lambda: O.sql_snapshot(AS_OF, relabel=True) +
          "SELECT member_id, reasons, main_reason FROM snap")
def q_relabel(spark, sf_dir):
    return _snapshot(spark, sf_dir, relabel=True).select("member_id", "reasons", "main_reason")


@register("auc_binary", lambda: O.sql_features(AS_OF) + f""",
lab AS (SELECT {O.sql_surrogate()} AS s, {O.sql_future_label()} AS y FROM f),
rk AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS ar FROM lab),
agg AS (SELECT sum(CASE WHEN y = 1 THEN ar ELSE 0 END) AS rs, CAST(sum(y) AS DOUBLE) AS P,
               CAST(count(*) - sum(y) AS DOUBLE) AS N FROM rk)
SELECT {O.r6('(rs - P * (P + 1) / 2.0) / (P * N)')} AS auc FROM agg""")
def q_auc(spark, sf_dir):
    f = WK.future_k_label(WK.surrogate_ews(_features(spark, sf_dir)))
    return RK.auc_binary(f, "EWS", "y_nextk")


@register("average_precision", lambda: O.sql_features(AS_OF) + f""",
lab AS (SELECT {O.sql_surrogate()} AS s, {O.sql_future_label()} AS y FROM f),
gs AS (SELECT s, count(*) AS c, sum(y) AS pos FROM lab GROUP BY s),
cum AS (SELECT s, c, pos, sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tp,
               sum(c) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS n, sum(pos) OVER () AS P FROM gs)
SELECT {O.r6('sum(pos * 1.0 / P * (tp * 1.0 / n))')} AS average_precision FROM cum""")
def q_ap(spark, sf_dir):
    f = WK.future_k_label(WK.surrogate_ews(_features(spark, sf_dir)))
    return RK.average_precision(f, "EWS", "y_nextk")


# --- outreach ----------------------------------------------------------------

def _contacts(spark, sf_dir):
    return FX.recent_contacts(spark, sf_dir, AS_OF)


def _active(spark, sf_dir, cooldown=True):
    return OR.active_candidates(_snapshot(spark, sf_dir), _contacts(spark, sf_dir) if cooldown else None)


Q_SQL_COLS = (f"member_id, week, engagement, paused, {O.r6('EWS')} AS EWS, risk_band, main_reason, reasons, "
              "action_tag, subject, message")


@register("split_active_paused", lambda: O.sql_snapshot(AS_OF) +
          "SELECT member_id, paused, CASE WHEN paused = 0 THEN 'active' ELSE 'paused' END AS queue FROM snap "
          "WHERE paused IN (0, 1)")
def q_split(spark, sf_dir):
    a, p = OR.split_active_paused(_snapshot(spark, sf_dir))
    return (a.select("member_id", "paused", F.lit("active").alias("queue"))
            .unionByName(p.select("member_id", "paused", F.lit("paused").alias("queue"))))


@register("cooldown_filter", lambda: O.sql_active_candidates(AS_OF) + "SELECT member_id, week FROM act")
def q_cooldown(spark, sf_dir):
    return _active(spark, sf_dir).select("member_id", "week")


@register("join_recent_contacts", lambda: O.sql_snapshot(AS_OF) +
          f"SELECT s.member_id, s.week, rc.last_contact_date FROM (SELECT * FROM snap WHERE paused = 0) s LEFT JOIN "
          f"(SELECT member_id, max(last_contact_date) AS last_contact_date FROM ({O.sql_recent_contacts(AS_OF)}) r0 "
          f"GROUP BY member_id) rc ON s.member_id = rc.member_id")
def q_join_contacts(spark, sf_dir):
    a, _ = OR.split_active_paused(_snapshot(spark, sf_dir))
    return a.join(OR.latest_contacts(_contacts(spark, sf_dir)), "member_id", "left").select(
        "member_id", "week", "last_contact_date")


@register("join_playbook", lambda: O.sql_active_candidates(AS_OF, None) +
          "SELECT member_id, main_reason, action_tag, subject, message FROM act")
def q_playbook(spark, sf_dir):
    return _active(spark, sf_dir, cooldown=False).select("member_id", "main_reason", "action_tag", "subject", "message")


@register("outreach_topk", lambda: O.sql_active_candidates(AS_OF) +
          f"SELECT {Q_SQL_COLS} FROM act ORDER BY sev_rank ASC, EWS DESC, member_id ASC LIMIT {C.OUTREACH_CAPACITY}")
def q_topk(spark, sf_dir):
    return OR.outreach_topk(_active(spark, sf_dir)).select(*OR.QUEUE_COLS)


@register("ews_threshold_filter", lambda: O.sql_active_candidates(AS_OF) + f"SELECT {Q_SQL_COLS} FROM act WHERE EWS >= 0.5")
def q_ews_thr(spark, sf_dir):
    return OR.ews_threshold_filter(_active(spark, sf_dir), 0.5).select(*OR.QUEUE_COLS)


@register("paused_queue", lambda: O.sql_snapshot(AS_OF) +
          f"SELECT {Q_SQL_COLS} FROM ({O.sql_with_playbook('(SELECT * REPLACE (1 AS paused) FROM snap WHERE paused = 1 OR CAST(substr(trim(member_id), 2) AS BIGINT) % 9 = 0)')}) x")
def q_paused(spark, sf_dir):
    """The paused queue of snapshots in which every ninth member is on pause (in the tables
    no member's last week is)."""
    number = F.substring(F.trim("member_id"), 2, 20).cast("long")
    snap = _snapshot(spark, sf_dir).withColumn("paused", F.when(number % 9 == 0, F.lit(1)).otherwise(F.col("paused")))
    return OR.paused_queue(snap).select(*OR.QUEUE_COLS)


# --- profile -----------------------------------------------------------------

from ..functions import engineered as EN  # noqa: E402
from ..operators import profile as PR  # noqa: E402
from .registry import COHORTS  # noqa: E402


def _profile(spark, sf_dir, T=AS_OF, **kw):
    att = FX.attendance(spark, sf_dir, None, T, nonempty_only=not kw.get("extended", False))
    return PR.profile(FX.memberships(spark, sf_dir, T), att, T, **kw)


def _profile_snapshot(spark, sf_dir, payment_amount=False):
    prof = _profile(spark, sf_dir, keep_payment_amount=payment_amount)
    return PR.join_profile_snapshot(prof, _snapshot(spark, sf_dir, relabel=True))


@register("project_profile", lambda: f"SELECT {O.PROFILE_SQL_COLS} FROM {O.sql_profile(AS_OF)} p")
def q_profile(spark, sf_dir):
    return _profile(spark, sf_dir)


@register("attendance_features", lambda: f"""
SELECT MembershipID, CAST(sum(WeekVisits) AS BIGINT) AS TotalAttendanceToDate,
       CAST(sum(CASE WHEN WeekBeginningDate >= CAST({O.d(AS_OF)} - 30 AS DATE) THEN WeekVisits ELSE 0 END) AS BIGINT) AS Visits_Last30d,
       CAST(sum(CASE WHEN WeekBeginningDate >= CAST({O.d(AS_OF)} - 90 AS DATE) THEN WeekVisits ELSE 0 END) AS BIGINT) AS Visits_Last90d,
       max(WeekBeginningDate) AS LastVisitDate,
       CAST(date_diff('day', max(WeekBeginningDate), {O.d(AS_OF)}) AS INTEGER) AS DaysSinceLastVisit,
       CAST(sum(CASE WHEN OnPauseThisWeek = 1 THEN 1 ELSE 0 END) AS BIGINT) AS WeeksPausedToDate
FROM ({O.sql_attendance(None, AS_OF)}) a WHERE WeekBeginningDate < {O.d(AS_OF)} GROUP BY MembershipID""")
def q_att_features(spark, sf_dir):
    return PR.attendance_features(FX.attendance(spark, sf_dir, None, AS_OF), AS_OF, extended=True)


@register("churn_class_3", lambda: f"SELECT MembershipID, end_date, Churned FROM {O.sql_profile(AS_OF)} p")
def q_churn_class(spark, sf_dir):
    return _profile(spark, sf_dir).select("MembershipID", "end_date", "Churned")


@register("class_distribution", lambda: " UNION ALL ".join(
    f"SELECT {O.q(T)} AS as_of, Churned, count(*) AS n, "
    f"{O.r6('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct FROM {O.sql_profile(T)} p GROUP BY Churned"
    for T in COHORTS))
def q_class_dist(spark, sf_dir):
    from ..operators import report as RP
    out = None
    for T in COHORTS:
        d = RP.class_distribution(_profile(spark, sf_dir, T), "Churned").withColumn("as_of", F.lit(T))
        out = d if out is None else out.unionByName(d)
    return out.select("as_of", "Churned", "n", "pct")


@register("join_profile_snapshot", lambda: O.sql_profile_snapshot(AS_OF) +
          f"SELECT {O.PROFILE_SQL_COLS}, member_id, {O.r6('ews_pct')} AS ews_pct, risk_band FROM ps")
def q_profile_snapshot(spark, sf_dir):
    return _profile_snapshot(spark, sf_dir)


@register("normalize_member_key", lambda: f"SELECT MembershipID, lower(trim(MembershipID)) AS member_id FROM "
          f"{O.sql_profile(AS_OF)} p")
def q_norm_key(spark, sf_dir):
    from ..functions.columns import normalize_key
    return _profile(spark, sf_dir).select("MembershipID", normalize_key(F.col("MembershipID")).alias("member_id"))


def _engineered(spark, sf_dir):
    return EN.engineer_features(_profile_snapshot(spark, sf_dir, payment_amount=True), payment_col="RegularPaymentAmount")


def _eng_sql(cols: list[str]):
    def sql():
        sel = ", ".join(O.r6(c) + f" AS {c}" if c in ENG_DOUBLES else c for c in cols)
        return (O.sql_profile_snapshot(AS_OF, payment_amount=True) + ", eng AS (" +
                O.sql_engineered("ps", "RegularPaymentAmount") + f") SELECT MembershipID, {sel} FROM eng")
    return sql


ENG_DOUBLES = {"Engagement_Rate", "Recent_Activity_Ratio", "Monthly_Avg_Visits", "Payment_to_Attendance_Ratio",
               "Recent_Payment_to_Visits", "Inactivity_Ratio", "Access_Gap_Months"}


def _eng_query(key, cols):
    register(key, _eng_sql(cols))(lambda spark, sf_dir: _engineered(spark, sf_dir).select("MembershipID", *cols))


_eng_query("engineered_features", EN.ENGINEERED)
_eng_query("engineered_engagement_rate", ["Engagement_Rate"])
_eng_query("engineered_recent_activity_ratio", ["Recent_Activity_Ratio"])
_eng_query("engineered_declining", ["Declining_Engagement"])
_eng_query("engineered_monthly_avg", ["Monthly_Avg_Visits"])
_eng_query("engineered_payment_to_attendance", ["Payment_to_Attendance_Ratio"])
_eng_query("engineered_recent_payment_to_visits", ["Recent_Payment_to_Visits"])
_eng_query("tenure_quartile", ["Tenure_Quartile"])
_eng_query("engineered_early_risk", ["Early_Churn_Risk"])
_eng_query("engineered_inactivity_ratio", ["Inactivity_Ratio"])
_eng_query("engineered_attendance_dropoff", ["Attendance_Dropoff"])
_eng_query("engineered_access_gap_months", ["Access_Gap_Months"])
_eng_query("engineered_high_inactivity", ["High_Inactivity"])


# --- evaluation ----------------------------------------------------------------

def _matrix(spark, sf_dir):
    """Snapshot and churn input come from one labelled panel, materialised once."""
    from ..session import cut_lineage
    panel = cut_lineage(_panel_flags(spark, sf_dir, labels=True))
    feats = WK.member_features(panel.drop("end_month_bucket", "churn_flag"))
    snap = SN.relabel_snapshot(SN.build_snapshots(SN.score_frame(WK.surrogate_ews(feats))))
    churned = panel.select("member_id", "week", "paused", "end_month_bucket", "churn_flag")
    return EV.band_month_matrix(snap, churned)


_MX_DOUBLES = [EV.month_label(m) for m in EV.MONTHS] + ["pct_Churned"]


@register("job_evaluate", lambda: O.sql_eval_ctes(AS_OF) + "SELECT * FROM mx")
def q_evaluate(spark, sf_dir):
    return _matrix(spark, sf_dir)


@register("band_month_pivot", lambda: O.sql_eval_ctes(AS_OF) +
          "SELECT risk_band, " + ", ".join(f"m{m}" for m in EV.MONTHS) + " FROM mx")
def q_pivot(spark, sf_dir):
    return _matrix(spark, sf_dir).select("risk_band", *[f"m{m}" for m in EV.MONTHS])


@register("band_null_count", lambda: O.sql_eval_ctes(AS_OF) + "SELECT risk_band, null_bucket FROM mx")
def q_null_count(spark, sf_dir):
    return _matrix(spark, sf_dir).select("risk_band", "null_bucket")


@register("band_totals", lambda: O.sql_eval_ctes(AS_OF) +
          "SELECT risk_band, Total_Members, Total_Churned, Total_Not_Churned, Total_Churned_And_Not FROM mx")
def q_totals(spark, sf_dir):
    return _matrix(spark, sf_dir).select("risk_band", "Total_Members", "Total_Churned", "Total_Not_Churned",
                                         "Total_Churned_And_Not")


@register("band_pct", lambda: O.sql_eval_ctes(AS_OF) + "SELECT risk_band, " + ", ".join(_MX_DOUBLES) + " FROM mx")
def q_band_pct(spark, sf_dir):
    return _matrix(spark, sf_dir).select("risk_band", *_MX_DOUBLES)


@register("churn_per_member", lambda: O.sql_eval_ctes(AS_OF) + "SELECT * FROM churn1")
def q_churn_per_member(spark, sf_dir):
    churned = _panel_flags(spark, sf_dir, labels=True)
    return EV.churn_per_member(churned)


@register("join_snapshot_churn", lambda: O.sql_eval_ctes(AS_OF) + "SELECT member_id, risk_band, b AS end_month_bucket, "
          "churn_flag FROM merged")
def q_snap_churn(spark, sf_dir):
    churned = _panel_flags(spark, sf_dir, labels=True)
    snap = EV.snapshot_latest_band(_snapshot(spark, sf_dir, relabel=True))
    return (snap.join(EV.churn_per_member(churned), "member_id", "left")
            .withColumn("churn_flag", F.coalesce(F.col("churn_flag"), F.lit(0)).cast("int"))
            .where(F.col("risk_band").isin(C.BAND_ORDER))
            .select("member_id", "risk_band", "end_month_bucket", "churn_flag"))


@register("latest_per_member", lambda: O.sql_eval_ctes(AS_OF) + "SELECT * FROM snapl")
def q_latest(spark, sf_dir):
    return EV.snapshot_latest_band(_snapshot(spark, sf_dir, relabel=True))


# --- thresholds, reports -------------------------------------------------------

from ..operators import cohorts as CO  # noqa: E402
from ..operators import report as RP  # noqa: E402
from ..operators import thresholds as TH  # noqa: E402

TUNE = dict(metric="recall", min_recall=0.65, min_precision=0.50)
FIXED_THRESHOLDS = {0: 0.40, 1: 0.35}


def _probs(spark, sf_dir, T=AS_OF):
    prof = _profile(spark, sf_dir, T)
    labels = prof.select("MembershipID", (F.col("Churned") - 1).alias("y"))
    return FX.pseudo_probabilities(spark, sf_dir, labels)


def _pcols():
    return [F.col("p0"), F.col("p1"), F.col("p2")]


@register("threshold_search", lambda: O.sql_threshold_ctes(AS_OF, **TUNE) +
          f"SELECT cls, {O.r6('threshold')} AS threshold, {O.r6('score')} AS score FROM thr")
def q_threshold_search(spark, sf_dir):
    return TH.threshold_search(_probs(spark, sf_dir), **TUNE)


@register("threshold_curve", lambda: O.sql_threshold_ctes(AS_OF, **TUNE) +
          f"SELECT cls, j, {O.r6('threshold')} AS threshold, tp, predicted, {O.r6('precision')} AS precision, "
          f"{O.r6('recall')} AS recall, {O.r6('f1')} AS f1, {O.r6('score')} AS score, valid FROM scored")
def q_threshold_curve(spark, sf_dir):
    return TH.threshold_curve(_probs(spark, sf_dir), **TUNE)


@register("apply_thresholds", lambda: f"SELECT MembershipID, y, "
          f"{O.sql_apply(str(FIXED_THRESHOLDS[0]), str(FIXED_THRESHOLDS[1]), '0.0')} AS pred FROM {O.sql_probs(AS_OF)} x")
def q_apply(spark, sf_dir):
    p = _probs(spark, sf_dir)
    return p.select("MembershipID", "y", TH.apply_thresholds(_pcols(), FIXED_THRESHOLDS).alias("pred"))


@register("threshold_grid_joint", lambda: O.sql_grid_joint(AS_OF))
def q_grid(spark, sf_dir):
    return TH.threshold_grid_joint(_probs(spark, sf_dir))


def _tuned_pairs(spark, sf_dir):
    # tuned on and applied to the same rows: materialise them once
    from ..session import cut_lineage
    p = cut_lineage(_probs(spark, sf_dir))
    th = TH.thresholds_to_dict(TH.threshold_search(p, **TUNE))
    return p.select("MembershipID", "y", TH.argmax_class(_pcols()).alias("pred_before"),
                    TH.apply_thresholds(_pcols(), th).alias("pred"))


def _report_sql(pred_expr: str, tuned: bool):
    head = (O.sql_threshold_ctes(AS_OF, **TUNE) + ", ") if tuned else "WITH "
    return (head + f"pairs AS (SELECT y, {pred_expr} AS pred FROM {O.sql_probs(AS_OF)} x), "
            + O.sql_report("pairs"))


_ARGMAX_SQL = "CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END"


@register("confusion_matrix", lambda: _report_sql(O.sql_tuned_pred(), True) +
          "SELECT y, " + ", ".join(f"CAST(sum(CASE WHEN pred = {c} THEN 1 ELSE 0 END) AS BIGINT) AS pred_{c}"
                                   for c in range(3)) + " FROM pairs GROUP BY y")
def q_confusion(spark, sf_dir):
    return RP.confusion_matrix(_tuned_pairs(spark, sf_dir), "y", "pred")


_REP_SEL = (f"SELECT label, {O.r6('precision')} AS precision, {O.r6('recall')} AS recall, {O.r6('f1')} AS f1, "
            "support FROM rep")


@register("classification_report", lambda: _report_sql(O.sql_tuned_pred(), True) + _REP_SEL)
def q_report(spark, sf_dir):
    return RP.classification_report(_tuned_pairs(spark, sf_dir), "y", "pred")


@register("balanced_accuracy", lambda: _report_sql(_ARGMAX_SQL, False) +
          f"SELECT {O.r6('avg(recall)')} AS balanced_accuracy FROM rep_c")
def q_bal_acc(spark, sf_dir):
    return RP.balanced_accuracy(_tuned_pairs(spark, sf_dir), "y", "pred_before")


@register("before_after_recall", lambda: O.sql_threshold_ctes(AS_OF, **TUNE) + f""",
pairs AS (SELECT y, {_ARGMAX_SQL} AS pb, {O.sql_tuned_pred()} AS pa FROM {O.sql_probs(AS_OF)} x)
SELECT c.cls, {O.r6('sum(CASE WHEN y = c.cls AND pb = c.cls THEN 1 ELSE 0 END) * 1.0 / sum(CASE WHEN y = c.cls THEN 1 ELSE 0 END)')} AS recall_before,
       {O.r6('sum(CASE WHEN y = c.cls AND pa = c.cls THEN 1 ELSE 0 END) * 1.0 / sum(CASE WHEN y = c.cls THEN 1 ELSE 0 END)')} AS recall_after
FROM pairs, (VALUES (0), (1)) c(cls) GROUP BY c.cls""")
def q_before_after(spark, sf_dir):
    pairs = _tuned_pairs(spark, sf_dir)
    before = RP.classification_report(pairs, "y", "pred_before").select(F.col("label"), F.col("recall").alias("recall_before"))
    after = RP.classification_report(pairs, "y", "pred").select(F.col("label"), F.col("recall").alias("recall_after"))
    return (before.join(after, "label").where(F.col("label").isin("0", "1"))
            .select(F.col("label").cast("int").alias("cls"), "recall_before", "recall_after"))


@register("auc_ovr_macro", lambda: f"""
WITH pr AS (SELECT * FROM {O.sql_probs(AS_OF)} x),
""" + ",\n".join(f"""r{c} AS (SELECT CAST(y = {c} AS INTEGER) AS lab, rank() OVER (ORDER BY p{c}) + (count(*) OVER (PARTITION BY p{c}) - 1) / 2.0 AS ar FROM pr),
a{c} AS (SELECT (sum(CASE WHEN lab = 1 THEN ar ELSE 0 END) - sum(lab) * (sum(lab) + 1) / 2.0) / (sum(lab) * 1.0 * (count(*) - sum(lab))) AS auc FROM r{c})"""
                 for c in range(3)) + f"\nSELECT {O.r6('(a0.auc + a1.auc + a2.auc) / 3.0')} AS auc_ovr_macro FROM a0, a1, a2")
def q_auc_ovr(spark, sf_dir):
    p = _probs(spark, sf_dir)
    aucs = [RK.auc_binary(p.select(F.col(f"p{c}").alias("s"), (F.col("y") == c).cast("int").alias("lab")), "s", "lab")
            .withColumnRenamed("auc", f"a{c}") for c in range(3)]
    # three one-row results: combine positionally through a constant key
    out = aucs[0].withColumn("_k", F.lit(1))
    for a in aucs[1:]:
        out = out.join(a.withColumn("_k", F.lit(1)), "_k")
    return out.select(((F.col("a0") + F.col("a1") + F.col("a2")) / 3.0).alias("auc_ovr_macro"))


@register("confidence", lambda: f"SELECT MembershipID, {O.r6('greatest(p0, p1, p2)')} AS Confidence, "
          f"CASE {_ARGMAX_SQL} " + " ".join(f"WHEN {c} THEN {O.q(v)}" for c, v in C.CLASS_LABELS.items()) +
          f" END AS ClassLabel FROM {O.sql_probs(AS_OF)} x")
def q_confidence(spark, sf_dir):
    from ..operators import predict as PD
    p = _probs(spark, sf_dir)
    pred = TH.argmax_class(_pcols())
    return p.select("MembershipID", PD.confidence(_pcols()).alias("Confidence"), PD.class_label(pred).alias("ClassLabel"))


@register("prediction_distribution", lambda: f"SELECT pred AS PredictedClass, count(*) AS n, "
          f"{O.r6('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct FROM (SELECT "
          f"{O.sql_apply(str(FIXED_THRESHOLDS[0]), str(FIXED_THRESHOLDS[1]), '0.0')} AS pred FROM {O.sql_probs(AS_OF)} x) t "
          "GROUP BY pred")
def q_pred_dist(spark, sf_dir):
    p = _probs(spark, sf_dir).select(TH.apply_thresholds(_pcols(), FIXED_THRESHOLDS).alias("PredictedClass"))
    return RP.prediction_distribution(p, "PredictedClass")


@register("null_profile", lambda: " UNION ALL ".join(
    f"SELECT {O.q(c)} AS \"column\", {O.r6(f'avg(CASE WHEN {cq} IS NULL THEN 1.0 ELSE 0.0 END) * 100.0')} AS null_pct "
    f"FROM {O.sql_profile(AS_OF)} p HAVING avg(CASE WHEN {cq} IS NULL THEN 1.0 ELSE 0.0 END) > 0"
    for c, cq in [(c, f'"{c}"') for c in PR.PROFILE_COLUMNS]))
def q_null_profile(spark, sf_dir):
    return RP.null_profile(_profile(spark, sf_dir))


# --- prediction path, sinks ------------------------------------------------------

from ..operators import predict as PD  # noqa: E402
from ..sources import io as IO  # noqa: E402
from ..sources import sinks as SK  # noqa: E402

T0, T1 = FIXED_THRESHOLDS[0], FIXED_THRESHOLDS[1]


def _features_for_predict(spark, sf_dir):
    return _profile_snapshot(spark, sf_dir, payment_amount=True).drop("Churned")


def _predictions(spark, sf_dir):
    return PD.predictions_frame(_probs(spark, sf_dir), FIXED_THRESHOLDS)


def _predict_job(spark, sf_dir):
    merged = PD.join_predictions_features(_features_for_predict(spark, sf_dir), _predictions(spark, sf_dir))
    eng = EN.engineer_features(merged, payment_col="RegularPaymentAmount")
    return PD.map_to_sink_schema(eng, run_date=AS_OF)


@register("predict_proba", lambda: f"SELECT MembershipID, {O.r6('p0')} AS Class0_Prob, {O.r6('p1')} AS Class1_Prob, "
          f"{O.r6('p2')} AS Class2_Prob, {O.sql_apply(str(T0), str(T1), '0.0')} AS PredictedClass, "
          f"{O.r6('greatest(p0, p1, p2)')} AS Confidence, CASE {O.sql_apply(str(T0), str(T1), '0.0')} "
          + " ".join(f"WHEN {c} THEN {O.q(v)}" for c, v in C.CLASS_LABELS.items()) +
          f" END AS ClassLabel FROM {O.sql_probs(AS_OF)} x")
def q_predict_proba(spark, sf_dir):
    return _predictions(spark, sf_dir)


@register("join_predictions_features", lambda: O.sql_predict_ctes(AS_OF, T0, T1) +
          f"SELECT MembershipID, member_id, PredictedClass, {O.r6('Confidence')} AS Confidence FROM feat")
def q_join_pred(spark, sf_dir):
    merged = PD.join_predictions_features(_features_for_predict(spark, sf_dir), _predictions(spark, sf_dir))
    return merged.select("MembershipID", "member_id", "PredictedClass", "Confidence")


@register("match_counts", lambda: O.sql_predict_ctes(AS_OF, T0, T1) +
          "SELECT count(*) AS rows, count(*) FILTER (WHERE CAST(substr(trim(MembershipID), 2) AS BIGINT) % 10 <> 0) AS with_prediction, "
          "count(*) FILTER (WHERE CAST(substr(trim(MembershipID), 2) AS BIGINT) % 10 = 0) AS missing_prediction FROM feat")
def q_match_counts(spark, sf_dir):
    """Rows of the feature join with and without a prediction, when every tenth lacks one."""
    some = _predictions(spark, sf_dir).where(F.substring(F.trim("MembershipID"), 2, 20).cast("long") % 10 != 0)
    return PD.match_counts(PD.join_predictions_features(_features_for_predict(spark, sf_dir), some))


@register("job_predict", lambda: O.sql_predict_ctes(AS_OF, T0, T1) + O.sql_sink_select(AS_OF))
def q_job_predict(spark, sf_dir):
    return _predict_job(spark, sf_dir)


@register("map_to_sink_schema", lambda: O.sql_predict_ctes(AS_OF, T0, T1) + O.sql_sink_select(AS_OF))
def q_sink_schema(spark, sf_dir):
    return _predict_job(spark, sf_dir)


def _saved(spark, sf_dir):
    feats = _profile_snapshot(spark, sf_dir).drop("Churned")
    return PD.saved_predictions(feats, _predictions(spark, sf_dir), AS_OF)


_SAVED_SEL = ("SELECT MembershipID, ChurnedPrediction, EndDate, RunDate, Gender, Age, SubCategory, Channel, ClubName, "
              'MembershipTypeDesc, RegularPayment, "Base Amount", Term, TermDays, "Lump Sum Flag", DaysSinceLastAccessed, '
              "TenureDays, DaysSinceOriginalStart, TotalAttendanceToDate, Visits_Last30d, Visits_Last90d, "
              f"EndedWithinCoolingPeriod, member_id, {O.r6('ews_pct')} AS ews_pct, risk_band FROM saved")


@register("reorder_key_first", lambda: O.sql_saved_predictions(AS_OF, T0, T1) + _SAVED_SEL)
def q_saved(spark, sf_dir):
    return _saved(spark, sf_dir)


@register("add_run_date", lambda: O.sql_saved_predictions(AS_OF, T0, T1) + "SELECT MembershipID, RunDate FROM saved")
def q_run_date(spark, sf_dir):
    return _saved(spark, sf_dir).select("MembershipID", "RunDate")


@register("rename_end_date", lambda: O.sql_saved_predictions(AS_OF, T0, T1) + "SELECT MembershipID, EndDate FROM saved")
def q_end_date(spark, sf_dir):
    return _saved(spark, sf_dir).select("MembershipID", "EndDate")


def _campaign_sql(name):
    body = {
        "high_risk": f"SELECT MembershipID, EndDate, {O.r6('ews_pct')} AS ews_pct, risk_band FROM saved WHERE ChurnedPrediction = 0",
        "validation": "SELECT MembershipID, ChurnedPrediction, EndDate, CASE "
                      f"WHEN EndDate > RunDate AND EndDate <= {O.add_months('RunDate', 3)} THEN 'Actual_Churn_0-3mo' "
                      f"WHEN EndDate > {O.add_months('RunDate', 3)} AND EndDate <= {O.add_months('RunDate', 6)} "
                      "THEN 'Actual_Churn_3-6mo' ELSE 'No_Churn_Or_Later' END AS ActualChurn FROM saved",
        "high_ews_low_band": f"SELECT MembershipID, {O.r6('ews_pct')} AS ews_pct, risk_band, ChurnedPrediction FROM saved "
                             "WHERE ews_pct > 0.8 AND risk_band = 'Low' ORDER BY ews_pct DESC, MembershipID LIMIT 10",
        "export": f"SELECT MembershipID, Gender, Age, ClubName, {O.r6('ews_pct')} AS ews_pct FROM saved "
                  "WHERE ChurnedPrediction IN (0, 1)",
    }[name]
    return lambda: O.sql_saved_predictions(AS_OF, T0, T1) + body


for _name in PD.CAMPAIGNS:
    register(f"campaign_{_name}", _campaign_sql(_name))(
        (lambda n: lambda spark, sf_dir: PD.campaign_query(_saved(spark, sf_dir), n))(_name))


def _scratch(spark, name):
    import uuid
    return IO.shared_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")


@register("sink_upsert_by_rundate", lambda: O.sql_predict_ctes(AS_OF, T0, T1) +
          f"SELECT RunDate, count(*) AS n FROM ({O.sql_sink_select(AS_OF)}) s GROUP BY RunDate")
def q_sink(spark, sf_dir):
    """Publishes the prediction table twice for the same RunDate and reads it back:
    the second run replaces the first (row count per RunDate unchanged)."""
    path = _scratch(spark, "predictions")
    df = _predict_job(spark, sf_dir)
    SK.sink_upsert_by_rundate(df, path, AS_OF)
    SK.sink_upsert_by_rundate(df, path, AS_OF)
    back = SK.read_sink(spark, path)
    return back.groupBy("RunDate").agg(F.count(F.lit(1)).alias("n"))


@register("insert_summary", lambda: O.sql_predict_ctes(AS_OF, T0, T1) +
          f"SELECT count(*) AS inserted, count(*) AS total, CAST(0 AS BIGINT) AS failed, 38 AS columns "
          f"FROM ({O.sql_sink_select(AS_OF)}) s")
def q_insert_summary(spark, sf_dir):
    """Counts of a publish, observed while it writes."""
    return SK.publish(_predict_job(spark, sf_dir), _scratch(spark, "predictions"), AS_OF)


_SNAP_CSV_SCHEMA = "member_id string, week date, risk_band string"


@register("read_csv_typed", lambda: O.sql_snapshot(AS_OF, relabel=True) + "SELECT member_id, week, risk_band FROM snap")
def q_read_csv(spark, sf_dir):
    """Snapshot written as CSV (header) and scanned with a declared schema."""
    path = _scratch(spark, "snapshot-csv")
    IO.write_csv(_snapshot(spark, sf_dir, relabel=True).select("member_id", "week", "risk_band"), path)
    return TY.scan_csv(spark, path, StructType.fromDDL(_SNAP_CSV_SCHEMA)).good


@register("write_csv_predictions", lambda: O.sql_saved_predictions(AS_OF, T0, T1) +
          "SELECT MembershipID, ChurnedPrediction, EndDate, RunDate FROM saved")
def q_write_csv_pred(spark, sf_dir):
    path = _scratch(spark, "predictions-csv")
    IO.write_csv(_saved(spark, sf_dir), path)
    return IO.read_csv_typed(spark, path, "MembershipID string, ChurnedPrediction int, EndDate date, RunDate date") \
        .select("MembershipID", "ChurnedPrediction", "EndDate", "RunDate")


@register("write_parquet", lambda: O.sql_profile_snapshot(AS_OF) +
          f"SELECT {O.PROFILE_SQL_COLS}, member_id, {O.r6('ews_pct')} AS ews_pct, risk_band, "
          f"{O.d(AS_OF)} AS as_of FROM ps")
def q_write_parquet(spark, sf_dir):
    """Staged cohort written partitioned by as_of (dynamic overwrite) and read back."""
    path = _scratch(spark, "cohort")
    IO.write_parquet(_profile_snapshot(spark, sf_dir).withColumn("as_of", F.lit(AS_OF).cast("date")), path, ["as_of"])
    return IO.read_parquet(spark, path)


@register("read_parquet", lambda: f"SELECT * FROM ({O.sql_memberships(AS_OF)}) m")
def q_read_parquet(spark, sf_dir):
    path = _scratch(spark, "memberships")
    IO.write_parquet(FX.memberships(spark, sf_dir, AS_OF), path)
    return IO.read_parquet(spark, path)


@register("latest_artifact", lambda: O.sql_profile_snapshot(AS_OF) +
          f"SELECT {O.d(AS_OF)} AS as_of, count(*) AS n FROM ps")
def q_latest_artifact(spark, sf_dir):
    """Two staged cohorts; the one written last is found by file time and read alone."""
    path = _scratch(spark, "staged")
    prof = _profile_snapshot(spark, sf_dir)
    IO.write_parquet(prof.select("MembershipID").withColumn("as_of", F.lit("2002-01-01").cast("date")), path, ["as_of"])
    IO.write_parquet(prof.withColumn("as_of", F.lit(AS_OF).cast("date")), path, ["as_of"])
    return IO.read_latest(spark, path).agg(F.max("as_of").alias("as_of"), F.count(F.lit(1)).alias("n"))


# --- cohorts, training-set operators -------------------------------------------

from ..operators import ml as ML  # noqa: E402

COHORT_CLASSES = {"1999-01-01": (1, 2), "2000-01-01": (1, 2), "2001-01-01": (1, 2)}
SAMPLE_TEST_N = 100


def _cohort(spark, sf_dir, T, classes=None):
    m = FX.memberships(spark, sf_dir, T)
    panel = WK.weekly_panel(m, FX.attendance(spark, sf_dir, O.prev_year(T), T), T)
    snap = SN.relabel_snapshot(SN.build_snapshots(SN.score_frame(WK.surrogate_ews(WK.member_features(panel)))))
    prof = PR.profile(m, FX.attendance(spark, sf_dir, None, T, nonempty_only=True), T)
    out = PR.join_profile_snapshot(prof, snap)
    return out.where(F.col("Churned").isin(list(classes))) if classes else out


def _balanced(spark, sf_dir, n3=C.CLASS3_SAMPLE):
    from .jobs import cohorts_inputs, job_balanced, job_prepare_cohorts
    dates = list(COHORT_CLASSES)
    return job_balanced(job_prepare_cohorts(*cohorts_inputs(spark, sf_dir, dates), dates), sample_n=n3)


def _union_sql():
    parts = [f"SELECT *, {O.q(T)} AS cohort FROM ({O.sql_cohort(T, cls)}) c" for T, cls in COHORT_CLASSES.items()]
    last = COHORTS[-1]
    parts.append(f"SELECT *, {O.q(last)} AS cohort FROM ({O.sql_sample_exact(O.sql_cohort(last, (3,)), C.CLASS3_SAMPLE)}) c3")
    return " UNION ALL ".join(parts)


@register("filter_churn_classes", lambda: O.sql_cohort("1999-01-01", (1, 2)))
def q_filter_classes(spark, sf_dir):
    return _cohort(spark, sf_dir, "1999-01-01", (1, 2))


@register("union_cohorts", _union_sql)
def q_union(spark, sf_dir):
    return _balanced(spark, sf_dir)


@register("job_merge_balanced", lambda: f"SELECT cohort, Churned, count(*) AS n FROM ({_union_sql()}) u GROUP BY cohort, Churned")
def q_merge_balanced(spark, sf_dir):
    return _balanced(spark, sf_dir).groupBy("cohort", "Churned").agg(F.count(F.lit(1)).alias("n"))


@register("job_prepare_cohorts", lambda: " UNION ALL ".join(f"SELECT *, {O.d(T)} AS as_of FROM ({O.sql_cohort(T)}) c" for T in COHORT_CLASSES))
def q_prepare_cohorts(spark, sf_dir):
    """All yearly cohorts from one pass over the attendance."""
    from .jobs import cohorts_inputs, job_prepare_cohorts
    dates = list(COHORT_CLASSES)
    return job_prepare_cohorts(*cohorts_inputs(spark, sf_dir, dates), dates)


@register("job_prepare_cohort", lambda: O.sql_cohort(AS_OF))
def q_prepare_cohort(spark, sf_dir):
    from .jobs import cohort_inputs, job_prepare_cohort
    m, att_all, att_year = cohort_inputs(spark, sf_dir, AS_OF)
    return job_prepare_cohort(m, att_all, AS_OF, attendance_year=att_year)


@register("sample_exact_n", lambda: O.sql_sample_exact(O.sql_cohort(AS_OF, (3,)), SAMPLE_TEST_N))
def q_sample(spark, sf_dir):
    return CO.sample_exact_n(_cohort(spark, sf_dir, AS_OF, (3,)), SAMPLE_TEST_N, "MembershipID")


@register("stratified_folds", lambda: f"SELECT MembershipID, Churned, CAST((row_number() OVER (PARTITION BY Churned "
          f"ORDER BY {O.sql_hash('MembershipID')}) - 1) % 5 AS INTEGER) AS fold FROM ({O.sql_cohort(AS_OF)}) c")
def q_folds(spark, sf_dir):
    return CO.stratified_folds(_cohort(spark, sf_dir, AS_OF), "Churned", "MembershipID").select(
        "MembershipID", "Churned", "fold")


@register("random_split", lambda: f"SELECT MembershipID, {O.sql_hash('MembershipID')} % 100 < 20 AS is_test "
          f"FROM {O.sql_profile(AS_OF)} p")
def q_random_split(spark, sf_dir):
    return CO.hash_split(_profile(spark, sf_dir), F.col("MembershipID")).select("MembershipID", "is_test")


@register("group_split", lambda: O.sql_features(AS_OF) +
          f"SELECT member_id, week, {O.sql_hash('member_id')} % 100 < 20 AS is_test FROM f")
def q_group_split(spark, sf_dir):
    return CO.hash_split(_features(spark, sf_dir), F.col("member_id")).select("member_id", "week", "is_test")


def _ews_ds(spark, sf_dir):
    return ML.build_ews_dataset(WK.future_k_label(_features(spark, sf_dir)))


_EWS_SQL_COLS = ", ".join(f"{O.r6(f'coalesce(CAST({c} AS DOUBLE), 0.0)')} AS {c}" for c in WK.EWS_FEATURES)


@register("build_ews_dataset", lambda: O.sql_features(AS_OF) +
          f"SELECT member_id, week, engagement, {_EWS_SQL_COLS}, {O.sql_future_label()} AS label FROM f")
def q_ews_ds(spark, sf_dir):
    return _ews_ds(spark, sf_dir)


@register("pos_weight", lambda: O.sql_features(AS_OF) + f""",
lab AS (SELECT member_id, {O.sql_future_label()} AS y FROM f)
SELECT {O.r6('greatest(1.0, (count(*) - sum(y)) / (sum(y) + 1e-6))')} AS pos_weight FROM lab
WHERE NOT ({O.sql_hash('member_id')} % 100 < 20)""")
def q_pos_weight(spark, sf_dir):
    ds = CO.hash_split(_ews_ds(spark, sf_dir), F.col("member_id"))
    return ML.pos_weight(ds.where(~F.col("is_test")))


@register("class_weights", lambda: "SELECT MembershipID, Churned - 1 AS label, CASE " +
          " ".join(f"WHEN Churned - 1 = {k} THEN CAST({float(v)} AS DOUBLE)" for k, v in C.CLASS_WEIGHTS.items()) +
          f" ELSE CAST(1.0 AS DOUBLE) END AS w FROM {O.sql_profile(AS_OF)} p")
def q_class_weights(spark, sf_dir):
    from ..operators.predict import label_encode
    p = _profile(spark, sf_dir).select("MembershipID", label_encode(F.col("Churned")).alias("label"))
    return p.withColumn("w", ML.class_weight_col("label"))


@register("label_encode", lambda: f"SELECT MembershipID, Churned, CAST(Churned - 1 AS INTEGER) AS label "
          f"FROM {O.sql_profile(AS_OF)} p")
def q_label_encode(spark, sf_dir):
    from ..operators.predict import label_encode
    return _profile(spark, sf_dir).select("MembershipID", "Churned", label_encode(F.col("Churned")).alias("label"))


def _leakage_sql():
    h = f"{O.sql_hash('MembershipID')} % 100"
    one = (f"SELECT '{{}}' AS split, {{}} AS target_in_features, CAST(0 AS BIGINT) AS duplicate_columns, "
           f"count(*) FILTER (WHERE {{}}) AS train_test_overlap FROM {O.sql_profile(AS_OF)} p")
    return one.format("by member", "false", f"{h} < 20 AND NOT ({h} < 20)") + " UNION ALL " + one.format("with an overlap", "true", f"{h} >= 20 AND {h} < 25")


@register("leakage_check", _leakage_sql)
def q_leakage(spark, sf_dir):
    """The split by member, and one whose test part also holds some training members and
    whose target was not dropped."""
    df = CO.hash_split(_profile(spark, sf_dir), F.col("MembershipID"))
    train, test = df.where(~F.col("is_test")).drop("is_test"), df.where(F.col("is_test")).drop("is_test")
    some = train.where(CO.stable_hash(F.col("MembershipID")) % 100 < 25)
    checks = {"by member": (train.drop("Churned"), test.drop("Churned")), "with an overlap": (train, test.unionByName(some))}
    out = None
    for name, (a, b) in checks.items():
        row = CO.leakage_check(a, b, "MembershipID", "Churned").select(F.lit(name).alias("split"), "*")
        out = row if out is None else out.unionByName(row)
    return out


_DROPPED_SQL = ("Gender, Age, SubCategory, Channel, ClubName, MembershipTypeDesc, RegularPayment, \"Base Amount\", Term, "
                "TermDays, \"Lump Sum Flag\", DaysSinceLastAccessed, TenureDays, DaysSinceOriginalStart, "
                "TotalAttendanceToDate, Visits_Last30d, Visits_Last90d, EndedWithinCoolingPeriod, Churned, "
                "LastVisitDate")


@register("drop_columns_if_present", lambda: f"""SELECT {_DROPPED_SQL} FROM (
SELECT p.*, a.LastVisitDate FROM {O.sql_profile(AS_OF)} p JOIN (SELECT MembershipID, max(WeekBeginningDate) AS LastVisitDate
FROM ({O.sql_attendance(None, AS_OF)}) a0 WHERE WeekBeginningDate < {O.d(AS_OF)} GROUP BY MembershipID) a
ON p.MembershipID = a.MembershipID) x""")
def q_drop_cols(spark, sf_dir):
    return ML.drop_columns_if_present(_profile(spark, sf_dir, extended=True))


_ENSURED = ", ".join(f'"{c}"' if c in {"Base Amount", "Lump Sum Flag"} else c for c in ML.MODEL_FEATURES)


@register("ensure_columns", lambda: O.sql_profile_snapshot(AS_OF) + "SELECT MembershipID, " + ", ".join(
    (f'{O.r6(c)} AS {c}' if c == "ews_pct" else (f'"{c}"' if " " in c else c)) if c in set(PR.PROFILE_COLUMNS) | {"ews_pct", "risk_band"}
    else f'0 AS "{c}"' for c in ML.MODEL_FEATURES) + " FROM ps")
def q_ensure(spark, sf_dir):
    df = ML.ensure_columns(_profile_snapshot(spark, sf_dir))
    return df.select("MembershipID", *[F.col(f"`{c}`") for c in ML.MODEL_FEATURES])


_NUMERIC_PROFILE = ["Age", "TermDays", "Lump Sum Flag", "DaysSinceLastAccessed", "TenureDays", "DaysSinceOriginalStart",
                    "TotalAttendanceToDate", "Visits_Last30d", "Visits_Last90d", "EndedWithinCoolingPeriod", "ews_pct"]
_CATEGORICAL_PROFILE = ["Gender", "SubCategory", "Channel", "ClubName", "MembershipTypeDesc", "RegularPayment",
                        "Base Amount", "Term", "risk_band"]


@register("impute_numeric_median", lambda: O.sql_profile_snapshot(AS_OF) + " UNION ALL ".join(
    f"SELECT {O.q(c)} AS \"column\", {O.r6(f'quantile_cont(CAST(\"{c}\" AS DOUBLE), 0.5)')} AS median FROM ps"
    for c in _NUMERIC_PROFILE))
def q_median(spark, sf_dir):
    from ..session import cut_lineage
    med = ML.exact_medians(cut_lineage(_profile_snapshot(spark, sf_dir).select(*[F.col(f"`{c}`") for c in _NUMERIC_PROFILE])),
                           _NUMERIC_PROFILE)
    return spark.createDataFrame([(k, float(v)) for k, v in med.items()], "column string, median double")


@register("impute_categorical_mode", lambda: O.sql_profile_snapshot(AS_OF) + " UNION ALL ".join(
    f"SELECT * FROM (SELECT {O.q(c)} AS \"column\", CAST(\"{c}\" AS VARCHAR) AS mode FROM ps WHERE \"{c}\" IS NOT NULL "
    f"GROUP BY \"{c}\" ORDER BY count(*) DESC, CAST(\"{c}\" AS VARCHAR) ASC LIMIT 1) m{i}"
    for i, c in enumerate(_CATEGORICAL_PROFILE)))
def q_mode(spark, sf_dir):
    mod = ML.modes(_profile_snapshot(spark, sf_dir), _CATEGORICAL_PROFILE)
    return spark.createDataFrame(list(mod.items()), "column string, mode string")


@register("standardize", lambda: O.sql_profile(AS_OF) and (
    f"SELECT MembershipID, {O.r6('(TenureDays - avg(TenureDays) OVER ()) / stddev_pop(TenureDays) OVER ()')} AS TenureDays_z, "
    f"{O.r6('(TotalAttendanceToDate - avg(TotalAttendanceToDate) OVER ()) / stddev_pop(TotalAttendanceToDate) OVER ()')} "
    f"AS TotalAttendanceToDate_z FROM {O.sql_profile(AS_OF)} p"))
def q_standardize(spark, sf_dir):
    from ..operators import scaling
    p = _profile(spark, sf_dir)
    return scaling.standardize(p, ["TenureDays", "TotalAttendanceToDate"]).select(
        "MembershipID", "TenureDays_z", "TotalAttendanceToDate_z")


# --- model training / scoring (rows-only: results depend on the learner) -------------

RF_TREES = C.NUM_TREES[0]


_TRAIN_FRAMES: dict = {}


def _train_frame(spark, sf_dir):
    """Balanced, labelled, split training frame; stored once per session and folder as
    a table in the checkpoint folder and reused by the model queries."""
    key = (id(spark), sf_dir)
    if key not in _TRAIN_FRAMES:
        _TRAIN_FRAMES[key] = _build_train_frame(spark, sf_dir)
    return _TRAIN_FRAMES[key]


def _build_train_frame(spark, sf_dir):
    from ..operators.predict import label_encode
    bal = _balanced(spark, sf_dir).withColumn("label", label_encode(F.col("Churned")))
    bal = bal.withColumn("row_id", F.concat_ws("|", "cohort", "MembershipID"))
    # tree learners and CV scan the frame many times: materialise it once (reliable checkpoint)
    from ..session import cut_lineage
    return cut_lineage(CO.hash_split(bal, F.col("row_id")))


def _feature_lists(df):
    X = ML.drop_columns_if_present(df.drop("Churned", "label", "is_test", "cohort", "row_id", "fold", "w"))
    return ML.select_features(X)


_EWS_MODELS: dict = {}


def _ews_model(spark, sf_dir):
    """The EWS model and its holdout rows, trained once per session and folder."""
    key = (id(spark), sf_dir)
    if key not in _EWS_MODELS:
        _EWS_MODELS[key] = ML.train_ews(_ews_ds(spark, sf_dir))
    return _EWS_MODELS[key]


@register("train_ews")
def q_train_ews(spark, sf_dir):
    model, test = _ews_model(spark, sf_dir)
    scored = ML.score_ews(model, test)
    auc = RK.auc_binary(scored, "EWS", "label").withColumn("_k", F.lit(1))
    ap = RK.average_precision(scored, "EWS", "label").withColumn("_k", F.lit(1))
    return auc.join(ap, "_k").drop("_k")


@register("score_ews")
def q_score_ews(spark, sf_dir):
    model, _ = _ews_model(spark, sf_dir)
    return ML.score_ews(model, _features(spark, sf_dir)).select("member_id", "week", "EWS")


@register("job_snapshots_model")
def q_snap_model(spark, sf_dir):
    from .jobs import job_snapshots
    model, _ = _ews_model(spark, sf_dir)
    return job_snapshots(_panel_flags(spark, sf_dir), model=model)


@register("train_churn_3class")
def q_train_3class(spark, sf_dir):
    df = _train_frame(spark, sf_dir)
    num, cat = _feature_lists(df)
    model = ML.train_churn_3class(df.where(~F.col("is_test")), "label", RF_TREES, 6, numeric=num, categorical=cat)
    return ML.class_probabilities(model, df.where(F.col("is_test"))).select(
        "MembershipID", "cohort", "label", F.col("prediction").cast("int").alias("prediction"), "p0", "p1", "p2")


@register("preprocess_pipeline")
def q_preprocess(spark, sf_dir):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    df = _train_frame(spark, sf_dir)
    num, cat = _feature_lists(df)
    pm = Pipeline(stages=ML.preprocess_stages(df, num, cat)).fit(df)
    return pm.transform(df).select("MembershipID", "cohort", F.size(vector_to_array("features")).alias("n_features"))


@register("one_hot")
def q_one_hot(spark, sf_dir):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    df = _train_frame(spark, sf_dir)
    train, test = df.where(~F.col("is_test")), df.where(F.col("is_test"))
    pm = Pipeline(stages=ML.preprocess_stages(train, [], ["ClubName", "risk_band"], scale=False)).fit(train)
    out = pm.transform(test)
    return out.select("MembershipID", "ClubName", "risk_band",
                      F.aggregate(vector_to_array("__oh_ClubName"), F.lit(0.0), lambda a, x: a + x).alias("club_hot"))


@register("grid_search_cv")
def q_cv(spark, sf_dir):
    df = _train_frame(spark, sf_dir).where(~F.col("is_test"))
    df = CO.stratified_folds(df, "label", "row_id")
    num, cat = _feature_lists(df)
    cv = ML.grid_search_cv(df, "label", "fold", parallelism=4, numeric=num, categorical=cat)
    rows = []
    for pm, m in zip(cv.getEstimatorParamMaps(), cv.avgMetrics):
        d = {p.name: v for p, v in pm.items()}
        rows.append((int(d["numTrees"]), int(d["maxDepth"]), int(d["minInstancesPerNode"]), float(m)))
    return spark.createDataFrame(rows, "numTrees int, maxDepth int, minInstancesPerNode int, cv_weighted_f1 double")


#: Grid of the registered search: the whole one.
SEARCH_GRID = {"numTrees": C.NUM_TREES, "maxDepth": C.MAX_DEPTHS, "learningRate": C.LEARNING_RATES}

_TRAINED: dict = {}


def _train_and_store(spark, sf_dir) -> tuple[dict, str]:
    """The training job, with what it found stored in the shared folder."""
    from .jobs import job_train, store_training
    res, path = job_train(_train_frame(spark, sf_dir), grid=SEARCH_GRID), _scratch(spark, "training")
    store_training(res, path)
    _TRAINED[id(spark), sf_dir] = path
    return res, path


def _stored_training(spark, sf_dir) -> str:
    """Folder of the newest stored training of these tables; trains if there is none."""
    return _TRAINED.get((id(spark), sf_dir)) or _train_and_store(spark, sf_dir)[1]


def _stored_model(spark, sf_dir):
    from pyspark.ml import PipelineModel
    path = _stored_training(spark, sf_dir)
    return PipelineModel.load(f"{path}/model"), TH.thresholds_to_dict(IO.read_parquet(spark, f"{path}/thresholds"))


@register("job_train")
def q_job_train(spark, sf_dir):
    """Search, refit, thresholds and report; everything found is stored."""
    return _train_and_store(spark, sf_dir)[0]["report"]


@register("booster_search")
def q_booster_search(spark, sf_dir):
    """The stored results table of the training job's search, with the winner marked by the
    parameters of the stored model."""
    path = _stored_training(spark, sf_dir)
    booster = _stored_model(spark, sf_dir)[0].stages[-1]
    same = F.lit(True)
    for name in SEARCH_GRID:
        same = same & (F.col(name) == F.lit(booster.getOrDefault(booster.getParam(name))))
    return IO.read_parquet(spark, f"{path}/results").select(*SEARCH_GRID, "cv_weighted_f1", same.alias("is_stored_model"))


@register("model_selection")
def q_model_selection(spark, sf_dir):
    """Test scores of the search's winner, a forest and a logistic model; the best is marked."""
    df = _train_frame(spark, sf_dir)
    num, cat = _feature_lists(df)
    train, test = df.where(~F.col("is_test")), df.where(F.col("is_test"))
    cands = {"booster": _stored_model(spark, sf_dir)[0],
             "random_forest": ML.train_forest(train, "label", RF_TREES, 6, numeric=num, categorical=cat),
             "logistic": ML.train_logistic(train, "label", numeric=num, categorical=cat)}
    scores = {k: float(ML.weighted_f1(m.transform(test), "label")) for k, m in cands.items()}
    best = min(scores, key=lambda k: (-scores[k], k))
    return spark.createDataFrame([(k, v, k == best) for k, v in scores.items()], "model string, test_weighted_f1 double, is_best boolean")


@register("top_features")
def q_top_features(spark, sf_dir):
    return ML.top_features(_stored_model(spark, sf_dir)[0], _train_frame(spark, sf_dir), 5)


@register("save_model")
def q_save_model(spark, sf_dir):
    """Fit one booster, store it with its thresholds, and score the test rows with what was
    stored."""
    from pyspark.ml import PipelineModel
    df = _train_frame(spark, sf_dir)
    num, cat = _feature_lists(df)
    train, test = df.where(~F.col("is_test")), df.where(F.col("is_test"))
    model = ML.train_churn_3class(train, "label", max(SEARCH_GRID["numTrees"]), numeric=num, categorical=cat)
    path, th_path = _scratch(spark, "model"), _scratch(spark, "thresholds")
    model.write().overwrite().save(path)
    IO.write_parquet(TH.threshold_search(ML.class_probabilities(model, test), "label", **TUNE), th_path)
    th = TH.thresholds_to_dict(IO.read_parquet(spark, th_path))
    return PD.predictions_frame(ML.class_probabilities(PipelineModel.load(path), test), th)


@register("batch_score_upload")
def q_upload(spark, sf_dir):
    """Upload CSV (8 columns) -> typed read -> required-column check -> missing features of
    the stored model set to 0 -> score with it -> MembershipID, prediction, confidence."""
    model, _ = _stored_model(spark, sf_dir)
    got = IO.require_columns(_upload(spark, sf_dir), ["MembershipID", "Gender", "Age", "ews_pct"])
    got = got.withColumn("TotalAttendanceToDate", F.col("TotalAttendance"))
    filled = model.stages[0]
    got = ML.ensure_columns(got, filled.getOrDefault(filled.numericCols) + filled.getOrDefault(filled.categoricalCols))
    pr = ML.class_probabilities(model, got)
    return pr.select("MembershipID", F.col("prediction").cast("int").alias("prediction"),
                     PD.confidence([F.col("p0"), F.col("p1"), F.col("p2")]).alias("confidence"))


@register("select_features")
def q_select_features(spark, sf_dir):
    """The model's features by kind, with how many rows hold a value and how many distinct
    values there are: one that never varies is of no use."""
    df = _train_frame(spark, sf_dir)
    num, cat = _feature_lists(df)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(k).alias("kind"), F.col(f"`{c}`").cast("string").alias("v"))
                               for k, cols in (("numeric", num), ("categorical", cat)) for c in cols])).alias("x")
    counts = df.select(each).select("x.*").groupBy("feature", "kind", "v").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("feature", "kind").agg(F.sum(F.when(F.col("v").isNotNull(), F.col("n")).otherwise(0)).alias("filled"),
                                                 F.count("v").alias("distinct_values"))


@register("save_metrics")
def q_save_metrics(spark, sf_dir):
    """The stored metrics document (accuracy, rows, class shares, report) and text report."""
    path = _stored_training(spark, sf_dir)
    doc = spark.read.json(f"{path}/metrics")
    text = spark.read.text(f"{path}/report", wholetext=True).select(
        F.length("value").alias("report_chars"), F.lit(1).alias("_k"))
    one = doc.withColumn("_k", F.lit(1)).join(text, "_k")  # one row each
    return one.select("accuracy", "balanced_accuracy", "test_rows", "report_chars", F.explode("classes").alias("c")).select(
        "accuracy", "balanced_accuracy", "test_rows", "c.label", "c.rows", "c.share", "report_chars")


# --- streaming publish ------------------------------------------------------------------

@register("stream_publish_predictions", lambda: O.sql_predict_ctes(AS_OF, T0, T1) +
          f"SELECT RunDate, count(*) AS n FROM ({O.sql_sink_select(AS_OF)}) s GROUP BY RunDate")
def q_stream_publish(spark, sf_dir):
    """Stage the prediction table as files in two halves, publish each through the streaming
    foreachBatch sink (two micro-batches for the same RunDate), publish the second half once
    more, read the sink back: every member once."""
    from ..streaming import publish_staged_predictions
    df = _predict_job(spark, sf_dir)
    staged, sink = _scratch(spark, "staged-preds"), _scratch(spark, "published")
    ckpt = _scratch(spark, "stream-ckpt")
    second = F.pmod(F.xxhash64("MembershipID"), F.lit(2)) == 1
    for part in (~second, second, second):
        df.where(part).write.mode("append").parquet(staged)
        publish_staged_predictions(spark, staged, df.schema, sink, ckpt)
    return SK.read_batches(spark, sink).groupBy("RunDate").agg(F.count(F.lit(1)).alias("n"))


# --- filters, scalar functions, join steps ---------------------------------------------

from ..functions import asof as AS  # noqa: E402
from ..functions import columns as X  # noqa: E402

_M = f"({O.sql_memberships(AS_OF)}) m"
_T = O.d(AS_OF)


def _m(spark, sf_dir):
    return members(spark, sf_dir)


def _col(name):
    return F.col(f"`{name}`")


@register("active_at_weekly", lambda: f'SELECT MembershipID FROM {_M} WHERE "ActiveOn Date" <= {_T} '
          f'AND ("End Date" >= {_T} OR "End Date" IS NULL)')
def q_active_weekly(spark, sf_dir):
    return _m(spark, sf_dir).where(AS.active_at_weekly(_col("ActiveOn Date"), _col("End Date"), AS_OF)).select("MembershipID")


@register("active_at_profile", lambda: f'SELECT MembershipID FROM {_M} WHERE "Start Date" < {_T} '
          f'AND ("End Date" > {_T} OR "End Date" IS NULL)')
def q_active_profile(spark, sf_dir):
    return _m(spark, sf_dir).where(AS.active_at_profile(_col("Start Date"), _col("End Date"), AS_OF)).select("MembershipID")


@register("exclude_subcategories", lambda: f"SELECT MembershipID, SubCategory FROM {_M} "
          f"WHERE SubCategory NOT IN {O.inlist(C.EXCLUDED_SUBCATEGORIES)}")
def q_excl_sub(spark, sf_dir):
    return _m(spark, sf_dir).where(AS.exclude_subcategories(F.col("SubCategory"))).select("MembershipID", "SubCategory")


@register("contract_only", lambda: f"SELECT MembershipID, Category FROM {_M} WHERE Category IN {O.inlist(C.CONTRACT_CATEGORIES)}")
def q_contract(spark, sf_dir):
    return _m(spark, sf_dir).where(AS.contract_only(F.col("Category"))).select("MembershipID", "Category")


@register("exclude_origin_transfer", lambda: f"SELECT MembershipID, Origin FROM {_M} WHERE Origin NOT IN {O.inlist(C.EXCLUDED_ORIGINS)}")
def q_excl_origin(spark, sf_dir):
    return _m(spark, sf_dir).where(AS.exclude_origin_transfer(F.col("Origin"))).select("MembershipID", "Origin")


@register("job_weekly_panel_dashboard", lambda: O.sql_panel(AS_OF, labels=True, exclude_origin=True))
def q_panel_dash(spark, sf_dir):
    return WK.weekly_panel(members(spark, sf_dir), att_year(spark, sf_dir), AS_OF, labels=True, exclude_origin=True)


@register("not_transferred_out", lambda: f"SELECT MembershipID FROM {_M} WHERE Transferred_OUT IS NULL")
def q_not_transferred(spark, sf_dir):
    return _m(spark, sf_dir).where(F.col("Transferred_OUT").isNull()).select("MembershipID")


@register("trailing_year_window", lambda: f"SELECT MembershipID, WeekBeginningDate FROM "
          f"({O.sql_attendance(None, AS_OF)}) a WHERE WeekBeginningDate >= {O.add_months(_T, -12)} AND WeekBeginningDate < {_T}")
def q_trailing(spark, sf_dir):
    a = FX.attendance(spark, sf_dir, None, AS_OF)
    return a.where(AS.trailing_year(F.col("WeekBeginningDate"), AS_OF)).select("MembershipID", "WeekBeginningDate")


@register("before_as_of", lambda: f"SELECT MembershipID, count(*) AS weeks, max(WeekBeginningDate) AS last_week FROM "
          f"({O.sql_attendance(None, None)}) a WHERE WeekBeginningDate < {_T} GROUP BY MembershipID")
def q_before(spark, sf_dir):
    a = FX.attendance(spark, sf_dir)
    return (a.where(AS.before_as_of(F.col("WeekBeginningDate"), AS_OF)).groupBy("MembershipID")
            .agg(F.count(F.lit(1)).alias("weeks"), F.max("WeekBeginningDate").alias("last_week")))


@register("attended_only", lambda: f"SELECT MembershipID, TotalAttendanceToDate FROM {O.sql_profile(AS_OF)} p")
def q_attended(spark, sf_dir):
    return _profile(spark, sf_dir).select("MembershipID", "TotalAttendanceToDate")


@register("coalesce_visits", lambda: f"SELECT MembershipID, WeekBeginningDate, WeekVisits, "
          f"CAST(coalesce(WeekVisits, 0) AS INTEGER) AS engagement FROM ({O.sql_attendance(O.prev_year(AS_OF), AS_OF)}) a")
def q_coalesce(spark, sf_dir):
    return att_year(spark, sf_dir).select("MembershipID", "WeekBeginningDate", "WeekVisits",
                                          X.coalesce_visits(F.col("WeekVisits")).cast("int").alias("engagement"))


@register("end_month_bucket", lambda: f'SELECT MembershipID, "End Date" AS end_date, '
          f'{O.sql_end_month_bucket(chr(34) + "End Date" + chr(34), AS_OF)} AS end_month_bucket FROM {_M}')
def q_bucket(spark, sf_dir):
    return _m(spark, sf_dir).select("MembershipID", _col("End Date").alias("end_date"),
                                    AS.end_month_bucket(_col("End Date"), AS_OF).alias("end_month_bucket"))


@register("churn_flag_52w", lambda: f'SELECT MembershipID, {O.sql_churn_flag(chr(34) + "End Date" + chr(34), AS_OF)} AS churn_flag FROM {_M}')
def q_flag52(spark, sf_dir):
    return _m(spark, sf_dir).select("MembershipID", AS.churn_flag_52w(_col("End Date"), AS_OF).cast("int").alias("churn_flag"))


@register("valid_month_bucket", lambda: O.sql_panel(AS_OF, labels=True).replace("SELECT mw.MembershipID AS member_id", "SELECT DISTINCT mw.MembershipID AS member_id", 1)
          .replace(", mw.week, mw.engagement, mw.pause AS paused, lbl.end_month_bucket, lbl.churn_flag", ", lbl.end_month_bucket", 1)
          + " WHERE lbl.end_month_bucket BETWEEN 1 AND 12")
def q_valid_bucket(spark, sf_dir):
    p = WK.weekly_panel(members(spark, sf_dir), att_year(spark, sf_dir), AS_OF, labels=True)
    return p.where(F.col("end_month_bucket").between(1, 12)).select("member_id", "end_month_bucket").distinct()


@register("null_month_bucket", lambda: O.sql_panel(AS_OF, labels=True).replace("SELECT mw.MembershipID AS member_id", "SELECT DISTINCT mw.MembershipID AS member_id", 1)
          .replace(", mw.week, mw.engagement, mw.pause AS paused, lbl.end_month_bucket, lbl.churn_flag", "", 1)
          + " WHERE lbl.end_month_bucket IS NULL")
def q_null_bucket(spark, sf_dir):
    p = WK.weekly_panel(members(spark, sf_dir), att_year(spark, sf_dir), AS_OF, labels=True)
    return p.where(F.col("end_month_bucket").isNull()).select("member_id").distinct()


@register("payment_band", lambda: f"SELECT MembershipID, RegularPayment, {O.sql_payment_band('RegularPayment')} AS payment_band FROM {_M}")
def q_pay_band(spark, sf_dir):
    return _m(spark, sf_dir).select("MembershipID", "RegularPayment", X.payment_band(F.col("RegularPayment")).alias("payment_band"))


@register("frequency_group", lambda: f"SELECT MembershipID, PaymentFrequency, "
          f"{O._prefix_case('PaymentFrequency', C.FREQUENCY_GROUPS)} AS frequency_group FROM {_M}")
def q_freq(spark, sf_dir):
    return _m(spark, sf_dir).select("MembershipID", "PaymentFrequency",
                                    X.frequency_group(F.col("PaymentFrequency")).alias("frequency_group"))


@register("term_group", lambda: f"SELECT MembershipID, Term, {O._prefix_case('Term', C.TERM_GROUPS)} AS term_group FROM {_M}")
def q_term(spark, sf_dir):
    return _m(spark, sf_dir).select("MembershipID", "Term", X.term_group(F.col("Term")).alias("term_group"))


@register("payment_band_to_number", lambda: f"SELECT MembershipID, RegularPayment, CASE " + " ".join(
    f"WHEN RegularPayment = {O.q(k)} THEN {v}" for k, v in C.PAYMENT_BAND_TO_NUMBER.items()) +
    f" END AS payment_number, CASE " + " ".join(f"WHEN \"Base Amount\" = {O.q(k)} THEN {v}" for k, v in C.FREQUENCY_TO_NUMBER.items())
    + f" END AS frequency_number FROM {O.sql_profile(AS_OF)} p")
def q_band_numbers(spark, sf_dir):
    return _profile(spark, sf_dir).select("MembershipID", "RegularPayment",
                                          X.payment_band_to_number(F.col("RegularPayment")).alias("payment_number"),
                                          X.frequency_to_number(_col("Base Amount")).alias("frequency_number"))


@register("frequency_to_number", lambda: f"SELECT \"Base Amount\" AS frequency_group, CASE " + " ".join(
    f"WHEN \"Base Amount\" = {O.q(k)} THEN {v}" for k, v in C.FREQUENCY_TO_NUMBER.items()) +
    f" END AS frequency_number, count(*) AS n FROM {O.sql_profile(AS_OF)} p GROUP BY 1, 2")
def q_freq_num(spark, sf_dir):
    p = _profile(spark, sf_dir)
    return p.groupBy(_col("Base Amount").alias("frequency_group"),
                     X.frequency_to_number(_col("Base Amount")).alias("frequency_number")).agg(F.count(F.lit(1)).alias("n"))


@register("days_since_last_accessed", lambda: f"SELECT MembershipID, DateLastAccessed, CAST(CASE WHEN DateLastAccessed IS NULL "
          f"OR DateLastAccessed > {_T} THEN {C.NO_ACCESS_SENTINEL} ELSE date_diff('day', DateLastAccessed, {_T}) END AS INTEGER) "
          f"AS DaysSinceLastAccessed FROM {_M}")
def q_dsla(spark, sf_dir):
    return _m(spark, sf_dir).select("MembershipID", "DateLastAccessed",
                                    X.days_since_last_accessed(F.col("DateLastAccessed"), AS_OF).alias("DaysSinceLastAccessed"))


@register("tenure_days", lambda: f'SELECT MembershipID, CAST(date_diff(\'day\', "Start Date", {_T}) AS INTEGER) AS TenureDays, '
          f'CAST(date_diff(\'day\', "Original Start Date", {_T}) AS INTEGER) AS DaysSinceOriginalStart, '
          f'CAST(date_diff(\'day\', {_T}, "End Date") AS INTEGER) AS DaysToContractEnd FROM {_M}')
def q_tenure_days(spark, sf_dir):
    T = F.lit(AS_OF).cast("date")
    return _m(spark, sf_dir).select("MembershipID", F.datediff(T, _col("Start Date")).alias("TenureDays"),
                                    F.datediff(T, _col("Original Start Date")).alias("DaysSinceOriginalStart"),
                                    F.datediff(_col("End Date"), T).alias("DaysToContractEnd"))


@register("age_years", lambda: f"SELECT MembershipID, DOB, CAST(year({_T}) - year(DOB) AS INTEGER) AS Age FROM {_M}")
def q_age(spark, sf_dir):
    return _m(spark, sf_dir).select("MembershipID", "DOB", X.age_years(F.col("DOB"), AS_OF).alias("Age"))


@register("clip", lambda: f"SELECT MembershipID, {O.r6(O.sql_clip('TenureDays / 100.0', 0, 10))} AS tenure_hundreds_clipped, "
          f"{O.r6(O.sql_clip('CAST(NULL AS DOUBLE)', 0, 10))} AS null_clipped FROM {O.sql_profile(AS_OF)} p")
def q_clip(spark, sf_dir):
    p = _profile(spark, sf_dir)
    return p.select("MembershipID", X.clip(F.col("TenureDays") / 100.0, 0, 10).alias("tenure_hundreds_clipped"),
                    X.clip(F.lit(None).cast("double"), 0, 10).alias("null_clipped"))


def _dirty_band_spark(df):
    k = F.substring("member_id", 4, 9).cast("int")
    b = F.col("risk_band")
    dirty = (F.when(k % 4 == 0, F.concat(F.lit("  "), F.lower(b), F.lit(" ")))
             .when((k % 4 == 1) & (b == "Low"), F.lit("LOWE"))
             .when((k % 4 == 2) & (b == "Medium"), F.lit("meduim"))
             .otherwise(F.upper(b)))
    return df.select("member_id", dirty.alias("raw_band"))


def _dirty_band_sql():
    k = "CAST(substr(member_id, 4, 9) AS INTEGER)"
    return (f"CASE WHEN {k} % 4 = 0 THEN concat('  ', lower(risk_band), ' ') "
            f"WHEN {k} % 4 = 1 AND risk_band = 'Low' THEN 'LOWE' "
            f"WHEN {k} % 4 = 2 AND risk_band = 'Medium' THEN 'meduim' ELSE upper(risk_band) END")


@register("normalize_band", lambda: O.sql_snapshot(AS_OF) + f", dirty AS (SELECT member_id, {_dirty_band_sql()} AS raw_band "
          f"FROM snap) SELECT member_id, raw_band, {O.sql_normalize_band('raw_band')} AS risk_band FROM dirty")
def q_norm_band(spark, sf_dir):
    d = _dirty_band_spark(_snapshot(spark, sf_dir))
    return d.select("member_id", "raw_band", X.normalize_band(F.col("raw_band")).alias("risk_band"))


@register("class_label", lambda: f"SELECT MembershipID, {O.sql_apply(str(T0), str(T1), '0.0')} AS PredictedClass, CASE "
          f"{O.sql_apply(str(T0), str(T1), '0.0')} " + " ".join(f"WHEN {c} THEN {O.q(v)}" for c, v in C.CLASS_LABELS.items())
          + f" END AS ClassLabel FROM {O.sql_probs(AS_OF)} x")
def q_class_label(spark, sf_dir):
    return _predictions(spark, sf_dir).select("MembershipID", "PredictedClass", "ClassLabel")


register("actual_churn_label", _campaign_sql("validation"))(
    lambda spark, sf_dir: PD.campaign_query(_saved(spark, sf_dir), "validation"))


@register("coerce_numeric", lambda: f"SELECT MembershipID, RegularPayment, TRY_CAST(RegularPayment AS DOUBLE) AS payment_numeric, "
          f"TRY_CAST(CAST(TotalAttendanceToDate AS VARCHAR) AS DOUBLE) AS total_numeric FROM {O.sql_profile(AS_OF)} p")
def q_coerce_num(spark, sf_dir):
    p = _profile(spark, sf_dir)
    return p.select("MembershipID", "RegularPayment", X.coerce_numeric(F.col("RegularPayment")).alias("payment_numeric"),
                    X.coerce_numeric(F.col("TotalAttendanceToDate")).alias("total_numeric"))


@register("coerce_date", lambda: f"SELECT MembershipID, TRY_CAST(CAST(end_date AS VARCHAR) AS DATE) AS end_date, "
          f"TRY_CAST(Term AS DATE) AS term_as_date FROM {O.sql_profile(AS_OF)} p")
def q_coerce_date(spark, sf_dir):
    p = _profile(spark, sf_dir)
    return p.select("MembershipID", X.coerce_date(F.col("end_date")).alias("end_date"),
                    X.coerce_date(F.col("Term")).alias("term_as_date"))


@register("join_attendance_members", lambda: f"""SELECT a.MembershipID, a.WeekBeginningDate AS week,
  CAST(coalesce(a.WeekVisits, 0) AS INTEGER) AS engagement
FROM ({O.sql_attendance(O.prev_year(AS_OF), AS_OF)}) a JOIN ({O.sql_weekly_base(AS_OF)}) b ON a.MembershipID = b.MembershipID
WHERE a.WeekBeginningDate >= {O.add_months(_T, -12)} AND a.WeekBeginningDate < {_T}""")
def q_join_att(spark, sf_dir):
    return WK.attendance_members(members(spark, sf_dir), att_year(spark, sf_dir), AS_OF)


_ELIG_SQL = (f"SELECT a.MembershipID, CAST(sum(coalesce(a.WeekVisits, 0)) AS BIGINT) AS total_visits "
             f"FROM ({O.sql_attendance(O.prev_year(AS_OF), AS_OF)}) a JOIN ({O.sql_weekly_base(AS_OF)}) b "
             f"ON a.MembershipID = b.MembershipID WHERE a.WeekBeginningDate >= {O.add_months(_T, -12)} "
             f"AND a.WeekBeginningDate < {_T} GROUP BY a.MembershipID HAVING sum(coalesce(a.WeekVisits, 0)) >= {C.MIN_VISITS_12M}")


@register("eligible_members", lambda: _ELIG_SQL)
def q_eligible(spark, sf_dir):
    return WK.eligible_members(WK.attendance_members(members(spark, sf_dir), att_year(spark, sf_dir), AS_OF))


@register("join_eligible", lambda: f"SELECT DISTINCT member_id FROM ({O.sql_panel(AS_OF)}) p")
def q_join_eligible(spark, sf_dir):
    return WK.weekly_panel(members(spark, sf_dir), att_year(spark, sf_dir), AS_OF).select("member_id").distinct()


@register("join_labels", lambda: f"SELECT member_id, week, end_month_bucket, churn_flag FROM ({O.sql_panel(AS_OF, labels=True)}) p")
def q_join_labels(spark, sf_dir):
    return q_weekly_panel(spark, sf_dir).select("member_id", "week", "end_month_bucket", "churn_flag")


@register("project_weekly_panel", lambda: O.sql_panel(AS_OF))
def q_project_panel(spark, sf_dir):
    return WK.weekly_panel(members(spark, sf_dir), att_year(spark, sf_dir), AS_OF)


@register("scan_typed_result", lambda: f"SELECT member_id, week, engagement, CAST(paused AS SMALLINT) AS paused FROM ({O.sql_panel(AS_OF)}) p")
def q_typed(spark, sf_dir):
    """The panel written as it comes and scanned with the declared result schema."""
    path = _scratch(spark, "panel")
    IO.write_parquet(q_project_panel(spark, sf_dir), path)
    return TY.scan_parquet(spark, path, TY.PANEL_RESULT).good


@register("join_profile_parts", lambda: f"SELECT {O.PROFILE_SQL_COLS} FROM {O.sql_profile(AS_OF)} p")
def q_profile_parts(spark, sf_dir):
    return _profile(spark, sf_dir)


@register("sort_profile", lambda: f"SELECT {O.PROFILE_SQL_COLS} FROM {O.sql_profile(AS_OF)} p ORDER BY MembershipID")
def q_sort_profile(spark, sf_dir):
    return _profile(spark, sf_dir).orderBy("MembershipID")


@register("join_scores_weekly", lambda: O.sql_scores(AS_OF) + f"SELECT member_id, week, {O.r6('EWS')} AS EWS, engagement, paused FROM sc")
def q_scores_weekly(spark, sf_dir):
    """A stored table of scores joined to the weekly panel on member and week."""
    path = _scratch(spark, "scores")
    IO.write_parquet(_scores(spark, sf_dir).select("member_id", "week", "EWS"), path)
    return SN.join_scores_weekly(IO.read_parquet(spark, path), _panel_flags(spark, sf_dir))


@register("join_canceled", lambda: O.sql_features(AS_OF) + "SELECT member_id, week, CAST(coalesce(canceled, 0) AS INTEGER) AS canceled FROM f")
def q_join_canceled(spark, sf_dir):
    """The weekly panel joined to a table of cancellations on member and week."""
    left = att_year(spark, sf_dir).where(F.col("canceled") == 1).select(F.col("MembershipID").alias("member_id"), F.col("WeekBeginningDate").alias("week"), "canceled")
    panel = WK.weekly_panel(members(spark, sf_dir), att_year(spark, sf_dir), AS_OF)
    return SN.join_canceled(panel, left).select("member_id", "week", "canceled")


@register("join_stats_back", lambda: O.sql_features(AS_OF) + f"SELECT member_id, week, {O.r6('ema_z')} AS ema_z, "
          f"{O.r6('volatility_z')} AS volatility_z FROM f")
def q_stats_back(spark, sf_dir):
    return _features(spark, sf_dir).select("member_id", "week", "ema_z", "volatility_z")


register("join_metric_blocks", lambda: O.sql_eval_ctes(AS_OF) + "SELECT * FROM mx")(q_evaluate)
register("dedupe", lambda: O.sql_eval_ctes(AS_OF) + "SELECT * FROM snapl")(q_latest)
register("attach_prediction", lambda: O.sql_predict_ctes(AS_OF, T0, T1) +
         f"SELECT MembershipID, member_id, PredictedClass, {O.r6('Confidence')} AS Confidence FROM feat")(q_join_pred)
register("job_save_predictions", lambda: O.sql_saved_predictions(AS_OF, T0, T1) + _SAVED_SEL)(q_saved)


@register("job_outreach", lambda: O.sql_active_candidates(AS_OF) +
          f"SELECT 'active' AS queue, * FROM (SELECT {Q_SQL_COLS} FROM act ORDER BY sev_rank ASC, EWS DESC, member_id ASC "
          f"LIMIT {C.OUTREACH_CAPACITY}) a UNION ALL SELECT 'paused' AS queue, {Q_SQL_COLS} FROM "
          f"({O.sql_with_playbook('(SELECT * FROM snap WHERE paused = 1)')}) x")
def q_job_outreach(spark, sf_dir):
    from .jobs import job_outreach
    a, p = job_outreach(_snapshot(spark, sf_dir), recent_contacts=_contacts(spark, sf_dir))
    return a.select(F.lit("active").alias("queue"), "*").unionByName(p.select(F.lit("paused").alias("queue"), "*"))


def _sink_nulls_sql():
    from ..operators.predict import SINK_SPEC
    parts = []
    for name, _, _ in SINK_SPEC:
        parts.append(f"SELECT {O.q(name)} AS \"column\", {O.r6(f'avg(CASE WHEN \"{name}\" IS NULL THEN 1.0 ELSE 0.0 END) * 100.0')} "
                     f"AS null_pct FROM sinkt HAVING avg(CASE WHEN \"{name}\" IS NULL THEN 1.0 ELSE 0.0 END) > 0")
    return O.sql_predict_ctes(AS_OF, T0, T1) + f", sinkt AS ({O.sql_sink_select(AS_OF)}) " + " UNION ALL ".join(parts)


@register("nulls_for_sink", _sink_nulls_sql)
def q_sink_nulls(spark, sf_dir):
    return RP.null_profile(_predict_job(spark, sf_dir))


_UPLOAD_SCHEMA = ("MembershipID string, SubCategory string, RegularPayment string, Gender string, Age int, "
                  "TotalAttendance long, ews_pct double, risk_band string")


def _upload(spark, sf_dir):
    up = _profile_snapshot(spark, sf_dir).select("MembershipID", "SubCategory", "RegularPayment", "Gender", "Age",
                                                  F.col("TotalAttendanceToDate").alias("TotalAttendance"), "ews_pct",
                                                  "risk_band")
    path = _scratch(spark, "upload")
    IO.write_csv(up, path)
    return TY.scan_csv(spark, path, StructType.fromDDL(_UPLOAD_SCHEMA)).good


_UPLOAD_SQL = lambda: O.sql_profile_snapshot(AS_OF) + (
    f"SELECT MembershipID, SubCategory, RegularPayment, Gender, Age, TotalAttendanceToDate AS TotalAttendance, "
    f"{O.r6('ews_pct')} AS ews_pct, risk_band FROM ps")

register("read_csv_upload", _UPLOAD_SQL)(_upload)
register("require_columns", _UPLOAD_SQL)(
    lambda spark, sf_dir: IO.require_columns(_upload(spark, sf_dir), ["MembershipID", "SubCategory", "RegularPayment",
                                                                      "Gender", "Age", "TotalAttendance", "ews_pct",
                                                                      "risk_band"]))


@register("object_store_io", lambda: O.sql_eval_ctes(AS_OF) + "SELECT * FROM mx")
def q_object_store(spark, sf_dir):
    """Evaluation matrix written under a date-templated key (``.../final/as_of=<date>/``)
    and read back through the Hadoop filesystem API (any object store with a connector)."""
    base = _scratch(spark, "final")
    mx = _matrix(spark, sf_dir)
    IO.write_parquet(mx.withColumn("as_of", F.lit(AS_OF).cast("date")), base, ["as_of"])
    return IO.read_parquet(spark, f"{base}/as_of={AS_OF}")


@register("write_csv_evaluation", lambda: O.sql_eval_ctes(AS_OF) + "SELECT risk_band, " + ", ".join(
    f'm{m} AS "{m}"' for m in EV.MONTHS) + ', null_bucket AS "null", ' + ", ".join(
    f'{EV.month_label(m)} AS "%{EV.month_label(m)[4:]}"' for m in EV.MONTHS) +
    ', Total_Members, Total_Churned, Total_Not_Churned, Total_Churned_And_Not, pct_Churned AS "%_Churned" FROM mx')
def q_write_eval(spark, sf_dir):
    """Matrix with the published CSV headers, keeping risk_band as a column."""
    out = EV.csv_headers(_matrix(spark, sf_dir).drop("band_order"))
    path = _scratch(spark, "evaluation-csv")
    IO.write_csv(out, path)
    ints = {str(m) for m in EV.MONTHS} | {"null", "Total_Members", "Total_Churned", "Total_Not_Churned", "Total_Churned_And_Not"}
    schema = ", ".join(f"`{c}` {'bigint' if c in ints else ('string' if c == 'risk_band' else 'double')}" for c in out.columns)
    return IO.read_csv_typed(spark, path, schema)


@register("load_model")
def q_load_model(spark, sf_dir):
    """The newest cohort scored with the model and thresholds that are stored."""
    model, th = _stored_model(spark, sf_dir)
    return PD.predictions_frame(ML.class_probabilities(model, _features_for_predict(spark, sf_dir)), th)


@register("job_predict_model")
def q_job_predict_model(spark, sf_dir):
    """The prediction job with the training job's stored model and thresholds: score the
    newest cohort, publish it and read the sink back."""
    from .jobs import job_predict
    path = _stored_training(spark, sf_dir)
    feats = _features_for_predict(spark, sf_dir)
    return job_predict(feats, AS_OF, f"{path}/model", f"{path}/thresholds", _scratch(spark, "predictions"))


def _campaign_counts_sql():
    sel = " UNION ALL ".join(
        f"SELECT {O.q(n)} AS query, count(*) AS n FROM ({_campaign_body(n)}) c_{n}" for n in PD.CAMPAIGNS)
    return O.sql_saved_predictions(AS_OF, T0, T1) + sel


def _campaign_body(name):
    full = _campaign_sql(name)()
    prefix = O.sql_saved_predictions(AS_OF, T0, T1)
    return full[len(prefix):]


@register("campaign_queries", _campaign_counts_sql)
def q_campaigns(spark, sf_dir):
    """All four documented consumer queries over one materialised predictions view."""
    from ..session import cut_lineage
    saved = cut_lineage(_saved(spark, sf_dir))
    out = None
    for name in PD.CAMPAIGNS:
        c = PD.campaign_query(saved, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("query"), "n")
        out = c if out is None else out.unionByName(c)
    return out
