"""Weekly panel and per-member time-series features.

All window expressions share the partitioning key ``member_id`` so the panel is
shuffled once (by the attendance join / eligibility window) and every later window
only re-sorts inside partitions. A member holds at most one row per week, so window
partitions are bounded by the length of the series.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import asof
from ..functions.columns import season_sin_cos
from ..session import spread
from .ranking import shuffle_partitions

MEMBER = "member_id"
WEEK = "week"
# Rows per EMA segment: 0.6**-512 ~ 1e113 keeps the closed form far from overflow.
EMA_SEGMENT_ROWS = 512
#: Memberships whose weeks, of all dates, one task's windows sort.
MEMBERS_PER_TASK = 2_000


def _w(member: str = MEMBER, week: str = WEEK):
    return Window.partitionBy(member).orderBy(week)


def active_weekly_members(memberships: DataFrame, T, exclude_origin: bool = False,
                          case_insensitive: bool = False, with_labels: bool = True) -> DataFrame:
    """Members active at T (inclusive rule), sub-category/category filters, plus labels
    computed row-wise (no self-join)."""
    end = F.col("End Date").cast("date")
    cond = (asof.active_at_weekly(F.col("ActiveOn Date").cast("date"), end, T)
            & asof.exclude_subcategories(F.col("SubCategory"), case_insensitive)
            & asof.contract_only(F.col("Category"), case_insensitive))
    if exclude_origin:
        cond = cond & asof.exclude_origin_transfer(F.col("Origin"), case_insensitive)
    cols = [F.col("MembershipID"), end.alias("end_date")]
    if with_labels:
        cols += [asof.end_month_bucket(end, T).alias("end_month_bucket"),
                 asof.churn_flag_52w(end, T).cast("int").alias("churn_flag")]
    return memberships.where(cond).select(*cols)


def weekly_panel(memberships: DataFrame, attendance: DataFrame, T, min_visits: int = C.MIN_VISITS_12M,
                 exclude_origin: bool = False, labels: bool = False, flags: bool = False,
                 case_insensitive: bool = False) -> DataFrame:
    """Eligible weekly panel: member_id, week, engagement, paused [+ labels] [+ flags].

    attendance ⋈ active members on MembershipID (AQE picks broadcast at runtime when
    the member side is small), then the HAVING SUM >= min_visits test is a window sum
    over the same key, so the join's shuffle is reused instead of a second aggregate
    and join-back.
    """
    base = active_weekly_members(memberships, T, exclude_origin, case_insensitive, with_labels=labels)
    flag_cols = [c for c in C.WEEKLY_FLAGS + ["canceled"] if c in attendance.columns] if flags else []
    att = (attendance
           .where(asof.trailing_year(F.col("WeekBeginningDate"), T))
           .select("MembershipID", F.col("WeekBeginningDate").cast("date").alias(WEEK),
                   F.coalesce(F.col("WeekVisits"), F.lit(0)).cast("int").alias("engagement"),
                   F.col("OnPauseThisWeek").cast("int").alias("paused"), *flag_cols))
    # the windows below sort by member: a task's members must not grow with the input
    mw = spread(att, "MembershipID").join(base, "MembershipID")
    tot = F.sum("engagement").over(Window.partitionBy("MembershipID"))
    out = [F.col("MembershipID").alias(MEMBER), WEEK, "engagement", "paused"]
    if labels:
        out += ["end_month_bucket", "churn_flag"]
    out += flag_cols
    return mw.withColumn("_tot", tot).where(F.col("_tot") >= min_visits).select(*out)


def attendance_by_member(attendance: DataFrame, as_ofs: list) -> DataFrame:
    """One pass over the attendance for several as-of dates, one row per membership: the
    weeks that lie in the trailing year of any date (``weeks``, at most 53 a date), and for
    each date the visits of its trailing year (``visits``) and the sums of
    ``profile.attendance_features`` (both in ``sums``, with their ``as_of``)."""
    wk, v = F.col("WeekBeginningDate").cast("date"), F.col("WeekVisits")
    engagement = F.coalesce(v, F.lit(0)).cast("int")
    week = F.struct(wk.alias("week"), engagement.alias("engagement"), F.col("OnPauseThisWeek").cast("int").alias("paused"))
    within, sums = F.lit(False), []
    for T in as_ofs:
        Td, before, own = asof.as_date(T), asof.before_as_of(wk, T) & v.isNotNull(), asof.trailing_year(wk, T)
        within = within | own
        recent = [F.sum(F.when(before, F.when(wk >= F.date_sub(Td, days), v).otherwise(F.lit(0)))).cast("long").alias(name)
                  for days, name in ((30, "Visits_Last30d"), (90, "Visits_Last90d"))]
        sums.append(F.struct(Td.alias("as_of"), F.sum(F.when(own, engagement)).alias("visits"),
                             F.sum(F.when(before, v)).cast("long").alias("TotalAttendanceToDate"), *recent))
    last = max(str(T) for T in as_ofs)
    return attendance.where(asof.before_as_of(wk, last)).groupBy("MembershipID").agg(
        F.collect_list(F.when(within, week)).alias("weeks"), F.array(*sums).alias("sums"))


def weekly_panels(memberships: DataFrame, by_member: DataFrame, min_visits: int = C.MIN_VISITS_12M) -> DataFrame:
    """``weekly_panel`` of several as-of dates: ``memberships`` has a row per membership and
    ``as_of``, ``by_member`` comes from ``attendance_by_member``. The HAVING test reads the
    date's sum. A membership's weeks travel as one array, which no sort moves (the few columns
    of the memberships are the hashed side), and are dealt to the dates whose trailing year
    holds them when they are unfolded. Adds ``as_of``; the key ``member_id`` is that of the
    membership at its date."""
    T = F.col("as_of")
    end = F.col("End Date").cast("date")
    base = memberships.where(asof.active_at_weekly(F.col("ActiveOn Date").cast("date"), end, T)
                             & asof.exclude_subcategories(F.col("SubCategory")) & asof.contract_only(F.col("Category"))).select("MembershipID", "as_of")
    key = F.concat(T.cast("string"), F.lit("|"), F.col("MembershipID")).alias(MEMBER)
    rows = by_member.select("MembershipID", "weeks", F.inline("sums")).where(F.col("visits") >= min_visits).select(key, "weeks")
    # dealt for the windows by member while it is one row a member and date, then unfolded
    tasks = max(shuffle_partitions(rows), -(-by_member.count() // MEMBERS_PER_TASK))  # row counts of the stored files
    dated = base.select(key, "as_of", "MembershipID").hint("shuffle_hash")
    each = rows.repartition(tasks, MEMBER).join(dated, MEMBER).select(MEMBER, "as_of", "MembershipID", F.inline("weeks"))
    return each.where(asof.trailing_year(F.col("week"), T))


def add_segments(df: DataFrame, member: str = MEMBER, week: str = WEEK, segment_rows: int = EMA_SEGMENT_ROWS
                 ) -> DataFrame:
    """Row number in week order (``_rn``), its segment (``_seg``) and the index inside
    the segment (``_j``). Segments are monotone in week, so every later ordered window
    can use the order (``_seg``, week) and share one sort with the segment windows."""
    i = F.col("_rn") - 1
    seg = F.floor(i / segment_rows)
    df = df.withColumn("_rn", F.row_number().over(Window.partitionBy(member).orderBy(week)))
    return df.withColumns({"_seg": seg, "_j": (i - seg * segment_rows).cast("double")})


def _wm(member: str = MEMBER, week: str = WEEK):
    """Member window in (segment, week) order — the same order as week."""
    return Window.partitionBy(member).orderBy("_seg", week)


def ema_columns(df: DataFrame, x: str, out: str, span: int = C.EMA_SPAN,
                member: str = MEMBER, week: str = WEEK, segment_rows: int = EMA_SEGMENT_ROWS) -> DataFrame:
    """Exponential moving average, adjust=False: y0 = x0, y_t = (1-a) y_{t-1} + a x_t.

    Closed form per segment of ``segment_rows`` rows: with j the index inside the
    segment, local_t = b^j * running_sum(w_i x_i b^-i) and the carry of the previous
    segment enters as b^(j+1) * local_end(prev). Contributions older than one full
    segment are below b^512 and vanish in double precision. Adds the segment columns
    (``add_segments``) when they are missing.
    """
    if "_seg" not in df.columns:
        df = add_segments(df, member, week, segment_rows)
    alpha = 2.0 / (span + 1.0)
    beta = 1.0 - alpha
    L = segment_rows
    # relative to the member's first value, so that a constant series stays exactly constant
    x0 = F.coalesce(F.first(F.col(x).cast("double")).over(_wm(member, week).rowsBetween(Window.unboundedPreceding, 0)), F.lit(0.0))
    df = df.withColumn("_x0", x0)
    w = F.when(F.col("_rn") == 1, F.lit(1.0)).otherwise(F.lit(alpha))
    term = w * (F.col(x).cast("double") - F.col("_x0")) * F.pow(F.lit(beta), -F.col("_j"))
    wseg = Window.partitionBy(member, "_seg").orderBy(week).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_local", F.pow(F.lit(beta), F.col("_j")) * F.sum(term).over(wseg))
    wprev = _wm(member, week).rowsBetween(Window.unboundedPreceding, -1)
    carry = F.last(F.when(F.col("_j") == L - 1, F.col("_local")), ignorenulls=True).over(wprev)
    df = df.withColumn(out, F.col("_x0") + (F.col("_local") + F.coalesce(F.pow(F.lit(beta), F.col("_j") + 1) * carry, F.lit(0.0))))
    return df.drop("_local", "_x0")


def _run_since_break(brk: Column, rn: Column, member: str, week: str) -> Column:
    """Length of the current run of non-break rows (gaps-and-islands via running max)."""
    last_break = F.max(F.when(brk, rn)).over(_wm(member, week).rowsBetween(Window.unboundedPreceding, 0))
    return F.when(brk, F.lit(0)).otherwise(rn - F.coalesce(last_break, F.lit(0))).cast("int")


def zscore(c: str, member: str = MEMBER) -> Column:
    """(x - mean) / (std_samp + 1e-6); a single row, or a series whose least and greatest
    value are equal -> NULL. However small, any true spread counts."""
    wm = Window.partitionBy(member)
    real = F.max(c).over(wm) > F.min(c).over(wm)
    return (F.col(c) - F.avg(c).over(wm)) / (F.when(real, F.stddev_samp(c).over(wm)) + F.lit(C.ZSCORE_EPS))


def _expanding_ranks(values) -> list:
    """Average rank of each value among itself and those before it, as a share of their
    number; a missing value has none and does not count."""
    seen: list = []
    out: list = []
    for x in values:
        if x is None or x != x:
            out.append(None)
            continue
        at = bisect_right(seen, x)
        ties = at - bisect_left(seen, x) + 1
        seen.insert(at, x)
        out.append((at - ties + 1 + (ties + 1) / 2.0) / len(seen))
    return out


def pct_self_causal(panel: DataFrame, out: str = "pct_self_causal", x: str = "engagement", member: str = MEMBER, week: str = WEEK) -> DataFrame:
    """``panel`` plus the rank of a week's value among the member's weeks up to it (ties: the
    mean rank), as a share of their number: ``pct_self`` without a look ahead. The weeks so
    far are kept in order and each new one is merged in; a member's series is one array,
    bounded by its weeks. Rows of one week go by their value, then by their other columns."""
    @F.pandas_udf("array<double>")
    def ranks(series: pd.Series) -> pd.Series:
        return series.map(_expanding_ranks)

    rest = [c for c in panel.columns if c not in (member, week, x)]
    row = F.struct(F.col(week), F.col(x), *[F.col(f"`{c}`") for c in rest])
    series = panel.groupBy(member).agg(F.sort_array(F.collect_list(row)).alias("_s"))
    series = series.withColumn("_r", ranks(F.transform("_s", lambda r: r[x].cast("double"))))
    each = series.select(member, F.explode(F.arrays_zip("_s", "_r")).alias("_z"))
    return each.select(*[F.col(member) if c == member else F.col("_z._s")[c].alias(c) for c in panel.columns], F.col("_z._r").alias(out))


def member_features(panel: DataFrame, ema_span: int = C.EMA_SPAN, seasonality: bool = True,
                    member: str = MEMBER, week: str = WEEK) -> DataFrame:
    """ema, momentum, volatility, drought, drought_active, pct_self, tenure_weeks,
    sin/cos of the ISO week, per-member z-scores and zero-filled weekly flags.

    Ordered windows share the (member, segment, week) order; pct_self needs its own
    (member, engagement) order; unordered member aggregates ride on either sort.
    Independent columns are added in one projection per dependency level."""
    df = panel
    if "paused" not in df.columns:
        df = df.withColumn("paused", F.lit(0))
    df = add_segments(df, member, week)
    W = _wm(member, week)
    df = ema_columns(df, "engagement", "ema", ema_span, member, week)
    df = df.withColumns({
        "momentum": F.coalesce(F.col("ema") - F.lag("ema").over(W), F.lit(0.0)),
        "_absdev": F.abs(F.col("engagement").cast("double") - F.col("ema")),
    })
    df = ema_columns(df, "_absdev", "volatility", ema_span, member, week)
    e_int = F.coalesce(F.col("engagement"), F.lit(0)).cast("int")
    p_int = F.coalesce(F.col("paused"), F.lit(0)).cast("int")
    rn = F.col("_rn")
    wm = Window.partitionBy(member)
    # within-member average-rank percentile (sees the whole series, as the source does)
    r = F.rank().over(Window.partitionBy(member).orderBy("engagement"))
    ties = F.count(F.lit(1)).over(Window.partitionBy(member, "engagement"))
    n = F.count(F.lit(1)).over(wm)
    cols = {
        "drought": _run_since_break(e_int != 0, rn, member, week),
        "drought_active": _run_since_break((e_int != 0) | (p_int == 1), rn, member, week),
        "pct_self": (r + (ties - 1) / 2.0) / n,
        "tenure_weeks": F.floor(F.datediff(F.col(week), F.min(week).over(wm)) / 7).cast("int"),
    }
    if seasonality:
        s, c = season_sin_cos(F.col(week))
        cols.update({"sin_woy": s, "cos_woy": c})
    cols.update({f"{c}_z": zscore(c, member) for c in ["engagement", "ema", "momentum", "volatility"]})
    cols.update({flag: F.lit(0) for flag in C.WEEKLY_FLAGS if flag not in df.columns})
    df = df.withColumns(cols)
    return df.drop("_rn", "_seg", "_j", "_absdev")


def churn_event(df: DataFrame, drought_col: str = "drought_active") -> Column:
    """canceled == 1, else drought >= 8 (the label leaks the drought feature, as in the source)."""
    hit = (F.col(drought_col) >= C.DROUGHT_EVENT_WEEKS).cast("int")
    if "canceled" in df.columns:
        return F.when(F.coalesce(F.col("canceled"), F.lit(0)).cast("int") == 1, F.lit(1)).otherwise(hit)
    return hit


def future_k_label(df: DataFrame, k_weeks: int = C.K_WEEKS, member: str = MEMBER, week: str = WEEK,
                   event_col: str | None = None, out: str = "y_nextk") -> DataFrame:
    """1 if any event in rows [t, t+k) of the member's series (includes the current week)."""
    ev = F.col(event_col) if event_col else churn_event(df)
    frame = _w(member, week).rowsBetween(0, k_weeks - 1)
    return df.withColumn("_ev", ev).withColumn(out, F.max("_ev").over(frame).cast("int")).drop("_ev")


# The score's features, in the order of its model.
EWS_FEATURES = ["engagement_z", "ema_z", "momentum_z", "volatility_z", "drought_active", "pct_self",
                "tenure_weeks", "paused", "payment_failed", "discount_active", "price_change",
                "negative_feedback", "campaign_exposed", "sin_woy", "cos_woy"]


def surrogate_ews(df: DataFrame, out: str = "EWS") -> DataFrame:
    """Deterministic closed-form early-warning score used where a trained model would
    make results engine-dependent: sigmoid(0.3*drought_active - 0.5*momentum_z - 1)."""
    z = F.lit(0.3) * F.col("drought_active") - F.lit(0.5) * F.coalesce(F.col("momentum_z"), F.lit(0.0)) - F.lit(1.0)
    return df.withColumn(out, F.bround(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 6))


def eligible_members(attendance_joined: DataFrame, min_visits: int = C.MIN_VISITS_12M, key: str = "MembershipID",
                     value: str = "engagement") -> DataFrame:
    """GROUP BY member HAVING SUM(engagement) >= min_visits (partial aggregation)."""
    return (attendance_joined.groupBy(key).agg(F.sum(value).cast("long").alias("total_visits"))
            .where(F.col("total_visits") >= min_visits))


def attendance_members(memberships: DataFrame, attendance: DataFrame, T, exclude_origin: bool = False) -> DataFrame:
    """attendance ⋈ active members over the trailing year, before the eligibility test."""
    base = active_weekly_members(memberships, T, exclude_origin, with_labels=False)
    att = (attendance.where(asof.trailing_year(F.col("WeekBeginningDate"), T))
           .select("MembershipID", F.col("WeekBeginningDate").alias(WEEK),
                   F.coalesce(F.col("WeekVisits"), F.lit(0)).cast("int").alias("engagement")))
    return att.join(base.select("MembershipID"), "MembershipID")
