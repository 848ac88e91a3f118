"""DuckDB SQL twins of the registered queries.

The fragments rebuild the fixture adapters and each operator independently in SQL
over the same parquet views (customer, orders, lineitem, nation, region), so the
driver can compare row counts, schemas and value hashes. Doubles are rounded to
6 dp (and -0.0 folded to 0.0) on both sides; counts are BIGINT.
"""

from __future__ import annotations

import datetime as dt

from .. import config as C
from ..sources import fixtures as FX


def q(s) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def d(s) -> str:
    return f"DATE {q(s)}"


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def inlist(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def r6(expr: str) -> str:
    return f"(round_even(CAST({expr} AS DOUBLE), 6) + 0.0)"


def add_months(date_sql: str, m: int) -> str:
    return f"CAST({date_sql} + INTERVAL ({m}) MONTH AS DATE)"


def mkey(k: str = "k") -> str:
    return f"concat('  M', lpad(CAST({k} AS VARCHAR), 9, '0'), ' ')"


# ---------------------------------------------------------------- fixtures

def sql_order_lines() -> str:
    return ("SELECT o.o_custkey AS k, l.l_quantity, CAST(l.l_shipdate AS DATE) AS ship_date "
            "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey")


def sql_memberships(T) -> str:
    return f"""
SELECT
  {mkey('c.c_custkey')} AS MembershipID,
  c.c_name AS MemberID,
  s.first_order AS "Start Date",
  s.first_order AS "ActiveOn Date",
  CASE WHEN c.c_custkey % 5 = 0 THEN NULL ELSE s.last_order END AS "End Date",
  CASE WHEN c.c_custkey % 5 = 0 THEN 'Active' ELSE 'Ended' END AS "Status Desc",
  CASE WHEN c.c_custkey % 31 = 0 THEN 'Prepay' WHEN c.c_custkey % 37 = 0 THEN NULL ELSE c.c_mktsegment END AS SubCategory,
  CASE WHEN c.c_custkey % 11 = 0 THEN 'Casual' ELSE 'Contract' END AS Category,
  CASE WHEN c.c_custkey % 13 = 0 THEN 'Transfer (Club to Club)' ELSE 'Direct' END AS Origin,
  r.r_name AS Channel,
  n.n_name AS ClubName,
  {lst(FX.MEMBERSHIP_TYPES)}[CAST((c.c_custkey // 3) % 3 AS INTEGER) + 1] AS MembershipTypeDesc,
  CASE WHEN c.c_custkey % 41 = 0 THEN NULL ELSE CAST(15 + c.c_custkey % 40 AS DOUBLE) END AS RegularPayment,
  {lst(FX.GENDERS)}[CAST(c.c_custkey % 3 AS INTEGER) + 1] AS Gender,
  CAST({d(FX.DOB_BASE)} + CAST(c.c_custkey % 18000 AS INTEGER) AS DATE) AS DOB,
  CAST(c.c_custkey % 5 AS DOUBLE) AS Discount,
  CASE WHEN c.c_custkey % 41 = 0 THEN NULL ELSE CAST(15 + c.c_custkey % 40 AS DOUBLE) END + CAST(c.c_custkey % 5 AS DOUBLE) AS "Base Amount",
  {lst(FX.FREQUENCIES)}[CAST(c.c_custkey % 4 AS INTEGER) + 1] AS PaymentFrequency,
  {lst(FX.TERMS)}[CAST((c.c_custkey // 4) % 4 AS INTEGER) + 1] AS Term,
  CAST(365 * (1 + c.c_custkey % 2) AS INTEGER) AS TermDays,
  CAST(c.c_custkey % 2 AS INTEGER) AS "Lump Sum Flag",
  CAST(s.first_order - CAST(c.c_custkey % 400 AS INTEGER) AS DATE) AS "Original Start Date",
  CASE WHEN c.c_custkey % 17 = 0 THEN NULL ELSE a.last_ship END AS DateLastAccessed,
  CAST(CASE WHEN c.c_custkey % 47 = 0 THEN 1 END AS INTEGER) AS Transferred_IN,
  CAST(CASE WHEN c.c_custkey % 29 = 0 THEN 1 END AS INTEGER) AS Transferred_OUT,
  CAST(CASE WHEN c.c_custkey % 43 = 0 THEN 1 ELSE 0 END AS INTEGER) AS EndedWithinCoolingPeriod,
  c.c_name AS "Member Name"
FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (SELECT o_custkey AS k, CAST(min(o_orderdate) AS DATE) AS first_order,
                  CAST(max(o_orderdate) AS DATE) AS last_order FROM orders GROUP BY o_custkey) s
       ON c.c_custkey = s.k
LEFT JOIN (SELECT k, max(ship_date) AS last_ship FROM ({sql_order_lines()}) ol
           WHERE ship_date < {d(T)} GROUP BY k) a
       ON c.c_custkey = a.k
"""


def sql_attendance(week_from=None, week_to=None) -> str:
    lo, hi = FX._week_bounds(week_from, week_to)
    return f"""
SELECT {mkey('sp.k')} AS MembershipID,
       sp.week AS WeekBeginningDate,
       v.WeekVisits,
       CAST(CASE WHEN v.WeekVisits IS NULL AND (sp.k * 7 + sp.wi) % 23 = 0 THEN 1 ELSE 0 END AS INTEGER) AS OnPauseThisWeek,
       CAST(CASE WHEN (sp.k + sp.wi) % 19 = 0 THEN 1 ELSE 0 END AS INTEGER) AS payment_failed,
       CAST(CASE WHEN (sp.k + sp.wi) % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS discount_active,
       CAST(CASE WHEN (sp.k + sp.wi) % 29 = 0 THEN 1 ELSE 0 END AS INTEGER) AS price_change,
       CAST(CASE WHEN (sp.k * 5 + sp.wi) % 211 = 0 THEN 1 ELSE 0 END AS INTEGER) AS canceled
FROM (SELECT k, week, CAST(date_diff('day', {d(FX.FIRST_WEEK)}, week) // 7 AS BIGINT) AS wi
      FROM (SELECT c_custkey AS k,
                   CAST(unnest(generate_series(CAST({d(lo)} AS TIMESTAMP), CAST({d(hi)} AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS week
            FROM customer)) sp
LEFT JOIN (SELECT k, week, CAST(ceil(sum(l_quantity) / 10) AS INTEGER) AS WeekVisits
           FROM (SELECT k, l_quantity, CAST(date_trunc('week', ship_date) AS DATE) AS week FROM ({sql_order_lines()}) ol0) ol
           WHERE week BETWEEN {d(lo)} AND {d(hi)}
           GROUP BY k, week) v
       ON sp.k = v.k AND sp.week = v.week
"""


def sql_recent_contacts(T) -> str:
    return (f"SELECT {mkey('c_custkey')} AS member_id, CAST({d(T)} - CAST(c_custkey % 60 AS INTEGER) AS DATE) AS last_contact_date "
            f"FROM customer WHERE c_custkey % 6 = 0")


def prev_year(T) -> dt.date:
    t = dt.date.fromisoformat(str(T))
    try:
        return t.replace(year=t.year - 1)
    except ValueError:
        return t.replace(year=t.year - 1, day=28)


# ---------------------------------------------------------------- weekly panel

def sql_end_month_bucket(end: str, T) -> str:
    parts = [f"WHEN {end} IS NULL OR {end} <= {d(T)} THEN NULL"]
    for m in range(1, 13):
        parts.append(f"WHEN {end} <= {add_months(d(T), m)} THEN {m}")
    return "CAST(CASE " + " ".join(parts) + " ELSE NULL END AS INTEGER)"


def sql_churn_flag(end: str, T) -> str:
    return (f"CAST(CASE WHEN {end} IS NOT NULL AND {end} > {d(T)} AND {end} < CAST({d(T)} + {7 * C.CHURN_WINDOW_WEEKS} AS DATE) "
            f"THEN 1 ELSE 0 END AS INTEGER)")


def sql_weekly_base(T, exclude_origin=False) -> str:
    extra = f" AND Origin NOT IN {inlist(C.EXCLUDED_ORIGINS)}" if exclude_origin else ""
    return f"""
SELECT MembershipID, "End Date" AS end_date,
       {sql_end_month_bucket('"End Date"', T)} AS end_month_bucket,
       {sql_churn_flag('"End Date"', T)} AS churn_flag
FROM ({sql_memberships(T)}) m
WHERE "ActiveOn Date" <= {d(T)} AND ("End Date" >= {d(T)} OR "End Date" IS NULL)
  AND SubCategory NOT IN {inlist(C.EXCLUDED_SUBCATEGORIES)}
  AND Category IN {inlist(C.CONTRACT_CATEGORIES)}{extra}
"""


def sql_panel(T, labels=False, flags=False, exclude_origin=False, min_visits=C.MIN_VISITS_12M) -> str:
    lo = prev_year(T)
    fcols = ", mw.payment_failed, mw.discount_active, mw.price_change, mw.canceled" if flags else ""
    lcols = ", lbl.end_month_bucket, lbl.churn_flag" if labels else ""
    return f"""
WITH base AS ({sql_weekly_base(T, exclude_origin)}),
att AS ({sql_attendance(lo, T)}),
mw AS (
  SELECT a.MembershipID, a.WeekBeginningDate AS week, CAST(coalesce(a.WeekVisits, 0) AS INTEGER) AS engagement,
         CAST(a.OnPauseThisWeek AS INTEGER) AS pause, a.payment_failed, a.discount_active, a.price_change, a.canceled
  FROM att a JOIN base b ON a.MembershipID = b.MembershipID
  WHERE a.WeekBeginningDate >= {add_months(d(T), -12)} AND a.WeekBeginningDate < {d(T)}),
eligible AS (SELECT MembershipID FROM mw GROUP BY MembershipID HAVING sum(engagement) >= {min_visits})
SELECT mw.MembershipID AS member_id, mw.week, mw.engagement, mw.pause AS paused{lcols}{fcols}
FROM mw JOIN eligible e ON e.MembershipID = mw.MembershipID
LEFT JOIN base lbl ON lbl.MembershipID = mw.MembershipID
"""


# ---------------------------------------------------------------- weekly features

def sql_features(T) -> str:
    """Panel with flags -> features. EMA/volatility via recursive CTEs (an independent
    formulation of the closed form used on the Spark side); droughts via islands."""
    a = 2.0 / (C.EMA_SPAN + 1.0)
    b = 1.0 - a
    return f"""
WITH RECURSIVE p AS ({sql_panel(T, labels=False, flags=True)}),
r AS (SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY week) AS rn FROM p),
e(member_id, rn, ema) AS (
  SELECT member_id, rn, CAST(engagement AS DOUBLE) FROM r WHERE rn = 1
  UNION ALL
  SELECT r.member_id, r.rn, {b} * e.ema + {a} * r.engagement
  FROM e JOIN r ON r.member_id = e.member_id AND r.rn = e.rn + 1),
m AS (
  SELECT r.*, e.ema,
         coalesce(e.ema - lag(e.ema) OVER (PARTITION BY r.member_id ORDER BY r.week), 0.0) AS momentum,
         abs(r.engagement - e.ema) AS absdev
  FROM r JOIN e ON r.member_id = e.member_id AND r.rn = e.rn),
v(member_id, rn, volatility) AS (
  SELECT member_id, rn, absdev FROM m WHERE rn = 1
  UNION ALL
  SELECT m.member_id, m.rn, {b} * v.volatility + {a} * m.absdev
  FROM v JOIN m ON m.member_id = v.member_id AND m.rn = v.rn + 1),
g AS (
  SELECT m.*, v.volatility,
         sum(CASE WHEN m.engagement <> 0 THEN 1 ELSE 0 END)
           OVER (PARTITION BY m.member_id ORDER BY m.week ROWS UNBOUNDED PRECEDING) AS g1,
         sum(CASE WHEN m.engagement <> 0 OR coalesce(m.paused, 0) = 1 THEN 1 ELSE 0 END)
           OVER (PARTITION BY m.member_id ORDER BY m.week ROWS UNBOUNDED PRECEDING) AS g2
  FROM m JOIN v ON m.member_id = v.member_id AND m.rn = v.rn),
f AS (
  SELECT member_id, week, engagement, paused, payment_failed, discount_active, price_change, canceled,
         ema, momentum, volatility,
         CAST(CASE WHEN engagement <> 0 THEN 0 ELSE
              row_number() OVER (PARTITION BY member_id, g1 ORDER BY week) - CASE WHEN g1 > 0 THEN 1 ELSE 0 END END AS INTEGER) AS drought,
         CAST(CASE WHEN engagement <> 0 OR coalesce(paused, 0) = 1 THEN 0 ELSE
              row_number() OVER (PARTITION BY member_id, g2 ORDER BY week) - CASE WHEN g2 > 0 THEN 1 ELSE 0 END END AS INTEGER) AS drought_active,
         (rank() OVER (PARTITION BY member_id ORDER BY engagement)
            + (count(*) OVER (PARTITION BY member_id, engagement) - 1) / 2.0)
            / count(*) OVER (PARTITION BY member_id) AS pct_self,
         CAST(date_diff('day', min(week) OVER (PARTITION BY member_id), week) // 7 AS INTEGER) AS tenure_weeks,
         sin(2 * pi() * weekofyear(week) / 52.0) AS sin_woy,
         cos(2 * pi() * weekofyear(week) / 52.0) AS cos_woy,
         {_z('engagement')} AS engagement_z,
         {_z('ema')} AS ema_z,
         {_z('momentum')} AS momentum_z,
         {_z('volatility')} AS volatility_z,
         0 AS negative_feedback, 0 AS campaign_exposed
  FROM g)
"""


def _z(c: str) -> str:
    sd = f"stddev_samp({c}) OVER (PARTITION BY member_id)"
    return f"(({c} - avg({c}) OVER (PARTITION BY member_id)) / (CASE WHEN {sd} <> 0 THEN {sd} END + {C.ZSCORE_EPS}))"


def sql_reasons(k_weeks: int = C.K_WEEKS) -> str:
    tags = (f"CASE WHEN momentum_z < {C.MOMENTUM_Z_CUT} THEN 'negative_momentum' END, "
            f"CASE WHEN drought_active >= {max(2, k_weeks // 2)} THEN 'drought_streak' END, "
            f"CASE WHEN volatility_z > {C.VOLATILITY_Z_CUT} THEN 'erratic_usage' END, "
            f"CASE WHEN payment_failed = 1 THEN 'payment_issue' END, "
            f"CASE WHEN price_change = 1 AND discount_active = 0 THEN 'price_sensitivity' END")
    return (f"CASE WHEN coalesce(paused, 0) = 1 THEN 'paused_state' "
            f"WHEN concat_ws('|', {tags}) = '' THEN 'none' ELSE concat_ws('|', {tags}) END")


def sql_surrogate() -> str:
    return "round_even(1.0 / (1.0 + exp(-(0.3 * drought_active - 0.5 * coalesce(momentum_z, 0.0) - 1.0))), 6)"


def sql_future_label(k_weeks: int = C.K_WEEKS) -> str:
    ev = f"CASE WHEN coalesce(canceled, 0) = 1 THEN 1 ELSE CAST(drought_active >= {C.DROUGHT_EVENT_WEEKS} AS INTEGER) END"
    return (f"CAST(max({ev}) OVER (PARTITION BY member_id ORDER BY week ROWS BETWEEN CURRENT ROW AND {k_weeks - 1} FOLLOWING) "
            f"AS INTEGER)")


def sql_scores(T, k_weeks: int = C.K_WEEKS) -> str:
    """features CTEs + sc (member-week scores)."""
    return sql_features(T) + f""",
sc AS (
  SELECT member_id, week, {sql_surrogate()} AS prob_churn_{k_weeks}w, {sql_surrogate()} AS EWS,
         {sql_reasons(k_weeks)} AS reasons, engagement, paused
  FROM f)
"""


def sql_primary_reason(col: str = "reasons") -> str:
    arr = f"list_filter(list_transform(string_split({col}, '|'), lambda x: trim(x)), lambda x: x <> '')"
    picks = ", ".join(f"CASE WHEN list_contains({arr}, '{r}') THEN '{r}' END" for r in C.PRIMARY_REASON_ORDER)
    return f"CASE WHEN len({arr}) = 0 THEN 'none' ELSE coalesce({picks}, {arr}[1]) END"


def sql_risk_band(col: str) -> str:
    parts = " ".join(f"WHEN {col} >= {cut} THEN '{label}'" for cut, label in C.RISK_BANDS)
    return f"CASE {parts} ELSE '{C.RISK_BAND_ELSE}' END"


def sql_severity(col: str) -> str:
    parts = " ".join(f"WHEN {col} = '{r}' THEN {i}" for i, r in enumerate(C.SEVERITY_ORDER))
    return f"CAST(CASE {parts} ELSE {C.SEVERITY_UNKNOWN} END AS INTEGER)"


def sql_relabel(col: str) -> str:
    parts = " ".join(f"WHEN {col} = '{a}' THEN '{b}'" for a, b in C.REASON_RELABEL.items())
    return f"CASE {parts} ELSE {col} END"


def sql_snapshot(T, relabel: bool = False) -> str:
    """scores CTEs + latest (preferring non-paused) + global average-rank percentile."""
    mr = sql_primary_reason("reasons")
    main = sql_relabel(f"({mr})") if relabel else mr
    reasons = sql_relabel("reasons") if relabel else "reasons"
    return sql_scores(T) + f""",
lt AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY member_id
                                 ORDER BY CASE WHEN paused = 0 THEN 0 ELSE 1 END, week DESC) AS _rn
    FROM sc) WHERE _rn = 1),
snap AS (
  SELECT member_id, week, prob_churn_6w, EWS, {reasons} AS reasons, engagement, paused,
         (rank() OVER (ORDER BY EWS) + (count(*) OVER (PARTITION BY EWS) - 1) / 2.0) / count(*) OVER () AS ews_pct,
         {sql_risk_band('((rank() OVER (ORDER BY EWS) + (count(*) OVER (PARTITION BY EWS) - 1) / 2.0) / count(*) OVER ())')} AS risk_band,
         {main} AS main_reason
  FROM lt)
"""


def sql_playbook_values() -> str:
    rows = ", ".join(f"({q(r)}, {q(t)}, {q(s)}, {q(m)})" for r, t, s, m in C.PLAYBOOK)
    return f"(VALUES {rows}) AS pb(reason, action_tag, subject, message)"


def sql_with_playbook(src: str, reason_col: str = "main_reason") -> str:
    none = [r for r in C.PLAYBOOK if r[0] == "none"][0]
    return (f"SELECT s.*, coalesce(pb.action_tag, {q(none[1])}) AS action_tag, coalesce(pb.subject, {q(none[2])}) AS subject, "
            f"coalesce(pb.message, {q(none[3])}) AS message FROM {src} s LEFT JOIN {sql_playbook_values()} "
            f"ON s.{reason_col} = pb.reason")


QUEUE_COLS = "member_id, week, engagement, paused, EWS, risk_band, main_reason, reasons, action_tag, subject, message"


def sql_active_candidates(T, cooldown: int | None = C.COOLDOWN_DAYS) -> str:
    """snapshot CTEs + act (active, cooled-down, with playbook and sev_rank)."""
    cd = ""
    if cooldown is not None:
        cd = (f" LEFT JOIN (SELECT member_id, max(last_contact_date) AS last_contact_date FROM ({sql_recent_contacts(T)}) rc0 "
              f"GROUP BY member_id) rc ON a0.member_id = rc.member_id "
              f"WHERE rc.last_contact_date IS NULL OR date_diff('day', rc.last_contact_date, a0.week) >= {cooldown}")
    return sql_snapshot(T, relabel=False) + f""",
act0 AS (SELECT a0.* FROM (SELECT * FROM snap WHERE paused = 0) a0{cd}),
act AS (SELECT *, {sql_severity('main_reason')} AS sev_rank FROM ({sql_with_playbook('act0')}) x)
"""


# ---------------------------------------------------------------- profile

def _prefix_case(col: str, groups) -> str:
    parts = " ".join(f"WHEN lower({col}) LIKE {q(p.lower() + '%')} THEN {q(label)}" for p, label in groups)
    return f"CASE {parts} ELSE {q(C.UNDEFINED)} END"


def sql_payment_band(col: str) -> str:
    parts = " ".join(f"WHEN {col} <= {ub} THEN {q(label)}" for ub, label in C.PAYMENT_BANDS)
    return f"CASE {parts} ELSE {q(C.PAYMENT_BAND_ELSE)} END"


def sql_churn_class(end: str, T) -> str:
    return (f"CAST(CASE WHEN {end} BETWEEN {d(T)} AND {add_months(d(T), 3)} THEN 1 "
            f"WHEN {end} > {add_months(d(T), 3)} AND {end} <= {add_months(d(T), 6)} THEN 2 ELSE 3 END AS INTEGER)")


def sql_profile(T, payment_amount: bool = False) -> str:
    """Subquery (no WITH) producing the 21-column profile."""
    amt = ', base.RegularPayment AS RegularPaymentAmount, base."Base Amount" AS BaseAmountNumber' if payment_amount else ""
    return f"""(
SELECT base.MembershipID, base.Gender, CAST(year({d(T)}) - year(base.DOB) AS INTEGER) AS Age,
       base.SubCategory, base.Channel, base.ClubName, base.MembershipTypeDesc,
       {sql_payment_band('base.RegularPayment')} AS RegularPayment,
       {_prefix_case('base.PaymentFrequency', C.FREQUENCY_GROUPS)} AS "Base Amount",
       {_prefix_case('base.Term', C.TERM_GROUPS)} AS Term,
       base.TermDays, base."Lump Sum Flag",
       CAST(CASE WHEN base.DateLastAccessed IS NULL OR base.DateLastAccessed > {d(T)} THEN {C.NO_ACCESS_SENTINEL}
            ELSE date_diff('day', base.DateLastAccessed, {d(T)}) END AS INTEGER) AS DaysSinceLastAccessed,
       CAST(date_diff('day', base."Start Date", {d(T)}) AS INTEGER) AS TenureDays,
       CAST(date_diff('day', base."Original Start Date", {d(T)}) AS INTEGER) AS DaysSinceOriginalStart,
       af.TotalAttendanceToDate, af.Visits_Last30d, af.Visits_Last90d, base.EndedWithinCoolingPeriod,
       base."End Date" AS end_date,
       {sql_churn_class('base."End Date"', T)} AS Churned{amt}
FROM (SELECT * FROM ({sql_memberships(T)}) m0
      WHERE "Start Date" < {d(T)} AND ("End Date" > {d(T)} OR "End Date" IS NULL)
        AND SubCategory NOT IN {inlist(C.EXCLUDED_SUBCATEGORIES)}) base
LEFT JOIN (
  SELECT MembershipID, CAST(sum(WeekVisits) AS BIGINT) AS TotalAttendanceToDate,
         CAST(sum(CASE WHEN WeekBeginningDate >= CAST({d(T)} - 30 AS DATE) THEN WeekVisits ELSE 0 END) AS BIGINT) AS Visits_Last30d,
         CAST(sum(CASE WHEN WeekBeginningDate >= CAST({d(T)} - 90 AS DATE) THEN WeekVisits ELSE 0 END) AS BIGINT) AS Visits_Last90d
  FROM ({sql_attendance(None, T)}) a0 WHERE WeekBeginningDate < {d(T)} GROUP BY MembershipID) af
  ON base.MembershipID = af.MembershipID
WHERE base.Transferred_OUT IS NULL AND af.TotalAttendanceToDate > 0)"""


PROFILE_SQL_COLS = ("MembershipID, Gender, Age, SubCategory, Channel, ClubName, MembershipTypeDesc, RegularPayment, "
                    '"Base Amount", Term, TermDays, "Lump Sum Flag", DaysSinceLastAccessed, TenureDays, '
                    "DaysSinceOriginalStart, TotalAttendanceToDate, Visits_Last30d, Visits_Last90d, "
                    "EndedWithinCoolingPeriod, end_date, Churned")


def sql_profile_snapshot(T, payment_amount: bool = False) -> str:
    """snapshot CTEs + ps (profile ⋈ snapshot on the normalised key)."""
    return sql_snapshot(T, relabel=True) + f""",
ps AS (
  SELECT pr.*, lower(trim(pr.MembershipID)) AS member_id, s.ews_pct, s.risk_band
  FROM {sql_profile(T, payment_amount)} pr
  JOIN (SELECT lower(trim(member_id)) AS member_id, ews_pct, risk_band FROM snap) s
    ON lower(trim(pr.MembershipID)) = s.member_id)
"""


# ---------------------------------------------------------------- engineered

def sql_clip(x: str, lo, hi) -> str:
    return f"(CASE WHEN ({x}) IS NULL THEN NULL ELSE greatest({float(lo)}, least(({x}), {float(hi)})) END)"


def sql_pdiv(a: str, b: str) -> str:
    a, b = f"CAST(({a}) AS DOUBLE)", f"CAST(({b}) AS DOUBLE)"
    return (f"(CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL WHEN {b} <> 0 THEN {a} / {b} "
            f"WHEN {a} > 0 THEN CAST('inf' AS DOUBLE) WHEN {a} < 0 THEN CAST('-inf' AS DOUBLE) ELSE NULL END)")


def sql_engineered(src: str, payment_col: str = "RegularPayment") -> str:
    """SELECT src.*, 12 features FROM src, quartile edges (src must be a relation name)."""
    def n(c):
        return f"TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE)"
    ten, tot, v30, v90, days, pay = (n("TenureDays"), n("TotalAttendanceToDate"), n("Visits_Last30d"),
                                     n("Visits_Last90d"), n("DaysSinceLastAccessed"), n(payment_col))
    avg90 = f"(coalesce({v90}, 0.0) / 3)"
    months = f"(coalesce({ten}, 1.0) / 30)"
    rate = sql_clip(sql_pdiv(tot, f"coalesce({ten}, 1.0) + 1"), 0, 10)
    declining = f"(coalesce({v30}, 0.0) < {avg90} * 0.7)"
    days0 = f"coalesce({days}, 0.0)"
    t = f"coalesce({ten}, 0.0)"
    interior = "list_distinct(list_filter([qe.q[2], qe.q[3], qe.q[4]], lambda e: e > qe.q[1] AND e < qe.q[5]))"
    return f"""
SELECT s.*,
  {rate} AS Engagement_Rate,
  {sql_clip(sql_pdiv(f'coalesce({v30}, 0.0)', f'{avg90} + 0.001'), 0, 5)} AS Recent_Activity_Ratio,
  CAST({declining} AS INTEGER) AS Declining_Engagement,
  {sql_clip(sql_pdiv(tot, f'{months} + 0.1'), 0, 30)} AS Monthly_Avg_Visits,
  {sql_clip(sql_pdiv(f'coalesce({pay}, 0.0)', f'coalesce({tot}, 1.0) + 1'), 0, 100)} AS Payment_to_Attendance_Ratio,
  {sql_clip(sql_pdiv(f'coalesce({pay}, 0.0)', f'coalesce({v30}, 1.0) + 1'), 0, 100)} AS Recent_Payment_to_Visits,
  CAST(1 + len(list_filter({interior}, lambda e: {t} > e)) AS BIGINT) AS Tenure_Quartile,
  CAST(({days0} > 90) AND coalesce({rate} < 0.5, false) AND {declining} AS INTEGER) AS Early_Churn_Risk,
  {sql_clip(sql_pdiv(days0, f'coalesce({ten}, 1.0) + 1'), 0, 10)} AS Inactivity_Ratio,
  CAST(coalesce(coalesce({v30}, 0.0) < {sql_pdiv(tot, f'{months} + 0.1')} * 0.5, false) AS INTEGER) AS Attendance_Dropoff,
  {sql_clip(f'{days0} / 30', 0, 36)} AS Access_Gap_Months,
  CAST({days0} > 90 AS INTEGER) AS High_Inactivity
FROM {src} s,
     (SELECT quantile_cont(coalesce(TRY_CAST(CAST(TenureDays AS VARCHAR) AS DOUBLE), 0.0), [0.0, 0.25, 0.5, 0.75, 1.0]) AS q
      FROM {src}) qe
"""


# ---------------------------------------------------------------- evaluation

def sql_normalize_band(col: str) -> str:
    cap = f"concat(upper(substr(trim({col}), 1, 1)), lower(substr(trim({col}), 2)))"
    fixes = " ".join(f"WHEN {cap} = {q(a)} THEN {q(b)}" for a, b in C.BAND_TYPO_FIXES.items())
    return f"CASE WHEN {col} IS NULL THEN NULL {fixes} ELSE {cap} END"


def sql_eval_ctes(T) -> str:
    """snapshot CTEs + churned panel + per-member churn + merged + per-band matrix (mx)."""
    months = range(1, 13)
    spine = ", ".join(f"({q(b)}, {i})" for i, b in enumerate(C.BAND_ORDER))

    def pct(x):
        return f"round_even(coalesce(CAST({x} AS DOUBLE) / CASE WHEN Total_Members <> 0 THEN Total_Members END, 0.0), 4)"

    mcols = ", ".join(f"count(CASE WHEN b = {m} THEN member_id END) AS m{m}" for m in months)
    filled = ", ".join(f"coalesce(per.m{m}, 0) AS m{m}" for m in months)
    total_churned = " + ".join(f"m{m}" for m in months)
    pcts = ", ".join(f"{pct(f'm{m}')} AS pct_churned_{m}month{'s' if m > 1 else ''}" for m in months)
    plain = ", ".join(f"m{m}" for m in months)
    return sql_snapshot(T, relabel=True) + f""",
churned AS ({sql_panel(T, labels=True)}),
snapl AS (
  SELECT member_id, {sql_normalize_band('risk_band')} AS risk_band
  FROM (SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY week DESC) AS _r FROM snap) x WHERE _r = 1),
churn1 AS (
  SELECT member_id, CAST(arg_min(end_month_bucket, week) FILTER (WHERE end_month_bucket IS NOT NULL) AS INTEGER) AS end_month_bucket,
         max(churn_flag) AS churn_flag
  FROM churned GROUP BY member_id),
merged AS (
  SELECT s.member_id, s.risk_band, c.end_month_bucket AS b, CAST(coalesce(c.churn_flag, 0) AS INTEGER) AS churn_flag
  FROM snapl s LEFT JOIN churn1 c ON s.member_id = c.member_id
  WHERE s.risk_band IN {inlist(C.BAND_ORDER)}),
per AS (
  SELECT risk_band, {mcols}, count(CASE WHEN b IS NULL THEN member_id END) AS null_bucket,
         count(member_id) AS Total_Members
  FROM merged GROUP BY risk_band),
full0 AS (
  SELECT sp.risk_band, sp.band_order, {filled}, coalesce(per.null_bucket, 0) AS null_bucket,
         coalesce(per.Total_Members, 0) AS Total_Members
  FROM (VALUES {spine}) AS sp(risk_band, band_order) LEFT JOIN per ON sp.risk_band = per.risk_band),
mx AS (
  SELECT risk_band, CAST(band_order AS INTEGER) AS band_order, {plain}, null_bucket, {pcts},
         Total_Members, {total_churned} AS Total_Churned, Total_Members - ({total_churned}) AS Total_Not_Churned,
         Total_Members AS Total_Churned_And_Not, {pct(total_churned)} AS pct_Churned
  FROM full0)
"""


# ---------------------------------------------------------------- probabilities, thresholds, reports

def sql_hash(*cols: str, seed: int = C.SEED) -> str:
    inner = ", ".join([f"CAST({c} AS VARCHAR)" for c in cols] + [q(str(seed))])
    return f"CAST('0x' || substr(md5(concat_ws(':', {inner})), 1, 15) AS BIGINT)"


def sql_probs(T) -> str:
    """Subquery: MembershipID, y (= Churned - 1 of the profile), p0, p1, p2 with a planted signal."""
    return f"""(
SELECT pr.MembershipID, pr.y,
       CAST(w.a AS DOUBLE) / CAST(w.a + w.b + w.c AS DOUBLE) AS p0,
       CAST(w.b AS DOUBLE) / CAST(w.a + w.b + w.c AS DOUBLE) AS p1,
       CAST(w.c AS DOUBLE) / CAST(w.a + w.b + w.c AS DOUBLE) AS p2
FROM (SELECT MembershipID, Churned - 1 AS y FROM {sql_profile(T)} p0) pr
JOIN (SELECT {mkey('c_custkey')} AS MembershipID, c_custkey * 17 % 97 + 1 AS a0, c_custkey * 31 % 89 + 1 AS b0,
             c_custkey * 13 % 101 + 1 AS c0 FROM customer) w0 ON pr.MembershipID = w0.MembershipID
CROSS JOIN LATERAL (SELECT w0.a0 + CASE WHEN pr.y = 0 THEN 80 ELSE 0 END AS a,
                           w0.b0 + CASE WHEN pr.y = 1 THEN 80 ELSE 0 END AS b,
                           w0.c0 + CASE WHEN pr.y = 2 THEN 80 ELSE 0 END AS c) w)"""


def sql_apply(t0: str, t1: str, t2: str) -> str:
    v0, v1, v2 = f"(p0 >= {t0})", f"(p1 >= {t1})", f"(p2 >= {t2})"
    argmax = "CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END"
    return (f"CAST(CASE WHEN {v0} AND (NOT {v1} OR p0 >= p1) AND (NOT {v2} OR p0 >= p2) THEN 0 "
            f"WHEN {v1} AND (NOT {v2} OR p1 >= p2) THEN 1 WHEN {v2} THEN 2 ELSE {argmax} END AS INTEGER)")


def sql_threshold_ctes(T, metric="recall", min_recall=0.65, min_precision=0.50, classes=(0, 1)) -> str:
    """WITH pr (probabilities), curve (naive per-threshold counts), thr (cls, threshold, score)."""
    score = {"f1": "f1", "recall": "recall", "precision": "precision",
             "balanced_precision": "0.6 * recall + 0.4 * precision"}[metric]
    cls_vals = ", ".join(f"({c})" for c in classes)
    allc = ", ".join(f"({c})" for c in range(3))
    return f"""
WITH pr AS (SELECT * FROM {sql_probs(T)} x),
grid AS (SELECT c.cls, CAST(r.j AS INTEGER) AS j, CAST(r.j AS DOUBLE) * CAST(0.01 AS DOUBLE) AS t
         FROM (VALUES {cls_vals}) c(cls), range(101) r(j)),
cnt AS (
  SELECT g.cls, g.j, g.t,
         count(*) FILTER (WHERE (CASE g.cls WHEN 0 THEN pr.p0 WHEN 1 THEN pr.p1 ELSE pr.p2 END) >= g.t) AS predicted,
         count(*) FILTER (WHERE (CASE g.cls WHEN 0 THEN pr.p0 WHEN 1 THEN pr.p1 ELSE pr.p2 END) >= g.t AND pr.y = g.cls) AS tp,
         count(*) FILTER (WHERE pr.y = g.cls) AS P
  FROM grid g, pr GROUP BY g.cls, g.j, g.t),
curve AS (
  SELECT cls, j, t AS threshold, tp, predicted,
         CASE WHEN predicted > 0 THEN tp * 1.0 / predicted ELSE 0.0 END AS precision,
         CASE WHEN P > 0 THEN tp * 1.0 / P ELSE 0.0 END AS recall,
         CASE WHEN predicted + P > 0 THEN 2.0 * tp / (predicted + P) ELSE 0.0 END AS f1
  FROM cnt),
scored AS (SELECT *, {score} AS score,
                  predicted > 0 AND recall >= {min_recall} AND precision >= {min_precision} AS valid FROM curve),
best AS (SELECT cls, threshold AS best, score AS best_score FROM (
           SELECT *, row_number() OVER (PARTITION BY cls ORDER BY score DESC, j ASC) AS _r FROM scored WHERE valid) b
         WHERE _r = 1),
thr AS (
  SELECT a.cls, CASE WHEN a.cls NOT IN {inlist_num(classes)} THEN 0.0 WHEN b.best IS NULL THEN {C.THRESHOLD_FALLBACK}
                     ELSE b.best END AS threshold, b.best_score AS score
  FROM (VALUES {allc}) a(cls) LEFT JOIN best b ON a.cls = b.cls)
"""


def inlist_num(values) -> str:
    return "(" + ", ".join(str(v) for v in values) + ")"


def sql_tuned_pred() -> str:
    t = [f"(SELECT threshold FROM thr WHERE cls = {c})" for c in range(3)]
    return sql_apply(*t)


def sql_report(pairs: str, classes=(0, 1, 2)) -> str:
    """Classification report rows from a relation ``pairs`` with columns y, pred."""
    per = []
    for c in classes:
        per.append(f"""SELECT '{c}' AS label,
  CASE WHEN sum(CASE WHEN pred = {c} THEN 1 ELSE 0 END) > 0 THEN sum(CASE WHEN y = {c} AND pred = {c} THEN 1 ELSE 0 END) * 1.0 / sum(CASE WHEN pred = {c} THEN 1 ELSE 0 END) ELSE 0.0 END AS precision,
  CASE WHEN sum(CASE WHEN y = {c} THEN 1 ELSE 0 END) > 0 THEN sum(CASE WHEN y = {c} AND pred = {c} THEN 1 ELSE 0 END) * 1.0 / sum(CASE WHEN y = {c} THEN 1 ELSE 0 END) ELSE 0.0 END AS recall,
  CASE WHEN sum(CASE WHEN y = {c} THEN 1 ELSE 0 END) + sum(CASE WHEN pred = {c} THEN 1 ELSE 0 END) > 0 THEN 2.0 * sum(CASE WHEN y = {c} AND pred = {c} THEN 1 ELSE 0 END) / (sum(CASE WHEN y = {c} THEN 1 ELSE 0 END) + sum(CASE WHEN pred = {c} THEN 1 ELSE 0 END)) ELSE 0.0 END AS f1,
  CAST(sum(CASE WHEN y = {c} THEN 1 ELSE 0 END) AS BIGINT) AS support FROM {pairs}""")
    body = " UNION ALL ".join(per)
    return f"""
rep_c AS ({body}),
rep AS (
  SELECT * FROM rep_c
  UNION ALL SELECT 'accuracy', NULL, NULL, (SELECT avg(CASE WHEN y = pred THEN 1.0 ELSE 0.0 END) FROM {pairs}),
                   (SELECT count(*) FROM {pairs})
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM rep_c
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM rep_c)
"""


def sql_grid_joint(T, weights=C.JOINT_WEIGHTS) -> str:
    g = C.JOINT_GRID
    cfgs = ", ".join(f"({i0 * len(g) + i1}, {float(g[i0])}, {float(g[i1])})" for i0 in range(len(g)) for i1 in range(len(g)))
    f1 = []
    for c in range(3):
        f1.append(f"{float(weights[c])} * CASE WHEN sum(CASE WHEN y = {c} THEN 1 ELSE 0 END) + sum(CASE WHEN pred = {c} THEN 1 ELSE 0 END) > 0 "
                  f"THEN 2.0 * sum(CASE WHEN y = {c} AND pred = {c} THEN 1 ELSE 0 END) / "
                  f"(sum(CASE WHEN y = {c} THEN 1 ELSE 0 END) + sum(CASE WHEN pred = {c} THEN 1 ELSE 0 END)) ELSE 0.0 END")
    return f"""
WITH pr AS (SELECT * FROM {sql_probs(T)} x),
cf AS (SELECT cfg, CAST(t0 AS DOUBLE) AS t0, CAST(t1 AS DOUBLE) AS t1 FROM (VALUES {cfgs}) v(cfg, t0, t1)),
pp AS (SELECT cf.cfg, cf.t0, cf.t1, pr.y, {sql_apply('cf.t0', 'cf.t1', str(float(C.JOINT_CLASS2)))} AS pred FROM cf, pr),
sc AS (SELECT cfg, t0, t1, {' + '.join(f1)} AS score FROM pp GROUP BY cfg, t0, t1)
SELECT cfg, t0, t1, CAST({float(C.JOINT_CLASS2)} AS DOUBLE) AS t2, {r6('score')} AS score,
       row_number() OVER (ORDER BY score DESC, cfg ASC) = 1 AS best FROM sc
"""


# ---------------------------------------------------------------- prediction

def sql_predict_ctes(T, t0: float, t1: float) -> str:
    """profile⋈snapshot (+ amount) -> predictions (fixed thresholds) -> left join -> eng."""
    return sql_profile_snapshot(T, payment_amount=True) + f""",
pred AS (SELECT MembershipID, p0, p1, p2, {sql_apply(str(t0), str(t1), '0.0')} AS PredictedClass,
                greatest(p0, p1, p2) AS Confidence FROM {sql_probs(T)} x),
feat AS (SELECT ps.* EXCLUDE (Churned), pred.PredictedClass, pred.Confidence
         FROM ps LEFT JOIN pred ON ps.MembershipID = pred.MembershipID),
eng AS ({sql_engineered('feat', 'RegularPaymentAmount')})
"""


def sql_sink_select(T) -> str:
    from ..operators.predict import SINK_SPEC
    duck = {"date": "DATE", "string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE"}
    cols = []
    for name, src, typ in SINK_SPEC:
        if name == "RegularPayment":
            src = "RegularPaymentAmount"
        if name == "RunDate":
            e = f"{d(T)}"
        elif src is None:
            e = f"CAST(NULL AS {duck[typ]})"
        else:
            e = f'TRY_CAST("{src}" AS {duck[typ]})'
        if typ == "double":
            e = r6(e)
        cols.append(f'{e} AS "{name}"')
    return "SELECT " + ", ".join(cols) + " FROM eng"


def sql_saved_predictions(T, t0: float, t1: float) -> str:
    return sql_profile_snapshot(T) + f""",
pred AS (SELECT MembershipID, {sql_apply(str(t0), str(t1), '0.0')} AS ChurnedPrediction FROM {sql_probs(T)} x),
saved AS (SELECT ps.MembershipID, pred.ChurnedPrediction, ps.end_date AS EndDate, {d(T)} AS RunDate,
                 ps.* EXCLUDE (MembershipID, end_date, Churned)
          FROM ps LEFT JOIN pred ON ps.MembershipID = pred.MembershipID)
"""


# ---------------------------------------------------------------- cohorts

def sql_cohort(T, classes=None) -> str:
    """Full SELECT (own WITH) of profile⋈snapshot for one as-of date with optional class filter."""
    where = f" WHERE Churned IN {inlist_num(classes)}" if classes else ""
    return (sql_profile_snapshot(T) + f"SELECT {PROFILE_SQL_COLS}, member_id, {r6('ews_pct')} AS ews_pct, risk_band "
            f"FROM ps{where}")


def sql_sample_exact(src: str, n: int, id_col: str = "MembershipID") -> str:
    return (f"SELECT * EXCLUDE (_r) FROM (SELECT *, row_number() OVER (ORDER BY {sql_hash(id_col)}, {id_col}) AS _r "
            f"FROM ({src}) s0) s1 WHERE _r <= {n}")
