"""Adapters that give the driver's TPC-H-style tables the shape of the two warehouse
tables the pipeline consumes (memberships, weekly attendance) plus the optional
inputs (weekly flags, recent contacts, pseudo class probabilities).

One membership per customer, key ``k = c_custkey``. All derivations are integer/date
arithmetic so that Spark and the DuckDB twins in ``plans/oracle.py`` agree exactly.
Everything is lazy; the only wide operations are the lineitem->orders join and the
per-customer / per-(customer, week) aggregates that Catalyst plans with partial
aggregation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread

# Fixture design values (the adapter's own rules, see FIXTURES.md).
FIRST_WEEK = dt.date(1995, 1, 2)      # a Monday
LAST_WEEK = dt.date(2001, 10, 29)     # a Monday
FREQUENCIES = ["Fortnightly", "Monthly debit", "Weekly", "Annual"]
TERMS = ["12 months", "6 months", "24 months", "open"]
GENDERS = ["M", "F", "U"]
MEMBERSHIP_TYPES = ["Standard", "Premium", "Off-Peak"]
DOB_BASE = dt.date(1950, 1, 1)


_READS: dict = {}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one input table; the DataFrame is reused within a session so file
    listing and footer schema inference happen once per table, not once per query."""
    key = (id(spark), sf_dir, name)
    if key not in _READS:
        _READS[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _READS[key]


def membership_key(k: Column) -> Column:
    """'  M000000042 ' — deliberately padded and upper-case to exercise key normalisation."""
    return F.concat(F.lit("  M"), F.lpad(k.cast("string"), 9, "0"), F.lit(" "))


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + F.lit(1)).cast("int"))


def _to_date(c: Column) -> Column:
    return c.cast("date")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders on the order key (shuffle join on both sides' key)."""
    li = spread(_read(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_shipdate"), "l_orderkey")
    od = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias("k"), "l_quantity", _to_date(F.col("l_shipdate")).alias("ship_date"))


def memberships(spark: SparkSession, sf_dir: str, as_of: str | dt.date, with_access: bool = True) -> DataFrame:
    """Membership dimension as of ``as_of`` (only DateLastAccessed depends on it, which is
    left out without ``with_access``)."""
    T = F.lit(str(as_of)).cast("date")
    cust = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation/region are fixed 25/5-row dimensions: broadcasting them is size-bounded.
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey) \
        .select("n_nationkey", "n_name", "r_name")
    span = (_read(spark, sf_dir, "orders")
            .groupBy(F.col("o_custkey").alias("k"))
            .agg(_to_date(F.min("o_orderdate")).alias("first_order"),
                 _to_date(F.max("o_orderdate")).alias("last_order")))
    access = (order_lines(spark, sf_dir).where(F.col("ship_date") < T)
              .groupBy("k").agg(F.max("ship_date").alias("last_ship")))
    k = F.col("c_custkey")
    pay = F.when(k % 41 == 0, F.lit(None).cast("double")).otherwise((F.lit(15) + k % 40).cast("double"))
    disc = (k % 5).cast("double")
    rows = cust.join(F.broadcast(geo), cust.c_nationkey == geo.n_nationkey).join(span, k == span.k, "left")
    rows = rows.join(access, k == access.k, "left") if with_access else rows
    return (rows
            .select(
                membership_key(k).alias("MembershipID"),
                F.col("c_name").alias("MemberID"),
                F.col("first_order").alias("Start Date"),
                F.col("first_order").alias("ActiveOn Date"),
                F.when(k % 5 == 0, F.lit(None).cast("date")).otherwise(F.col("last_order")).alias("End Date"),
                F.when(k % 5 == 0, "Active").otherwise("Ended").alias("Status Desc"),
                F.when(k % 31 == 0, "Prepay").when(k % 37 == 0, F.lit(None).cast("string"))
                 .otherwise(F.col("c_mktsegment")).alias("SubCategory"),
                F.when(k % 11 == 0, "Casual").otherwise("Contract").alias("Category"),
                F.when(k % 13 == 0, "Transfer (Club to Club)").otherwise("Direct").alias("Origin"),
                F.col("r_name").alias("Channel"),
                F.col("n_name").alias("ClubName"),
                _pick(MEMBERSHIP_TYPES, F.floor(k / 3) % 3).alias("MembershipTypeDesc"),
                pay.alias("RegularPayment"),
                _pick(GENDERS, k % 3).alias("Gender"),
                F.date_add(F.lit(DOB_BASE), (k % 18000).cast("int")).alias("DOB"),
                disc.alias("Discount"),
                (pay + disc).alias("Base Amount"),
                _pick(FREQUENCIES, k % 4).alias("PaymentFrequency"),
                _pick(TERMS, F.floor(k / 4) % 4).alias("Term"),
                (F.lit(365) * (F.lit(1) + k % 2)).cast("int").alias("TermDays"),
                (k % 2).cast("int").alias("Lump Sum Flag"),
                F.date_sub(F.col("first_order"), (k % 400).cast("int")).alias("Original Start Date"),
                *([F.when(k % 17 == 0, F.lit(None).cast("date")).otherwise(F.col("last_ship")).alias("DateLastAccessed")] if with_access else []),
                F.when(k % 47 == 0, F.lit(1)).cast("int").alias("Transferred_IN"),
                F.when(k % 29 == 0, F.lit(1)).cast("int").alias("Transferred_OUT"),
                F.when(k % 43 == 0, 1).otherwise(0).cast("int").alias("EndedWithinCoolingPeriod"),
                F.col("c_name").alias("Member Name"),
            ))


def _week_bounds(week_from: str | dt.date | None, week_to: str | dt.date | None) -> tuple[dt.date, dt.date]:
    """Clamp [week_from, week_to) to the Monday grid of the fixture."""
    lo, hi = FIRST_WEEK, LAST_WEEK
    if week_from is not None:
        d = dt.date.fromisoformat(str(week_from))
        if d > lo:
            lo = FIRST_WEEK + dt.timedelta(days=-(-(d - FIRST_WEEK).days // 7) * 7)
    if week_to is not None:
        d = dt.date.fromisoformat(str(week_to)) - dt.timedelta(days=1)
        if d < hi:
            hi = FIRST_WEEK + dt.timedelta(days=((d - FIRST_WEEK).days // 7) * 7)
    return lo, hi


def memberships_by_date(spark: SparkSession, sf_dir: str, as_ofs: list) -> DataFrame:
    """``memberships`` of several as-of dates in one pass: a row per membership and ``as_of``."""
    last = max(str(T) for T in as_ofs)
    base = memberships(spark, sf_dir, last, with_access=False)
    k = F.col("k")
    access = (order_lines(spark, sf_dir).where(F.col("ship_date") < F.lit(last).cast("date")).groupBy("k")
              .agg(*[F.max(F.when(F.col("ship_date") < F.lit(str(T)).cast("date"), F.col("ship_date"))).alias(f"a{i}") for i, T in enumerate(as_ofs)])
              .select(membership_key(k).alias("MembershipID"), (k % 17 == 0).alias("hidden"), *[f"a{i}" for i in range(len(as_ofs))]))
    dates = F.array(*[F.struct(F.lit(str(T)).cast("date").alias("as_of"), F.when(~F.col("hidden"), F.col(f"a{i}")).alias("DateLastAccessed"))
                      for i, T in enumerate(as_ofs)])
    return base.join(access, "MembershipID", "left").select(*[F.col(f"`{c}`") for c in base.columns], F.inline(dates))


def attendance(spark: SparkSession, sf_dir: str, week_from=None, week_to=None, nonempty_only: bool = False,
               dense_from=None) -> DataFrame:
    """Weekly attendance fact: one row per customer and Monday in [week_from, week_to).

    In production this is a table partitioned by week and the bounds are partition
    filters; here they bound the generated calendar so the fixture only materialises
    the weeks a job reads. Weeks come from a per-customer ``sequence`` (a generator,
    linear in customers x weeks), never from a cross join.
    """
    lo, hi = _week_bounds(week_from, week_to)
    cust = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    shipped = (order_lines(spark, sf_dir)
               .withColumn("week", _to_date(F.date_trunc("week", F.col("ship_date"))))
               .where((F.col("week") >= F.lit(lo)) & (F.col("week") <= F.lit(hi))))
    visits = (spread(shipped, "k")
              .groupBy("k", "week")
              .agg(F.ceil(F.sum("l_quantity") / 10).cast("int").alias("WeekVisits")))
    # One map per customer holding its non-empty weeks: bounded by the calendar length,
    # so the join runs at customer grain and the dense weeks are generated after it
    # (no shuffle of the customers x weeks spine).
    per_cust = visits.groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("week", "WeekVisits"))).alias("vm"))
    if hi < lo:
        spine = cust.select("k", F.lit(None).cast("date").alias("week"), F.lit(None).cast("int").alias("WeekVisits")) \
            .where(F.lit(False))
    elif nonempty_only:
        # the rows of the same table that satisfy WeekVisits IS NOT NULL (the predicate
        # served by the source, as a parquet scan would push it down)
        spine = visits.select("k", "week", "WeekVisits")
    elif dense_from is not None:
        # the same table served with WeekVisits IS NOT NULL OR week >= dense_from
        start = max(_week_bounds(dense_from, None)[0], lo)
        early = F.filter(F.map_keys("vm"), lambda w: w < F.lit(start))
        weeks = F.concat(F.coalesce(early, F.array().cast("array<date>")),
                         F.sequence(F.lit(start), F.lit(hi), F.expr("INTERVAL 7 DAYS")) if start <= hi else F.array().cast("array<date>"))
        spine = (cust.join(per_cust, "k", "left").select("k", "vm", F.explode(weeks).alias("week"))
                 .select("k", "week", F.try_element_at(F.col("vm"), F.col("week")).alias("WeekVisits")))
    else:
        spine = (cust.join(per_cust, "k", "left")
                 .select("k", "vm", F.explode(F.sequence(F.lit(lo), F.lit(hi), F.expr("INTERVAL 7 DAYS"))).alias("week"))
                 .select("k", "week", F.try_element_at(F.col("vm"), F.col("week")).alias("WeekVisits")))
    wi = F.floor(F.datediff(F.col("week"), F.lit(FIRST_WEEK)) / 7).cast("long")
    k = F.col("k")

    def flag(cond: Column) -> Column:
        return F.when(cond, 1).otherwise(0).cast("int")

    return (spine
            .select(
                membership_key(k).alias("MembershipID"),
                F.col("week").alias("WeekBeginningDate"),
                F.col("WeekVisits"),
                flag(F.col("WeekVisits").isNull() & ((k * 7 + wi) % 23 == 0)).alias("OnPauseThisWeek"),
                flag((k + wi) % 19 == 0).alias("payment_failed"),
                flag((k + wi) % 3 == 0).alias("discount_active"),
                flag((k + wi) % 29 == 0).alias("price_change"),
                flag((k * 5 + wi) % 211 == 0).alias("canceled"),
            ))


def recent_contacts(spark: SparkSession, sf_dir: str, as_of) -> DataFrame:
    """Customers with k % 6 = 0 were contacted k % 60 days before ``as_of``."""
    T = F.lit(str(as_of)).cast("date")
    k = F.col("c_custkey")
    return (_read(spark, sf_dir, "customer").where(k % 6 == 0)
            .select(membership_key(k).alias("member_id"),
                    F.date_sub(T, (k % 60).cast("int")).alias("last_contact_date")))


def pseudo_probabilities(spark: SparkSession, sf_dir: str, labels: DataFrame | None = None) -> DataFrame:
    """Three normalised pseudo class probabilities per membership.

    Base weights a=k*17%97+1, b=k*31%89+1, c=k*13%101+1; when ``labels``
    (MembershipID, y) is given, 80 is added to the weight of the true class so the
    threshold and report operators see a planted signal. Exact in both engines.
    """
    k = F.col("c_custkey")
    base = _read(spark, sf_dir, "customer").select(
        membership_key(k).alias("MembershipID"),
        (k * 17 % 97 + 1).alias("a"), (k * 31 % 89 + 1).alias("b"), (k * 13 % 101 + 1).alias("c"))
    if labels is not None:
        base = base.join(labels.select("MembershipID", "y"), "MembershipID")
        y = F.col("y")
        a = F.col("a") + F.when(y == 0, 80).otherwise(0)
        b = F.col("b") + F.when(y == 1, 80).otherwise(0)
        c = F.col("c") + F.when(y == 2, 80).otherwise(0)
        base = base.withColumn("a", a).withColumn("b", b).withColumn("c", c)
    tot = (F.col("a") + F.col("b") + F.col("c")).cast("double")
    out = base.select(
        "MembershipID", *(["y"] if labels is not None else []),
        (F.col("a") / tot).alias("p0"), (F.col("b") / tot).alias("p1"), (F.col("c") / tot).alias("p2"))
    return out
