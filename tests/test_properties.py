"""Properties on the driver's tables (sf0.001)."""

import os

import pytest
from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.operators import evaluate as EV
from churnlens.operators import outreach as OR
from churnlens.operators import snapshot as SN
from churnlens.operators import weekly as WK
from churnlens.plans import oracle as O
from churnlens.sources import fixtures as FX
from churnlens.sources import io as IO
from churnlens.sources import sinks as SK

SMOKE = "/root/testdata/sf0.001"

T = "2001-01-01"


@pytest.fixture(scope="module")
def panel(spark):
    m = FX.memberships(spark, SMOKE, T)
    return WK.weekly_panel(m, FX.attendance(spark, SMOKE, O.prev_year(T), T), T, labels=True, flags=True).cache()


@pytest.fixture(scope="module")
def snap(spark, panel):
    return SN.build_snapshots(SN.score_frame(WK.surrogate_ews(WK.member_features(panel)))).cache()


def test_panel_matches_fixture_counts(panel):
    # FIXTURES.md: sf0.001, as-of 2001 -> 73 eligible members, 3,796 panel rows
    assert panel.count() == 3796
    assert panel.select("member_id").distinct().count() == 73


def test_one_snapshot_per_member_and_pct_range(snap):
    n = snap.count()
    assert n == snap.select("member_id").distinct().count()
    r = snap.agg(F.min("ews_pct"), F.max("ews_pct")).collect()[0]
    assert 0 < r[0] <= r[1] <= 1


def test_queue_capacity_and_threshold(spark, snap):
    active, paused = OR.build_outreach(snap, capacity=10, recent_contacts=FX.recent_contacts(spark, SMOKE, T))
    assert active.count() <= 10
    thr, _ = OR.build_outreach(snap, ews_threshold=0.5)
    assert thr.where(F.col("EWS") < 0.5).count() == 0


def test_band_totals_add_up(panel, snap):
    mx = EV.band_month_matrix(snap, panel).collect()
    assert [r["risk_band"] for r in sorted(mx, key=lambda r: r["band_order"])] == C.BAND_ORDER
    for r in mx:
        assert r["Total_Churned"] == sum(r[f"m{m}"] for m in range(1, 13))
        assert r["Total_Members"] == r["Total_Churned"] + r["Total_Not_Churned"]
        assert r["Total_Members"] >= r["null_bucket"]


def test_future_label_monotone_in_k(panel):
    f = WK.member_features(panel)
    a = WK.future_k_label(f, 3, out="y3")
    b = WK.future_k_label(a, 6, out="y6")
    assert b.where(F.col("y3") > F.col("y6")).count() == 0


def test_sink_rerun_is_idempotent(spark, snap):
    path = IO.shared_path(spark, "test-sink-" + os.urandom(4).hex())
    df = snap.select("member_id", "EWS").withColumn("RunDate", F.lit(T).cast("date"))
    SK.sink_upsert_by_rundate(df, path)
    SK.sink_upsert_by_rundate(df, path)
    other = df.withColumn("RunDate", F.lit("2000-01-01").cast("date"))
    SK.sink_upsert_by_rundate(other, path)
    back = SK.read_sink(spark, path)
    assert back.where(F.col("RunDate") == F.lit(T).cast("date")).count() == df.count()
    assert back.count() == 2 * df.count()


def test_sink_empty_rerun_and_foreign_date(spark, snap):
    path = IO.shared_path(spark, "test-sink-" + os.urandom(4).hex())
    df = snap.select("member_id", "EWS").withColumn("RunDate", F.lit(T).cast("date"))
    SK.sink_upsert_by_rundate(df, path, T)
    assert SK.read_sink(spark, path).count() == df.count() > 0
    with pytest.raises(Exception, match="another RunDate"):
        SK.sink_upsert_by_rundate(df, IO.shared_path(spark, "test-sink-" + os.urandom(4).hex()), "2000-01-01")
    SK.sink_upsert_by_rundate(df.where("false"), path, T)
    assert SK.read_sink(spark, path).count() == 0


def test_stream_keeps_a_date_split_over_batches(spark):
    from churnlens.streaming import publish_staged_predictions
    root = IO.shared_path(spark, "test-stream-" + os.urandom(4).hex())
    rows = spark.createDataFrame([(str(i), i) for i in range(20)], "MembershipID string, v int").withColumn(
        "RunDate", F.lit(T).cast("date"))
    for part in ("v < 10", "v >= 10", "v >= 10"):
        rows.where(part).write.mode("append").parquet(f"{root}/staged")
        publish_staged_predictions(spark, f"{root}/staged", rows.schema, f"{root}/sink")
    got = SK.read_batches(spark, f"{root}/sink")
    assert sorted(r["v"] for r in got.collect()) == list(range(20))


def test_profile_same_on_dense_and_nonempty_attendance(spark):
    from churnlens.operators import profile as PR
    m = FX.memberships(spark, SMOKE, T)
    dense = PR.profile(m, FX.attendance(spark, SMOKE, None, T), T)
    sparse = PR.profile(m, FX.attendance(spark, SMOKE, None, T, nonempty_only=True), T)
    assert dense.count() == sparse.count()
    assert dense.exceptAll(sparse).count() == 0 and sparse.exceptAll(dense).count() == 0
