"""Ranks with a hot score, ranks inside dates, causal ranks, exact zero variance, and
cohorts of several dates from one pass."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnlens.operators import ranking as RK
from churnlens.operators import weekly as WK
from churnlens.plans import jobs as J

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture
def plain(spark):
    """Partitions as dealt: nothing is joined, broadcast or split afterwards."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_hot_score_spreads(spark, plain):
    n = 40_000
    df = spark.range(n).select("id", F.when(F.col("id") % 2 == 0, 0.5).when(F.col("id") % 4 == 1, None).otherwise(F.rand(1)).alias("s"))
    out = RK.average_rank(df, "s")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(s" in plan.replace("knownfloatingpointnormalized(normalizenanandzero(s", "s") and "_salt" in [
        x for x in plan.split("\n") if "SortMergeJoin" in x][0].split("[")[1]
    rows = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(rows) == 16 and max(rows) < 2 * n / 16  # half of all rows hold one score, a quarter none
    got = out.toPandas().sort_values("id")
    want = got.s.rank(method="average")
    assert np.allclose(got._avg_rank[got.s.notna()], want[got.s.notna()]) and got._avg_rank[got.s.isna()].isna().all()


def test_more_ranges_than_partitions(spark, monkeypatch):
    monkeypatch.setattr(RK, "ROWS_PER_RANGE", 50)
    df = spark.range(5000).select("id", F.rand(3).alias("s"))
    table, n = RK.ranged(df, "s")
    assert n == 100 and table.groupBy("_b").count().agg(F.max("count")).first()[0] < 200
    got = RK.percentile_rank(df, "s", "pct").toPandas()
    assert np.allclose(got.pct, got.s.rank(pct=True))


def test_rank_inside_dates(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"id": range(900), "d": rng.choice(["a", "b", "c"], 900, p=[0.7, 0.2, 0.1]), "s": rng.integers(0, 40, 900) / 7.0})
    pdf.loc[pdf.id % 17 == 0, "s"] = None
    got = RK.percentile_rank_by(spark.createDataFrame(pdf), "s", "d", "pct").toPandas().sort_values("id")
    want = pdf.groupby("d").s.rank(pct=True)
    assert len(got) == 900 and np.allclose(got.pct.to_numpy(float), want.to_numpy(), equal_nan=True)


def test_quantiles_of_many_columns(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"a": rng.normal(size=501), "b": rng.integers(0, 5, 501).astype(float), "c": [None] * 500 + [7.0], "e": [None] * 501}).astype(float)
    probs = [0.0, 0.1, 0.5, 0.75, 1.0]
    got = RK.exact_quantiles_many(spark.createDataFrame(pdf).select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in pdf.columns]), list(pdf.columns), probs)
    for c in "ab":
        assert np.allclose(got[c], np.quantile(pdf[c], probs))
    assert got["c"] == [7.0] * 5 and got["e"] == [None] * 5


def test_causal_rank_matches_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"member_id": ["m"] * 1300 + ["n"] * 3, "week": list(pd.date_range("1990-01-01", periods=1300, freq="7D").date) + list(
        pd.date_range("1990-01-01", periods=3, freq="7D").date), "engagement": list(rng.integers(0, 9, 1300)) + [5, 5, 1], "key": range(1303)})
    got = WK.pct_self_causal(spark.createDataFrame(pdf)).toPandas().sort_values("key")
    want = pdf.groupby("member_id").engagement.expanding().rank(pct=True).to_numpy()
    assert list(got.columns) == [*pdf.columns, "pct_self_causal"] and np.allclose(got.pct_self_causal, want)


def test_zero_variance_is_exact(spark):
    weeks = pd.date_range("2000-01-03", periods=40, freq="7D").date
    rows = [("const", w, 0.1, 0) for w in weeks] + [("tiny", w, 1e9 + (i % 2) * 1e-3, 0) for i, w in enumerate(weeks)] + [("one", weeks[0], 3.0, 0)]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["member_id", "week", "engagement", "paused"]))
    ema = WK.ema_columns(df, "engagement", "ema")
    got = ema.select("member_id", WK.zscore("engagement").alias("z"), WK.zscore("ema").alias("ze"), "ema").toPandas()
    const = got[got.member_id == "const"]
    assert const.z.isna().all() and const.ze.isna().all() and (const.ema == 0.1).all()
    assert got[got.member_id == "one"].z.isna().all()
    tiny = got[got.member_id == "tiny"]
    assert tiny.z.notna().all() and tiny.ze.notna().all() and (tiny.z > 0).sum() == 20


def test_cohorts_of_one_pass_equal_separate_ones(spark):
    dates = ["1999-01-01", "2000-01-01", "2001-01-01"]
    m, att = J.cohorts_inputs(spark, SMOKE, dates)
    scans = WK.attendance_by_member(att, dates)._jdf.queryExecution().optimizedPlan().toString()
    assert scans.count("l_shipdate#") and sum("Relation [l_" in x or "Relation [l_orderkey" in x for x in scans.split("\n")) <= 1
    got = J.job_prepare_cohorts(m, att, dates).toPandas()
    for T in dates:
        m1, all1, year1 = J.cohort_inputs(spark, SMOKE, T)
        from churnlens.plans import registered as R
        want = R._cohort(spark, SMOKE, T).toPandas()
        mine = got[got.as_of.astype(str) == T].drop(columns="as_of")
        order = lambda d: d.sort_values("MembershipID").reset_index(drop=True)[sorted(d.columns)]
        pd.testing.assert_frame_equal(order(mine), order(want), check_exact=False, rtol=1e-12)


def test_folds_with_odd_labels(spark):
    from churnlens.operators import cohorts as CO
    rows = [(f"i{i % 50}", None if i % 6 == 0 else 7 + i % 3) for i in range(240)]
    got = CO.stratified_folds(spark.createDataFrame(rows, "id string, y int"), "y", "id").toPandas()
    assert len(got) == 240 and list(got.columns) == ["id", "y", "fold"]
    sizes = got.assign(y=got.y.fillna(-1)).groupby(["y", "fold"]).size().unstack()
    assert sizes.shape == (4, 5) and (sizes.max(axis=1) - sizes.min(axis=1) <= 1).all()
