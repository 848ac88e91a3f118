"""Operators against brute-force references on small frames (tests only)."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnlens.operators import cohorts as CO
from churnlens.operators import ranking as RK
from churnlens.operators import snapshot as SN
from churnlens.operators import thresholds as TH
from churnlens.operators import weekly as WK


def _pandas_ema(x, span=4):
    return pd.Series(x, dtype=float).ewm(span=span, adjust=False, min_periods=1).mean().to_numpy()


def test_ema_long_series_segments(spark):
    """Series longer than one closed-form segment (512 rows) stay exact."""
    rng = random.Random(7)
    rows = []
    for m, n in [("a", 1300), ("b", 3), ("c", 600)]:
        for i in range(n):
            rows.append((m, i, float(rng.randint(0, 9))))
    df = spark.createDataFrame(rows, "member_id string, week int, engagement double")
    out = WK.ema_columns(df, "engagement", "ema").toPandas().sort_values(["member_id", "week"])
    for m, g in out.groupby("member_id"):
        ref = _pandas_ema(g.engagement.to_numpy())
        assert np.allclose(g.ema.to_numpy(), ref, rtol=1e-12, atol=1e-12), m


def test_drought_runs(spark):
    eng = [0, 0, 3, 0, 0, 0, 1, 0]
    pau = [0, 0, 0, 0, 1, 0, 0, 0]
    import datetime as dt
    d0 = dt.date(2000, 1, 3)
    df = spark.createDataFrame([("m", d0 + dt.timedelta(days=7 * i), e, p) for i, (e, p) in enumerate(zip(eng, pau))],
                               "member_id string, week date, engagement int, paused int")
    f = WK.member_features(df, seasonality=False).orderBy("week").toPandas()
    assert list(f.drought) == [1, 2, 0, 1, 2, 3, 0, 1]
    assert list(f.drought_active) == [1, 2, 0, 1, 0, 1, 0, 1]


@pytest.mark.parametrize("buckets", [1, 3, 8])
def test_average_rank_matches_pandas(spark, buckets):
    rng = random.Random(buckets)
    vals = [rng.choice([0.1, 0.2, 0.2, 0.5, 0.9, None]) for _ in range(300)] + [0.5] * 100
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, s double")
    got = RK.percentile_rank(df, "s", "pct", n_buckets=buckets).toPandas().sort_values("id")
    ref = pd.Series(vals, dtype=float).rank(pct=True).to_numpy()
    assert np.allclose(got.pct.fillna(-1).to_numpy(), np.nan_to_num(ref, nan=-1))


def test_auc_and_ap_match_bruteforce(spark):
    rng = random.Random(3)
    data = [(round(rng.random(), 1), int(rng.random() < 0.3)) for _ in range(400)]
    df = spark.createDataFrame(data, "s double, y int")
    auc = RK.auc_binary(df, "s", "y", n_buckets=4).collect()[0][0]
    pos = [s for s, y in data if y]
    neg = [s for s, y in data if not y]
    bf = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc == pytest.approx(bf, abs=1e-12)
    ap = RK.average_precision(df, "s", "y", n_buckets=4).collect()[0][0]
    ref, P = 0.0, len(pos)
    for t in sorted({s for s, _ in data}, reverse=True):
        sel = [y for s, y in data if s >= t]
        hits = sum(y for s, y in data if s == t)
        ref += hits / P * (sum(sel) / len(sel))
    assert ap == pytest.approx(ref, abs=1e-12)


def test_step_index_exact_on_grid(spark):
    ps = [j * 0.01 for j in range(101)] + [0.29, 0.57, 0.999, 1.0, 0.0, 0.005]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = [r[0] for r in df.select(TH.step_index(F.col("p"))).collect()]
    grid = np.linspace(0.0, 1.0, 101)
    ref = [int(max(j for j in range(101) if grid[j] <= p)) for p in ps]
    assert got == ref


def test_apply_thresholds_ties_and_fallback(spark):
    rows = [(0.4, 0.4, 0.2), (0.2, 0.3, 0.5), (0.1, 0.1, 0.8), (1 / 3, 1 / 3, 1 / 3)]
    df = spark.createDataFrame(rows, "p0 double, p1 double, p2 double")
    th = {0: 0.35, 1: 0.35, 2: 0.9}
    got = [r[0] for r in df.select(TH.apply_thresholds([F.col("p0"), F.col("p1"), F.col("p2")], th)).collect()]

    def ref(p):
        valid = [c for c in range(3) if p[c] >= th.get(c, 0.0)]
        return max(valid, key=lambda c: p[c]) if valid else int(np.argmax(p))
    assert got == [ref(p) for p in rows]


def test_joint_grid_matches_naive(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(300):
        a, b, c = rng.random(), rng.random(), rng.random()
        t = a + b + c
        rows.append((rng.randrange(3), a / t, b / t, c / t))
    df = spark.createDataFrame(rows, "y int, p0 double, p1 double, p2 double")
    res = {(r["t0"], r["t1"]): r["score"] for r in TH.threshold_grid_joint(df).collect()}
    for (t0, t1), score in list(res.items())[:10]:
        pred = []
        for y, a, b, c in rows:
            p = (a, b, c)
            th = {0: t0, 1: t1, 2: 0.5}
            valid = [k for k in range(3) if p[k] >= th[k]]
            pred.append(max(valid, key=lambda k: p[k]) if valid else int(np.argmax(p)))
        ys = [r[0] for r in rows]
        f1s = []
        for k in range(3):
            tp = sum(1 for y, q in zip(ys, pred) if y == k and q == k)
            den = ys.count(k) + pred.count(k)
            f1s.append(2 * tp / den if den else 0.0)
        assert score == pytest.approx(1.5 * f1s[0] + 1.5 * f1s[1] + 1.0 * f1s[2], abs=1e-12)


def test_sample_exact_n_and_folds(spark):
    df = spark.createDataFrame([(f"id{i}", i % 3) for i in range(500)], "id string, y int")
    s = CO.sample_exact_n(df, 123, "id")
    assert s.count() == 123
    assert CO.sample_exact_n(df, 10_000, "id").count() == 500
    again = spark.createDataFrame([(f"id{i % 7}", i) for i in range(70)] + [(None, -1)], "id string, x int")
    for n in (0, 1, 10, 33, 70, 71, 90):
        got = [r.x for r in CO.sample_exact_n(again, n, "id").collect()]
        assert len(got) == len(set(got)) == min(n, 71)
    f = CO.stratified_folds(df, "y", "id", k=5).groupBy("y", "fold").count().collect()
    sizes = {}
    for r in f:
        sizes.setdefault(r["y"], []).append(r["count"])
    for y, c in sizes.items():
        assert max(c) - min(c) <= 1 and len(c) == 5


def test_exact_quantiles_match_numpy(spark):
    rng = random.Random(5)
    vals = [rng.choice([1.0, 2.0, 2.0, 3.5, 7.0, 10.0]) for _ in range(203)] + [None, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0, 0.33]
    got = RK.exact_quantiles(df, "x", probs, n_buckets=3)
    ref = np.quantile([v for v in vals if v is not None], probs)
    assert np.allclose(got, ref)


def test_rank_with_a_key_holding_a_third_of_rows(spark):
    rng = random.Random(13)
    vals = [0.42] * 400 + [round(rng.random(), 3) for _ in range(800)] + [None] * 30
    rng.shuffle(vals)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, s double")
    got = RK.percentile_rank(df, "s", "pct", n_buckets=8).toPandas().sort_values("id")
    ref = pd.Series(vals, dtype=float).rank(pct=True).to_numpy()
    assert len(got) == len(vals)
    assert np.allclose(got.pct.fillna(-1).to_numpy(), np.nan_to_num(ref, nan=-1))


def test_latest_rows_keep_one_of_ties(spark):
    rows = [("a", 1, 0, 1.0), ("a", 2, 0, 2.0), ("a", 2, 0, 3.0), ("a", 3, 1, 4.0), ("b", 5, 1, 1.0), ("b", 5, 1, 1.0), ("c", 1, None, 9.0)]
    df = spark.createDataFrame(rows, "member_id string, week int, paused int, x double")
    best = {r.member_id: r for r in SN.latest_preferring_nonpaused(df).collect()}
    assert SN.latest_preferring_nonpaused(df).count() == 3
    assert best["a"].week == 2 and best["a"].x in (2.0, 3.0) and best["b"].week == 5 and best["c"].week == 1
    last = SN.latest_per_member(df).collect()
    assert sorted((r.member_id, r.week) for r in last) == [("a", 3), ("b", 5), ("c", 1)]
