"""End-to-end jobs (what a user runs), composed from the operators.

Each job takes its inputs as DataFrames plus an explicit as-of date and returns lazy
DataFrames; only sinks, model fitting and the rank-bucket edges run Spark jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import evaluate as EV
from ..operators import outreach as OR
from ..operators import profile as PR
from ..operators import snapshot as SN
from ..operators import weekly as WK
from ..sources import fixtures as FX
from . import oracle as O


def job_weekly_panel(memberships: DataFrame, attendance: DataFrame, as_of, min_visits: int = C.MIN_VISITS_12M,
                     **kw) -> DataFrame:
    return WK.weekly_panel(memberships, attendance, as_of, min_visits, **kw)


def job_scores(panel: DataFrame, k_weeks: int = C.K_WEEKS, model=None) -> DataFrame:
    """features -> score. Without a model the deterministic surrogate score is used;
    with an MLlib model (see ``operators.ml.train_ews``) its P(churn in k weeks)."""
    feats = WK.member_features(panel)
    if model is None:
        feats = WK.surrogate_ews(feats)
    else:
        from ..operators import ml
        feats = ml.score_ews(model, feats)
    return SN.score_frame(feats, "EWS", k_weeks)


def job_snapshots(panel: DataFrame, k_weeks: int = C.K_WEEKS, model=None, relabel: bool = True) -> DataFrame:
    snap = SN.build_snapshots(job_scores(panel, k_weeks, model))
    return SN.relabel_snapshot(snap) if relabel else snap


def job_outreach(snap: DataFrame, capacity: int = C.OUTREACH_CAPACITY, ews_threshold=None,
                 recent_contacts: DataFrame | None = None, cooldown_days: int = C.COOLDOWN_DAYS):
    return OR.build_outreach(snap, capacity, ews_threshold, recent_contacts, cooldown_days)


def job_evaluate(snapshots: DataFrame, churned: DataFrame) -> DataFrame:
    return EV.band_month_matrix(snapshots, churned)


def job_prepare_cohort(memberships: DataFrame, attendance_all: DataFrame, as_of, classes=None,
                       model=None, attendance_year: DataFrame | None = None) -> DataFrame:
    """panel -> snapshot -> profile ⋈ snapshot -> class filter (one job for every cohort)."""
    att_year = attendance_year if attendance_year is not None else attendance_all
    panel = WK.weekly_panel(memberships, att_year, as_of)
    snap = job_snapshots(panel, model=model)
    prof = PR.profile(memberships, attendance_all, as_of)
    merged = PR.join_profile_snapshot(prof, snap)
    if classes:
        merged = merged.where(F.col("Churned").isin(list(classes)))
    return merged


def job_prepare_cohorts(memberships: DataFrame, attendance: DataFrame, as_ofs: list, classes=None) -> DataFrame:
    """The cohorts of several as-of dates in one pass, with their ``as_of``: rows equal to
    ``job_prepare_cohort`` of each date.

    ``memberships`` has a row per membership and ``as_of``. The attendance is read once and
    reduced to one stored row per membership (the weeks of the trailing years, the sums of
    every date); panels, windows, latest rows and profiles are then of (as_of, member), and
    percentiles are ranked inside each date."""
    from ..functions import columns as X
    from ..session import cut_lineage
    per = cut_lineage(WK.attendance_by_member(attendance, as_ofs))
    panel = WK.weekly_panels(memberships, per)
    feats = WK.surrogate_ews(WK.member_features(panel))
    snap = SN.relabel_snapshot(SN.build_snapshots(SN.score_frame(feats, carry=("as_of", "MembershipID")), by="as_of"))
    sums = per.select("MembershipID", F.inline("sums")).where(F.col("TotalAttendanceToDate") > 0)
    T = F.col("as_of")
    prof = PR.not_transferred(memberships, T).join(sums, ["MembershipID", "as_of"]).select(*PR.profile_columns(T), "as_of")
    key = X.normalize_key(F.col("MembershipID"))
    merged = prof.withColumn("member_id", key).join(
        snap.select(key.alias("member_id"), "as_of", "ews_pct", "risk_band"), ["member_id", "as_of"])
    out = merged.select(*[c for c in prof.columns if c != "as_of"], "member_id", "ews_pct", "risk_band", "as_of")
    return out.where(F.col("Churned").isin(list(classes))) if classes else out


def job_balanced(cohorts: DataFrame, sample_class: int = 3, keep_classes=(1, 2), sample_n: int = C.CLASS3_SAMPLE, id_col: str = "MembershipID") -> DataFrame:
    """``job_merge_balanced`` of cohorts that stand in one frame by ``as_of``: every cohort
    keeps ``keep_classes``, the last one also an exact, seeded sample of ``sample_class``."""
    from ..operators import cohorts as CO
    from ..session import cut_lineage
    rows = cut_lineage(cohorts.withColumn("cohort", F.col("as_of").cast("string")).drop("as_of"))
    last = rows.agg(F.max("cohort")).first()[0]
    sampled = CO.sample_exact_n(rows.where((F.col("cohort") == F.lit(last)) & (F.col("Churned") == sample_class)), sample_n, id_col, materialize=False)
    return rows.where(F.col("Churned").isin(list(keep_classes))).unionByName(sampled)


def cohorts_inputs(spark: SparkSession, sf_dir: str, as_ofs: list):
    """Memberships by date and attendance (dense over the trailing years) for
    ``job_prepare_cohorts``."""
    first, last = min(as_ofs), max(as_ofs)
    return FX.memberships_by_date(spark, sf_dir, as_ofs), FX.attendance(spark, sf_dir, None, last, dense_from=O.prev_year(first))


def cohort_inputs(spark: SparkSession, sf_dir: str, as_of):
    m = FX.memberships(spark, sf_dir, as_of)
    att_all = FX.attendance(spark, sf_dir, None, as_of, nonempty_only=True)
    att_year = FX.attendance(spark, sf_dir, O.prev_year(as_of), as_of)
    return m, att_all, att_year


def flagship(spark: SparkSession, sf_dir: str, as_of: str = "2001-01-01") -> DataFrame:
    m, att_all, att_year = cohort_inputs(spark, sf_dir, as_of)
    return job_prepare_cohort(m, att_all, as_of, attendance_year=att_year)


def job_predict(features: DataFrame, run_date, model_path: str, thresholds_path: str,
                sink: str | None = None, payment_col: str = "RegularPaymentAmount") -> DataFrame:
    """Score a profile with the stored model and thresholds and publish it for ``run_date``.

    The features are scored in place (no join back by key); a label column is dropped first.
    Returns the rows of the prediction table, re-read from ``sink`` when one is given."""
    from pyspark.ml import PipelineModel

    from ..functions import engineered as EN
    from ..operators import ml as ML
    from ..operators import predict as PD
    from ..operators import thresholds as TH
    from ..sources import sinks as SK
    from ..sources.io import read_parquet
    spark = features.sparkSession
    th = TH.thresholds_to_dict(read_parquet(spark, thresholds_path))
    scored = ML.class_probabilities(PipelineModel.load(model_path), features.drop("Churned", "label"))
    p = [F.col("p0"), F.col("p1"), F.col("p2")]
    pred = TH.apply_thresholds(p, th) if th else TH.argmax_class(p)
    scored = scored.withColumns({"PredictedClass": pred, "Confidence": PD.confidence(p)})
    out = PD.map_to_sink_schema(EN.engineer_features(scored, payment_col=payment_col), run_date=run_date)
    if sink is None:
        return out
    SK.sink_upsert_by_rundate(out, sink, run_date)
    return SK.read_sink(spark, sink).where(F.col("RunDate") == F.lit(str(run_date)).cast("date"))


def job_train(frame: DataFrame, label: str = "label", grid: dict | None = None, folds: int = 5, tune_classes=(0, 1),
              parallelism: int = 4, **tune) -> dict:
    """Search, refit, tune and report.

    The non-test rows are split into fitting and validation rows. The booster's grid (trees,
    depth, learning rate) is searched over stratified folds of the fitting rows, with the
    preprocessing fitted inside each fold, and the best point is fitted again on all of
    them; class thresholds are tuned on the validation rows (not on the test split); reports
    are of the test split, before and after the thresholds."""
    from ..operators import cohorts as CO
    from ..operators import ml as ML
    from ..operators import report as RP
    from ..operators import search as SE
    from ..operators import thresholds as TH
    X = ML.drop_columns_if_present(frame.drop("Churned", label, "is_test", "cohort", "row_id", "fold", "w"))
    num, cat = ML.select_features(X)
    id_col = "row_id" if "row_id" in frame.columns else "MembershipID"
    train_all = frame.where(~F.col("is_test"))
    test = frame.where(F.col("is_test"))
    split = CO.hash_split(train_all, F.col(id_col), 20, seed=C.SEED + 1, out="is_val")
    fit, val = split.where(~F.col("is_val")).drop("is_val"), split.where(F.col("is_val")).drop("is_val")
    found = SE.booster_search(CO.stratified_folds(fit.drop("fold"), label, id_col, folds), label, "fold", grid, parallelism,
                              numeric=num, categorical=cat)
    model = found["model"]
    opts = dict(metric="recall", min_recall=0.65, min_precision=0.50)
    opts.update(tune)
    th = TH.thresholds_to_dict(TH.threshold_search(ML.class_probabilities(model, val), label, classes=tune_classes, **opts))
    pr = ML.class_probabilities(model, test)
    p = [F.col("p0"), F.col("p1"), F.col("p2")]
    pairs = pr.select(F.col(label).alias("y"), TH.argmax_class(p).alias("pred_before"),
                      TH.apply_thresholds(p, th).alias("pred"))
    return {"model": model, "best": found["best"], "results": found["results"], "thresholds": th, "pairs": pairs,
            "report": RP.classification_report(pairs, "y", "pred"),
            "report_before": RP.classification_report(pairs, "y", "pred_before"),
            "confusion": RP.confusion_matrix(pairs, "y", "pred")}


def store_training(res: dict, path: str) -> None:
    """What ``job_train`` found, below ``path``: model, thresholds, results (the search's
    table) and the metrics document."""
    from ..operators import report as RP
    from ..sources.io import write_parquet
    spark = res["results"].sparkSession
    res["model"].write().overwrite().save(f"{path}/model")
    th = [(int(k), float(v)) for k, v in res["thresholds"].items()]
    write_parquet(spark.createDataFrame(th, "cls int, threshold double"), f"{path}/thresholds")
    write_parquet(res["results"], f"{path}/results")
    RP.save_metrics(RP.metrics_document(res["pairs"]), path)


def job_merge_balanced(cohorts: dict, keep_classes=(1, 2), sample_class: int = 3,
                       sample_n: int = C.CLASS3_SAMPLE, id_col: str = "MembershipID") -> DataFrame:
    """Union of yearly cohorts: every cohort keeps ``keep_classes``; the last one also
    contributes an exact, seeded sample of ``sample_n`` rows of ``sample_class``. The last
    cohort is materialised once (reliable checkpoint) and split, instead of being
    computed twice."""
    from ..operators import cohorts as CO
    from ..session import cut_lineage
    names = list(cohorts)
    parts = []
    for name in names[:-1]:
        parts.append((name, cohorts[name].where(F.col("Churned").isin(list(keep_classes)))))
    last = cut_lineage(cohorts[names[-1]])
    parts.append((names[-1], last.where(F.col("Churned").isin(list(keep_classes)))))
    parts.append((names[-1], CO.sample_exact_n(last.where(F.col("Churned") == sample_class), sample_n, id_col,
                                               materialize=False)))
    return CO.union_cohorts(parts)


def build_cohorts(build, as_ofs, concurrent: bool = True) -> dict:
    """``{as_of: build(as_of)}`` for independent cohorts. Building a cohort runs its eager
    steps (snapshot materialisation, rank bucket edges); with ``concurrent`` those Spark
    jobs are submitted from one driver thread per cohort so small stages of different
    cohorts share the executors instead of running back to back."""
    as_ofs = list(as_ofs)
    if not concurrent or len(as_ofs) < 2:
        return {T: build(T) for T in as_ofs}
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=len(as_ofs)) as pool:
        futures = {T: pool.submit(build, T) for T in as_ofs}
        return {T: futures[T].result() for T in as_ofs}
