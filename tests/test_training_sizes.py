"""The registered model queries train at the full sizes."""

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.tuning import CrossValidator

from churnlens import config as C
from churnlens.operators import ml as ML
from churnlens.plans import registered as R
from churnlens.session import get_spark


class Seen(Exception):
    pass


@pytest.fixture(scope="module")
def spark():
    yield get_spark("local[4]", shuffle_partitions=8)


def stop(seen):
    def fit(self, *args, **kwargs):
        seen.append(self)
        raise Seen
    return fit


@pytest.mark.parametrize("query", [R.q_train_ews, R.q_score_ews, R.q_snap_model])
def test_ews_queries_run_all_iterations(spark, monkeypatch, query):
    from pyspark.sql import functions as F
    seen = []
    frame = spark.range(20).select(F.col("id").alias("member_id"), F.lit(1).alias("label"), *[F.lit(0.0).alias(c) for c in ML.EWS_FEATURES])
    monkeypatch.setattr(R, "_EWS_MODELS", {})
    monkeypatch.setattr(R, "_ews_ds", lambda spark, sf_dir: frame)
    for other in ("_features", "_panel_flags"):
        monkeypatch.setattr(R, other, lambda spark, sf_dir: frame)
    monkeypatch.setattr(GBTClassifier, "fit", stop(seen))
    with pytest.raises(Seen):
        query(spark, "none")
    assert seen[0].getMaxIter() == C.EWS_ITERATIONS == 500


def test_grid_search_runs_the_whole_grid(spark, monkeypatch):
    from pyspark.sql import functions as F
    seen = []
    frame = spark.range(60).select(F.concat(F.lit("r"), F.col("id")).alias("row_id"), (F.col("id") % 3).cast("int").alias("label"),
                                   F.lit(False).alias("is_test"), F.col("id").cast("double").alias("Age"), F.lit("a").alias("Gender"))
    monkeypatch.setattr(R, "_train_frame", lambda spark, sf_dir: frame)
    monkeypatch.setattr(CrossValidator, "fit", stop(seen))
    with pytest.raises(Seen):
        R.q_cv(spark, "none")
    got = [{p.name: v for p, v in m.items()} for m in seen[0].getEstimatorParamMaps()]
    assert len(got) == 8 and {m["numTrees"] for m in got} == {400, 500} == set(C.NUM_TREES)


@pytest.mark.parametrize("query", [R.q_booster_search, R.q_job_predict_model, R.q_job_train, R.q_model_selection])
def test_queries_of_the_training_job_search_the_whole_grid(spark, monkeypatch, query):
    from pyspark.sql import functions as F
    from churnlens.operators import search as SE
    seen = []
    frame = spark.range(60).select(F.concat(F.lit("r"), F.col("id")).alias("row_id"), (F.col("id") % 3).cast("int").alias("label"),
                                   F.lit(False).alias("is_test"), F.col("id").cast("double").alias("Age"), F.lit("a").alias("Gender"))
    monkeypatch.setattr(R, "_TRAINED", {})
    monkeypatch.setattr(R, "_train_frame", lambda spark, sf_dir: frame)

    def search(df, label, fold_col, grid, *args, **kwargs):
        seen.append(grid)
        raise Seen
    monkeypatch.setattr(SE, "booster_search", search)
    with pytest.raises(Seen):
        query(spark, "none")
    assert (seen[0] or SE.GRID) == {"numTrees": [400, 500], "maxDepth": [5, 6], "learningRate": [0.05, 0.1]}


def test_stored_booster_has_all_rounds(spark, monkeypatch):
    from pyspark.sql import functions as F
    seen = []
    frame = spark.range(60).select((F.col("id") % 3).cast("int").alias("label"), F.lit(False).alias("is_test"), F.col("id").cast("double").alias("Age"), F.lit("a").alias("Gender"))
    monkeypatch.setattr(R, "_train_frame", lambda spark, sf_dir: frame)
    monkeypatch.setattr(GBTClassifier, "fit", stop(seen))
    with pytest.raises(Seen):
        R.q_save_model(spark, "none")
    assert seen[0].getMaxIter() == 500
