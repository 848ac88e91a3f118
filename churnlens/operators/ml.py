"""MLlib training and scoring.

* EWS model: binary ``GBTClassifier`` on the weekly feature panel, class weight
  max(1, neg/pos) as ``weightCol``, group (member) hash split for the holdout.
* Churn model: 3-class booster (``stages.ClassBooster``) with class weights, inside a
  ``Pipeline`` whose preprocessing is exact median / mode imputation, scaling, and one-hot
  encoding, all fitted with the pipeline; unseen categories become all zeros.
* ``grid_search_cv``: ``CrossValidator`` of a forest over a 2x2x2 grid with a stratified
  ``foldCol`` and weighted F1; ``search.booster_search`` is that of the booster.
Fitting runs Spark jobs; inputs are checkpointed first so the repeated passes of
tree training and CV read a materialised, lineage-free table.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import _FitMultipleIterator
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from .. import config as C
from ..session import cut_lineage, stored_for_fits
from . import cohorts
from .ranking import exact_quantiles_many
from .stages import CategoryIndexer, ClassBooster, ClassBoosterModel, MedianModeImputer, modes, q  # noqa: F401
from .weekly import EWS_FEATURES

#: Rows of one task of a forest's fit, in which each row goes through every tree.
FOREST_ROWS_PER_TASK = 10_000
# Columns removed before training (leakage, pause, covid, weak, ids).
LEAKAGE_COLUMNS = ["DaysToContractEnd", "end_date"]
PAUSE_COLUMNS = ["WeeksPausedToDate", "PauseCount", "TotalDaysPaused", "CurrentlyPaused", "DaysSinceLastPauseEnded",
                 "LongestPauseDuration", "AvgPauseDuration"]
COVID_COLUMNS = ["COVID19_PauseCount"]
WEAK_COLUMNS = ["Discount", "DaysSinceLastVisit"]
ID_COLUMNS = ["MembershipID", "member_id"]
# The model's feature order at prediction time.
MODEL_FEATURES = ["Gender", "Age", "SubCategory", "Category", "Channel", "ClubName", "MembershipTypeDesc",
                  "RegularPayment", "Amount", "Base Amount", "PaymentFrequency", "Term", "TermDays", "BillingDay",
                  "Lump Sum Flag", "DaysSinceLastAccessed", "TenureDays", "DaysSinceOriginalStart",
                  "TotalAttendanceToDate", "Visits_Last30d", "Visits_Last90d", "Transferred_IN", "Transferred_OUT",
                  "EndedWithinCoolingPeriod", "ews_pct", "risk_band"]


def drop_columns_if_present(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    names = LEAKAGE_COLUMNS + PAUSE_COLUMNS + COVID_COLUMNS + WEAK_COLUMNS + ID_COLUMNS + (extra or [])
    return df.drop(*[c for c in names if c in df.columns])


def ensure_columns(df: DataFrame, cols: list[str] = MODEL_FEATURES, fill=0) -> DataFrame:
    """Absent model features become the constant ``fill`` (the source's behaviour)."""
    for c in cols:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(fill))
    return df


def select_features(df: DataFrame, exclude: list[str] = ()) -> tuple[list[str], list[str]]:
    """numeric = numeric or boolean types (booleans are cast to int first, not dropped);
    categorical = strings; other types are not used."""
    num, cat = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, (NumericType, BooleanType)):
            num.append(f.name)
        elif isinstance(f.dataType, StringType):
            cat.append(f.name)
    return num, cat


def exact_medians(df: DataFrame, cols: list[str]) -> dict[str, float]:
    """Exact medians (linear interpolation, as pandas/numpy) of all columns from one pass of
    distributed prefix counts (no single-task map of distinct values)."""
    return {c: v[0] if v[0] is not None else 0.0 for c, v in exact_quantiles_many(df, cols, [0.5]).items()}


def preprocess_stages(df: DataFrame, numeric: list[str], categorical: list[str], scale: bool = True) -> list:
    """impute(median) -> assemble -> scale  ||  impute(mode) -> index -> one-hot; others
    dropped. Nothing is fitted here: each stage learns from the rows its pipeline is fitted
    on, in cross-validation those of the fold's training part."""
    stages = [MedianModeImputer(numericCols=numeric, categoricalCols=categorical)]
    num_in = [f"__imp_{c}" for c in numeric]
    stages.append(VectorAssembler(inputCols=num_in, outputCol="__num", handleInvalid="keep"))
    if scale:
        # population sigma as the source's scaler; trees are scale-invariant anyway
        stages.append(StandardScaler(inputCol="__num", outputCol="__num_s", withMean=True, withStd=True))
    idx_out = [f"__idx_{c}" for c in categorical]
    oh_out = [f"__oh_{c}" for c in categorical]
    if categorical:
        stages.append(CategoryIndexer(inputCols=[f"__imp_{c}" for c in categorical], outputCols=idx_out))
        # the indexer's "unseen" index is the last one, which dropLast removes: all zeros
        stages.append(OneHotEncoder(inputCols=idx_out, outputCols=oh_out, dropLast=True))
    stages.append(VectorAssembler(inputCols=["__num_s" if scale else "__num"] + oh_out, outputCol="features"))
    return stages


def class_weight_col(label: str, weights: dict = C.CLASS_WEIGHTS) -> F.Column:
    expr = None
    for k, v in weights.items():
        expr = F.when(F.col(label) == k, F.lit(float(v))) if expr is None else expr.when(F.col(label) == k, F.lit(float(v)))
    return expr.otherwise(F.lit(1.0))


def _features_of(df: DataFrame, label: str, numeric, categorical, *more: str) -> tuple[list[str], list[str]]:
    if numeric is not None and categorical is not None:
        return numeric, categorical
    return select_features(drop_columns_if_present(df), exclude=[label, "w", "Churned", "fold", "is_test", "cohort", "y", *more])


def train_churn_3class(df: DataFrame, label: str = "label", num_trees: int = C.NUM_TREES[0], max_depth: int = C.MAX_DEPTHS[1],
                       seed: int = C.SEED, numeric=None, categorical=None, learning_rate: float = C.LEARNING_RATES[0]) -> PipelineModel:
    """Preprocessing and the 3-class booster, fitted on all rows of ``df``."""
    numeric, categorical = _features_of(df, label, numeric, categorical)
    data = df.withColumn("w", class_weight_col(label))
    pre = Pipeline(stages=preprocess_stages(data, numeric, categorical)).fit(data)
    # the rounds read the assembled features from a stored table, not the preprocessing again
    ready = stored_for_fits(pre.transform(data).select(label, "w", "features"))
    booster = ClassBooster(labelCol=label, numTrees=num_trees, maxDepth=max_depth, learningRate=learning_rate, seed=seed).fit(ready)
    return PipelineModel([*pre.stages, booster])


def train_forest(df: DataFrame, label: str = "label", num_trees: int = C.NUM_TREES[0], max_depth: int = C.MAX_DEPTHS[1],
                 seed: int = C.SEED, numeric=None, categorical=None) -> PipelineModel:
    """Preprocessing and a random forest with class weights."""
    numeric, categorical = _features_of(df, label, numeric, categorical)
    data = df.withColumn("w", class_weight_col(label))
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", weightCol="w", numTrees=num_trees,
                                maxDepth=max_depth, subsamplingRate=C.ROW_SHARE, featureSubsetStrategy="sqrt", seed=seed)
    return Pipeline(stages=preprocess_stages(data, numeric, categorical) + [rf]).fit(data)


class GridPipeline(Pipeline):
    """A pipeline for a grid of its last stage's parameters: for all points the stages before
    are fitted once on the rows given (in cross-validation those of the fold's training part)
    and their result is stored."""

    def _prepared(self, df: DataFrame):
        *first, last = self.getStages()
        pre = Pipeline(stages=first).fit(df)
        cols = [last.getOrDefault(p) for p in (last.labelCol, last.featuresCol, last.weightCol)]
        return pre, last, stored_for_fits(pre.transform(df).select(*cols), FOREST_ROWS_PER_TASK)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        pre, last, ready = self._prepared(dataset)
        return PipelineModel([*pre.stages, last.fit(ready)])

    def fitMultiple(self, dataset: DataFrame, paramMaps):
        pre, last, ready = self._prepared(dataset)
        return _FitMultipleIterator(lambda i: PipelineModel([*pre.stages, last.fit(ready, paramMaps[i])]), len(paramMaps))


def grid_search_cv(df: DataFrame, label: str = "label", fold_col: str = "fold", grid: dict | None = None,
                   parallelism: int = 2, seed: int = C.SEED, numeric=None, categorical=None):
    """2x2x2 grid, k folds from ``fold_col``, weighted F1, refit on all rows."""
    data = cut_lineage(df.withColumn("w", class_weight_col(label)))
    if numeric is None or categorical is None:
        numeric, categorical = select_features(drop_columns_if_present(df), exclude=[label, "w", "Churned", fold_col,
                                                                                     "is_test", "cohort", "y"])
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", weightCol="w", subsamplingRate=0.8,
                                featureSubsetStrategy="sqrt", seed=seed)
    g = grid or {"numTrees": C.NUM_TREES, "maxDepth": C.MAX_DEPTHS, "minInstancesPerNode": [1, 5]}
    pg = ParamGridBuilder()
    for k, vals in g.items():
        pg = pg.addGrid(rf.getParam(k), vals)
    pipe = GridPipeline(stages=preprocess_stages(data, numeric, categorical) + [rf])
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="f1")
    n_folds = int(data.agg(F.max(fold_col)).collect()[0][0]) + 1
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=pg.build(), evaluator=ev, foldCol=fold_col,
                        numFolds=n_folds, parallelism=parallelism, seed=seed)
    return cv.fit(data)


def train_logistic(df: DataFrame, label: str = "label", numeric=None, categorical=None) -> PipelineModel:
    numeric, categorical = _features_of(df, label, numeric, categorical)
    data = df.withColumn("w", class_weight_col(label))
    lr = LogisticRegression(labelCol=label, featuresCol="features", weightCol="w", family="multinomial", maxIter=50)
    return Pipeline(stages=preprocess_stages(data, numeric, categorical) + [lr]).fit(data)


def class_probabilities(model, df: DataFrame, n_classes: int = 3) -> DataFrame:
    out = model.transform(df)
    arr = vector_to_array(F.col("probability"))
    return out.select("*", *[arr[i].alias(f"p{i}") for i in range(n_classes)])


def weighted_f1(pred: DataFrame, label: str = "label") -> float:
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="f1")
    return ev.evaluate(pred)


def top_features(model: PipelineModel, data: DataFrame, k: int = 5) -> DataFrame:
    """The k largest importances with names from the assembled vector's metadata."""
    tree = model.stages[-1]
    meta = model.transform(data.limit(1)).schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    names = {a["idx"]: a["name"] for group in meta.values() for a in group}
    imp = tree.importances if isinstance(tree, ClassBoosterModel) else tree.featureImportances.toArray().tolist()
    rows = [(names.get(i, str(i)), float(v)) for i, v in enumerate(imp)]
    spark = data.sparkSession
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc()).limit(k)


# ---------------------------------------------------------------- EWS model

def build_ews_dataset(features_with_label: DataFrame, label: str = "y_nextk", fill: float = 0.0) -> DataFrame:
    """15 candidate features (NULL z-scores filled with ``fill``), label, group and meta."""
    cols = [c for c in EWS_FEATURES if c in features_with_label.columns]
    return features_with_label.select(
        "member_id", "week", "engagement", *[F.coalesce(F.col(c).cast("double"), F.lit(fill)).alias(c) for c in cols],
        F.col(label).cast("int").alias("label"))


def pos_weight(train: DataFrame, label: str = "label") -> DataFrame:
    """max(1, neg / (pos + 1e-6)) as a one-row DataFrame."""
    a = train.agg(F.sum(F.col(label)).alias("pos"), F.count(F.lit(1)).alias("n"))
    return a.select(F.greatest(F.lit(1.0), (F.col("n") - F.col("pos")) / (F.col("pos") + F.lit(1e-6))).alias("pos_weight"))


def train_ews(ds: DataFrame, max_iter: int = C.EWS_ITERATIONS, max_depth: int = 6, step: float = 0.05, test_pct: int = 20,
              seed: int = C.SEED):
    """Group split by member, class weight on positives, GBT. Returns (model, test rows)."""
    cols = [c for c in EWS_FEATURES if c in ds.columns]
    split = cohorts.hash_split(ds, F.col("member_id"), test_pct, seed)
    train = stored_for_fits(split.where(~F.col("is_test")))
    pw = pos_weight(train).collect()[0]["pos_weight"]
    train = train.withColumn("w", F.when(F.col("label") == 1, F.lit(float(pw))).otherwise(F.lit(1.0)))
    gbt = GBTClassifier(labelCol="label", featuresCol="features", weightCol="w", maxIter=max_iter, maxDepth=max_depth,
                        stepSize=step, seed=seed)
    model = Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep"), gbt]).fit(train)
    return model, split.where(F.col("is_test"))


def score_ews(model, feats: DataFrame, out: str = "EWS") -> DataFrame:
    """P(churn in k weeks) for every member-week (NULL z-scores filled with 0)."""
    cols = [c for c in EWS_FEATURES if c in feats.columns]
    filled = feats.select("*", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"__f_{c}") for c in cols])
    renamed = filled
    for c in cols:
        renamed = renamed.withColumnRenamed(c, f"__o_{c}").withColumnRenamed(f"__f_{c}", c)
    scored = model.transform(renamed)
    scored = scored.withColumn(out, vector_to_array(F.col("probability"))[1])
    for c in cols:
        scored = scored.drop(c).withColumnRenamed(f"__o_{c}", c)
    return scored.drop("features", "rawPrediction", "probability", "prediction")
