"""Class-threshold tuning for 3-class probabilities.

Nothing here loops over rows or thresholds on the driver:
* ``threshold_search``: one pass buckets every probability by the grid step it
  reaches (j*0.01 <= p), a histogram per (class, step, is_class) is aggregated, and
  reverse cumulative sums over the <= 101 steps give TP / predicted counts for every
  threshold at once.
* ``threshold_grid_joint``: rows are reduced to a bounded signature (label, grid
  bucket of p0 and p1, p2 >= 0.5, preference order of the classes) before the 49
  configurations are expanded, so the expansion costs O(#signatures x 49), not
  O(rows x 49).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C

PROBS = ["p0", "p1", "p2"]


def step_index(p: Column, steps: int = C.THRESHOLD_STEPS) -> Column:
    """Largest j in [0, steps-1] with j * (1/(steps-1)) <= p, else -1 (exact at grid points)."""
    inc = 1.0 / (steps - 1)
    j0 = F.least(F.greatest(F.floor(p * (steps - 1)), F.lit(-1)), F.lit(steps - 1)).cast("int")
    up = (j0 + 1 <= steps - 1) & ((j0 + 1).cast("double") * inc <= p)
    down = (j0 >= 0) & (j0.cast("double") * inc > p)
    return F.when(p.isNull(), F.lit(-1)).when(up, j0 + 1).when(down, j0 - 1).otherwise(j0)


def _score(metric: str, prec: Column, rec: Column, f1: Column) -> Column:
    return {"f1": f1, "balanced_precision": F.lit(0.6) * rec + F.lit(0.4) * prec,
            "recall": rec, "precision": prec}.get(metric, f1)


def threshold_curve(df: DataFrame, label: str = "y", probs: list[str] = PROBS, classes=(0, 1),
                    metric: str = "recall", min_recall: float = 0.70, min_precision: float = 0.60,
                    steps: int = C.THRESHOLD_STEPS) -> DataFrame:
    """One row per (class, threshold): tp, predicted, precision, recall, f1, score, valid."""
    inc = 1.0 / (steps - 1)
    per_class = F.explode(F.array(*[
        F.struct(F.lit(c).alias("cls"), step_index(F.col(probs[c]), steps).alias("j"),
                 (F.col(label) == c).cast("int").alias("pos")) for c in classes])).alias("e")
    hist = (df.select(per_class).select("e.*")
            .groupBy("cls", "j").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("npos")))
    # the threshold grid is a parameter table of len(classes) x steps rows
    spark = df.sparkSession
    grid = spark.createDataFrame([(c, j) for c in classes for j in range(steps)], "cls int, j int")
    totals = hist.groupBy("cls").agg(F.sum("npos").alias("P"))
    h = grid.join(hist, ["cls", "j"], "left").na.fill(0, ["n", "npos"])
    # rows are bounded by classes x steps; the window partitions by class
    w = Window.partitionBy("cls").orderBy(F.col("j").desc()).rowsBetween(Window.unboundedPreceding, 0)
    h = (h.withColumn("tp", F.sum("npos").over(w)).withColumn("predicted", F.sum("n").over(w))
         .join(F.broadcast(totals), "cls"))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("P") > 0, F.col("tp") / F.col("P")).otherwise(F.lit(0.0))
    f1 = F.when(F.col("predicted") + F.col("P") > 0,
                2.0 * F.col("tp") / (F.col("predicted") + F.col("P"))).otherwise(F.lit(0.0))
    out = (h.withColumn("threshold", F.col("j").cast("double") * inc)
           .withColumn("precision", prec).withColumn("recall", rec).withColumn("f1", f1))
    out = out.withColumn("score", _score(metric, F.col("precision"), F.col("recall"), F.col("f1")))
    valid = (F.col("predicted") > 0) & (F.col("recall") >= min_recall) & (F.col("precision") >= min_precision)
    return out.withColumn("valid", valid).select(
        "cls", "j", "threshold", "tp", "predicted", "precision", "recall", "f1", "score", "valid")


def threshold_search(df: DataFrame, label: str = "y", probs: list[str] = PROBS, classes=(0, 1), n_classes: int = 3,
                     metric: str = "recall", min_recall: float = 0.70, min_precision: float = 0.60,
                     steps: int = C.THRESHOLD_STEPS) -> DataFrame:
    """Per class: the first threshold with the best score among valid ones, else 0.5;
    classes not tuned get 0.0. One row per class (cls, threshold, score)."""
    curve = threshold_curve(df, label, probs, classes, metric, min_recall, min_precision, steps)
    w = Window.partitionBy("cls").orderBy(F.col("score").desc(), F.col("j").asc())
    best = (curve.where("valid").withColumn("_r", F.row_number().over(w)).where("_r = 1")
            .select("cls", F.col("threshold").alias("best"), F.col("score").alias("best_score")))
    spark = df.sparkSession
    allc = spark.createDataFrame([(c, c in classes) for c in range(n_classes)], "cls int, tuned boolean")
    res = allc.join(best, "cls", "left")
    thr = (F.when(~F.col("tuned"), F.lit(0.0))
           .when(F.col("best").isNull(), F.lit(C.THRESHOLD_FALLBACK)).otherwise(F.col("best")))
    return res.select("cls", thr.alias("threshold"), F.col("best_score").alias("score"))


def apply_thresholds(probs: list[Column], thresholds: dict[int, float]) -> Column:
    """Highest-probability class among those meeting their threshold (ties -> lowest
    class); none -> argmax (ties -> lowest class). Missing thresholds default to 0.0."""
    keyed = [F.struct(p.alias("p"), F.lit(-c).alias("nc"), F.lit(c).alias("c")) for c, p in enumerate(probs)]
    masked = [F.when(p >= F.lit(float(thresholds.get(c, 0.0))), k) for c, (p, k) in enumerate(zip(probs, keyed))]
    best_valid = F.array_max(F.array(*masked))
    argmax = F.array_max(F.array(*keyed))
    return F.coalesce(best_valid["c"], argmax["c"]).cast("int")


def argmax_class(probs: list[Column]) -> Column:
    return apply_thresholds(probs, {c: float("inf") for c in range(len(probs))})


def thresholds_to_dict(th: DataFrame) -> dict[int, float]:
    """Collects the per-class table (one row per class: bounded)."""
    return {int(r["cls"]): float(r["threshold"]) for r in th.collect()}


def _perm_code(p: list[Column]) -> Column:
    """Preference order of classes by (probability desc, class asc), as a 3-char string."""
    keyed = [F.struct((-p[c]).alias("np"), F.lit(c).alias("c")) for c in range(3)]
    return F.concat_ws("", F.transform(F.array_sort(F.array(*keyed)), lambda s: s["c"].cast("string")))


def threshold_grid_joint(df: DataFrame, label: str = "y", probs: list[str] = PROBS, grid=C.JOINT_GRID,
                         class2: float = C.JOINT_CLASS2, weights=C.JOINT_WEIGHTS, metric: str = "balanced_f1"
                         ) -> DataFrame:
    """Score every (t0, t1) in grid x grid with t2 fixed; one row per configuration with
    its score and ``best`` marking the first best (grid order t0 then t1)."""
    p = [F.col(c) for c in probs]
    b0 = sum((F.when(p[0] >= F.lit(float(g)), 1).otherwise(0) for g in grid), F.lit(0))
    b1 = sum((F.when(p[1] >= F.lit(float(g)), 1).otherwise(0) for g in grid), F.lit(0))
    sig = (df.select(F.col(label).cast("int").alias("y"), b0.alias("b0"), b1.alias("b1"),
                     (p[2] >= F.lit(float(class2))).alias("v2"), _perm_code(p).alias("perm"))
           .groupBy("y", "b0", "b1", "v2", "perm").agg(F.count(F.lit(1)).alias("n")))
    cfg = F.explode(F.array(*[F.struct(F.lit(i0 * len(grid) + i1).alias("cfg"), F.lit(i0).alias("i0"),
                                       F.lit(i1).alias("i1")) for i0 in range(len(grid)) for i1 in range(len(grid))]))
    x = sig.select("*", cfg.alias("k")).select("y", "b0", "b1", "v2", "perm", "n", "k.*")
    valid = {0: F.col("b0") > F.col("i0"), 1: F.col("b1") > F.col("i1"), 2: F.col("v2")}
    pos = [F.substring("perm", i + 1, 1).cast("int") for i in range(3)]

    def is_valid(cls_col: Column) -> Column:
        return (F.when(cls_col == 0, valid[0]).when(cls_col == 1, valid[1]).otherwise(valid[2]))

    pred = (F.when(is_valid(pos[0]), pos[0]).when(is_valid(pos[1]), pos[1])
            .when(is_valid(pos[2]), pos[2]).otherwise(pos[0]))
    cm = x.withColumn("pred", pred).groupBy("cfg", "i0", "i1", "y", "pred").agg(F.sum("n").alias("n"))
    agg = []
    for c in range(3):
        agg += [F.sum(F.when((F.col("y") == c) & (F.col("pred") == c), F.col("n")).otherwise(0)).alias(f"tp{c}"),
                F.sum(F.when(F.col("y") == c, F.col("n")).otherwise(0)).alias(f"s{c}"),
                F.sum(F.when(F.col("pred") == c, F.col("n")).otherwise(0)).alias(f"pp{c}")]
    per = cm.groupBy("cfg", "i0", "i1").agg(*agg, F.sum("n").alias("N"))

    def f1(c):
        den = F.col(f"s{c}") + F.col(f"pp{c}")
        return F.when(den > 0, 2.0 * F.col(f"tp{c}") / den).otherwise(F.lit(0.0))

    if metric == "balanced_f1":
        score = sum((F.lit(float(weights[c])) * f1(c) for c in range(3)), F.lit(0.0))
    else:
        score = sum((F.col(f"s{c}") / F.col("N") * f1(c) for c in range(3)), F.lit(0.0))
    g = F.array(*[F.lit(float(v)) for v in grid])
    res = per.select("cfg", F.element_at(g, F.col("i0") + 1).alias("t0"), F.element_at(g, F.col("i1") + 1).alias("t1"),
                     F.lit(float(class2)).alias("t2"), score.alias("score"))
    # one row per configuration (49): the ordering window is bounded
    w = Window.orderBy(F.col("score").desc(), F.col("cfg").asc())
    return res.withColumn("best", F.row_number().over(w) == 1)
