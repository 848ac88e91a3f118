"""Distribution, null-profile, confusion-matrix and classification-report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def class_distribution(df: DataFrame, col: str) -> DataFrame:
    """count and % share per value (the share uses a total over the grouped rows,
    one row per class, so the un-partitioned window is bounded by the class count)."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))


def confusion_counts(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """(y, pred, n) — at most classes^2 rows after partial aggregation."""
    return df.groupBy(F.col(y).cast("int").alias("y"), F.col(pred).cast("int").alias("pred")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, y: str = "y", pred: str = "pred", classes=(0, 1, 2)) -> DataFrame:
    """Rows = true class, columns pred_0.. = counts (pivot with fixed values, 0-filled)."""
    cc = confusion_counts(df, y, pred)
    pv = cc.groupBy("y").pivot("pred", list(classes)).agg(F.sum("n"))
    return pv.select("y", *[F.coalesce(F.col(str(c)), F.lit(0)).cast("long").alias(f"pred_{c}") for c in classes])


def classification_report(df: DataFrame, y: str = "y", pred: str = "pred", classes=(0, 1, 2),
                          counts: DataFrame | None = None) -> DataFrame:
    """Per class precision / recall / f1 / support, then accuracy, macro and weighted
    averages (zero_division = 0). Built from the confusion counts (<= classes^2 rows)."""
    cc = counts if counts is not None else confusion_counts(df, y, pred)
    agg = []
    for c in classes:
        agg += [F.sum(F.when((F.col("y") == c) & (F.col("pred") == c), F.col("n")).otherwise(0)).alias(f"tp{c}"),
                F.sum(F.when(F.col("y") == c, F.col("n")).otherwise(0)).alias(f"s{c}"),
                F.sum(F.when(F.col("pred") == c, F.col("n")).otherwise(0)).alias(f"pp{c}")]
    one = cc.agg(*agg, F.sum("n").alias("N"))

    def sdiv(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    rows = []
    for c in classes:
        p = sdiv(F.col(f"tp{c}").cast("double"), F.col(f"pp{c}"))
        r = sdiv(F.col(f"tp{c}").cast("double"), F.col(f"s{c}"))
        f = sdiv(2.0 * F.col(f"tp{c}"), F.col(f"s{c}") + F.col(f"pp{c}"))
        rows.append((str(c), p, r, f, F.col(f"s{c}")))
    n = len(classes)
    acc = sdiv(sum((F.col(f"tp{c}") for c in classes), F.lit(0)).cast("double"), F.col("N"))
    macro = [sum((r[i] for r in rows), F.lit(0.0)) / n for i in (1, 2, 3)]
    weighted = [sdiv(sum((r[i] * r[4] for r in rows), F.lit(0.0)), F.col("N")) for i in (1, 2, 3)]
    rows.append(("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), acc, F.col("N")))
    rows.append(("macro avg", *macro, F.col("N")))
    rows.append(("weighted avg", *weighted, F.col("N")))
    structs = [F.struct(F.lit(k).alias("label"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        s.cast("long").alias("support")) for k, p, r, f, s in rows]
    return one.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def balanced_accuracy(df: DataFrame, y: str = "y", pred: str = "pred", classes=(0, 1, 2)) -> DataFrame:
    rep = classification_report(df, y, pred, classes)
    return rep.where(F.col("label").isin([str(c) for c in classes])).agg(F.avg("recall").alias("balanced_accuracy"))


def null_profile(df: DataFrame) -> DataFrame:
    """Null % per column in one pass (one aggregate), unpivoted, > 0 only, descending."""
    cols = df.columns
    one = df.agg(*[(F.avg(F.col(f"`{c}`").isNull().cast("double")) * 100.0).alias(f"c{i}") for i, c in enumerate(cols)])
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("null_pct"))
                             for i, c in enumerate(cols)]))
    return one.select(st.alias("s")).select("s.*").where(F.col("null_pct") > 0)


def prediction_distribution(df: DataFrame, pred: str = "PredictedClass") -> DataFrame:
    return class_distribution(df, pred)


def metrics_document(pairs: DataFrame, y: str = "y", pred: str = "pred", train_rows: int | None = None, classes=(0, 1, 2)) -> DataFrame:
    """One row: accuracy, balanced accuracy, tested and training rows, the share of every
    true class, the confusion counts, the report by label and the same report as text. All
    of it follows from the confusion counts (at most classes^2 rows, read once)."""
    counts = cut_lineage(confusion_counts(pairs, y, pred))
    rep = classification_report(pairs, y, pred, classes, counts=counts)
    total = F.sum("n").over(Window.partitionBy())
    shares = counts.groupBy("y").agg(F.sum("n").alias("n")).select(F.struct(F.col("y").alias("label"), F.col("n").alias("rows"), (F.col("n") / total).alias("share")).alias("s"))
    number = lambda c: F.format_string("%10s", F.coalesce(F.format_number(c, 4), F.lit("")))
    order = {**{str(c): i for i, c in enumerate(classes)}, "accuracy": 100, "macro avg": 101, "weighted avg": 102}
    place = F.create_map(*[F.lit(x) for kv in order.items() for x in kv])[F.col("label")]
    line = F.concat(F.format_string("%14s", "label"), number("precision"), number("recall"), number("f1"), F.format_string("%10d", "support"))
    head = "".join([" " * 14, *[f"{x:>10}" for x in ("precision", "recall", "f1", "support")]])
    one = rep.agg(F.max(F.when(F.col("label") == "accuracy", F.col("f1"))).alias("accuracy"),
                  F.avg(F.when(F.col("label").isin([str(c) for c in classes]), F.col("recall"))).alias("balanced_accuracy"),
                  F.max(F.when(F.col("label") == "accuracy", F.col("support"))).alias("test_rows"),
                  F.array_sort(F.collect_list(F.struct(place.alias("place"), "label", "precision", "recall", "f1", "support"))).alias("report"),
                  F.array_sort(F.collect_list(F.struct(place.alias("place"), line.alias("line")))).alias("lines"))
    text = F.array_join(F.concat(F.array(F.lit(head)), F.transform("lines", lambda x: x["line"])), "\n")
    # three tables of one row each
    return (one.withColumn("_k", F.lit(1))
            .join(shares.agg(F.array_sort(F.collect_list("s")).alias("classes")).withColumn("_k", F.lit(1)), "_k")
            .join(counts.agg(F.array_sort(F.collect_list(F.struct("y", "pred", "n"))).alias("confusion")).withColumn("_k", F.lit(1)), "_k")
            .select("accuracy", "balanced_accuracy", F.lit(train_rows).cast("long").alias("train_rows"), "test_rows", "classes", "confusion",
                    F.transform("report", lambda x: x.dropFields("place")).alias("report"), text.alias("text")))


def save_metrics(document: DataFrame, path: str) -> None:
    """The document as JSON below ``path``/metrics and its text below ``path``/report."""
    stored = cut_lineage(document)
    stored.drop("text").coalesce(1).write.mode("overwrite").json(f"{path}/metrics")
    stored.select("text").coalesce(1).write.mode("overwrite").text(f"{path}/report")
