"""Cohort assembly: union of yearly cohorts, exact-n deterministic sample, hash
splits and stratified folds — all distributed (no single-task ranking)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..session import cut_lineage
from . import ranking


def stable_hash(*cols: Column, seed: int = C.SEED) -> Column:
    """60-bit non-negative hash from md5 of the values and the seed. Defined with
    md5 so an independent SQL engine computes the same value."""
    s = F.concat_ws(":", *[c.cast("string") for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(s), 1, 15), 16, 10).cast("long")


def hash_split(df: DataFrame, key: Column, test_pct: int = 20, seed: int = C.SEED, out: str = "is_test") -> DataFrame:
    """Deterministic split: test when hash % 100 < test_pct. Independent of partitioning
    (unlike randomSplit). With a group key (member) it is a group split."""
    return df.withColumn(out, (stable_hash(key, seed=seed) % 100) < test_pct)


def union_cohorts(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    out = None
    for name, df in parts:
        d = df.withColumn("cohort", F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def sample_exact_n(df: DataFrame, n: int, id_col: str, seed: int = C.SEED, materialize: bool = True) -> DataFrame:
    """Exactly min(n, count) rows, those with the smallest seeded hash of the id
    (deterministic). Rows whose hash is equal (repeated ids, collisions) count one by one:
    of the hash at the cutoff the rows still wanted are taken by id, then by row hash.
    Only the cutoff reaches the driver,
    and one task orders at most n rows of that hash. The input is read several times; ``materialize``
    writes it once first — pass False when ``df`` is already a stored table."""
    h = df.withColumn("_h", stable_hash(F.col(id_col), seed=seed))
    if materialize:
        h = cut_lineage(h)
    counts = h.groupBy("_h").agg(F.count(F.lit(1)).alias("_c"))
    upto = ranking.prefix_sums(counts, "_h", ["_c"])
    cut = upto.where(F.col("cum__c") >= n).agg(F.min(F.struct("_h", (F.col("cum__c") - F.col("_c")).alias("before"))).alias("at")).first()["at"]
    if cut is None:
        return h.drop("_h")
    tied = h.where(F.col("_h") == cut["_h"]).orderBy(id_col, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).limit(n - cut["before"])
    return h.where(F.col("_h") < cut["_h"]).unionByName(tied).drop("_h")


def stratified_folds(df: DataFrame, label: str, id_col: str, k: int = 5, seed: int = C.SEED,
                     out: str = "fold") -> DataFrame:
    """fold = (position of the row inside its class in seeded-hash order - 1) % k. Rows without
    a label are a class of their own; rows of one hash (repeated ids) take positions one
    after another. The key (class, hash) keeps classes together, so one distributed
    prefix count serves all of them; per-class offsets come from a one-row-per-class table."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    h = cut_lineage(df.withColumn("_key", F.struct(F.col(label).alias("y"), stable_hash(F.col(id_col), seed=seed).alias("h"))).withColumn("_row", row))
    vc = h.groupBy("_key").agg(F.count(F.lit(1)).alias("_c"))
    ps = ranking.prefix_sums(vc, "_key", ["_c"]).select(F.col("_key").alias("_k"), (F.col("cum__c") - F.col("_c")).alias("_before"))
    r = h.join(ps, F.col("_key") == F.col("_k"))
    tie = F.row_number().over(Window.partitionBy("_key").orderBy("_row"))
    per = h.groupBy(F.col("_key.y").alias("_y")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per class: the ordered window is bounded by the number of classes
    wo = Window.orderBy("_y").rowsBetween(Window.unboundedPreceding, -1)
    offs = per.select("_y", F.coalesce(F.sum("_n").over(wo), F.lit(0)).alias("_off"))
    r = r.withColumn("_r", F.col("_before") + tie).join(offs, F.col("_key.y").eqNullSafe(F.col("_y")))
    return r.withColumn(out, ((F.col("_r") - F.col("_off") - 1) % k).cast("int")).drop("_key", "_row", "_k", "_before", "_r", "_y", "_off")


def leakage_check(train: DataFrame, test: DataFrame, key: str, target: str) -> DataFrame:
    """One row: whether the target is among the columns, repeated column names, and how
    many rows of the test part have a key that the training part has too."""
    names = train.columns
    overlap = test.select(key).join(train.select(key).distinct(), key, "left_semi").agg(F.count(F.lit(1)).alias("train_test_overlap"))
    return overlap.select(F.lit(target in names).alias("target_in_features"), F.lit(len(names) - len(set(names))).cast("long").alias("duplicate_columns"),
                          "train_test_overlap")
