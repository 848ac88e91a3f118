"""Distributed global ordering statistics: prefix sums over an ordered key, average
ranks / percentiles, ROC-AUC (Mann-Whitney) and step-wise average precision.

No operator here uses an un-partitioned window over the data. The key's distinct
values are aggregated (partial aggregation, so a hot key costs one row) and stored dealt
by range of the key, each with the number of its range; they are prefix-summed inside each
range and offset by the totals of the ranges before it (a table with one row per range).
There are as many ranges as shuffle partitions, or as many as keep a range at
``ROWS_PER_RANGE`` distinct values, whichever is more; no edge reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Distinct values that one task sorts.
ROWS_PER_RANGE = 1_000_000
#: Most ranges whose offsets are sent to every task; beyond it they are joined by shuffle.
BROADCAST_RANGES = 1_000_000


def shuffle_partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def ranged(vc: DataFrame, key: str, n_buckets: int | None = None) -> tuple[DataFrame, int]:
    """``vc`` stored with ``_b``, the number of its key's range (ascending), and how many
    ranges there may be."""
    def stored(n: int) -> DataFrame:
        return cut_lineage(vc.repartitionByRange(n, key).withColumn("_b", F.spark_partition_id()))

    n = n_buckets or shuffle_partitions(vc)
    out = stored(n)
    if not n_buckets:
        wanted = -(-out.count() // ROWS_PER_RANGE)  # row counts of the stored files
        if wanted > n:
            n, out = wanted, stored(wanted)
    return out, n


def prefix_sums(vc: DataFrame, key: str, cols: list[str], n_buckets: int | None = None) -> DataFrame:
    """``vc`` has one row per distinct non-NULL ``key``. Adds ``cum_<c>`` (inclusive
    prefix sum in ascending key order) and ``tot_<c>`` for each column ``c``.

    Action: ``vc`` is written once, dealt by range (twice if it has more than
    ``ROWS_PER_RANGE`` rows a shuffle partition)."""
    b, n = ranged(vc, key, n_buckets)
    per = b.groupBy("_b").agg(*[F.sum(c).alias(f"_bt_{c}") for c in cols])
    # one row per range: an ordered window over them is small
    wo = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    wall = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offs = per.select("_b", *[F.coalesce(F.sum(f"_bt_{c}").over(wo), F.lit(0)).alias(f"_off_{c}") for c in cols],
                      *[F.sum(f"_bt_{c}").over(wall).alias(f"tot_{c}") for c in cols])
    wb = Window.partitionBy("_b").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    out = b.join(F.broadcast(offs) if n <= BROADCAST_RANGES else offs, "_b")
    for c in cols:
        out = out.withColumn(f"cum_{c}", F.col(f"_off_{c}") + F.sum(c).over(wb))
    return out.drop("_b", *[f"_off_{c}" for c in cols])


def average_rank(df: DataFrame, key: str, out_rank: str = "_avg_rank", out_n: str = "_n",
                 n_buckets: int | None = None) -> DataFrame:
    """Average (tie-mean) rank of ``key`` over all rows, and the count of non-NULL keys.
    NULL keys get NULL.

    Attaching the per-key ranks back to the rows is skew-safe: keys holding more than
    N / (4P) rows (at most 4P keys by pigeonhole, P = shuffle partitions) are attached with
    a broadcast join; all other rows use a shuffle join on (key, salt) where hot-key and
    NULL-key rows carry a salt of 1 to 64 P, so they spread over partitions instead of
    landing in one task, and find no partner on that side. The other side's salt of 0 is
    an expression of the key: a literal would be moved out of the join keys."""
    parts = shuffle_partitions(df)
    vc = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
    ps = prefix_sums(vc, key, ["_c"], n_buckets)
    ranks = ps.select(key, (F.col("cum__c") - F.col("_c") + (F.col("_c") + 1) / 2.0).alias("_r"),
                      F.col("tot__c").alias("_rn_n"), F.col("_c"))
    is_hot = F.col("_c") * F.lit(4 * parts) > F.col("_rn_n")
    hot = ranks.where(is_hot).select(key, F.col("_r").alias("_hot_r"), F.col("_rn_n").alias("_hot_n"))
    nought = F.pmod(F.xxhash64(key), F.lit(1)).cast("int")
    cold = ranks.where(~is_hot).select(key, F.col("_r").alias("_cold_r"), F.col("_rn_n").alias("_cold_n"), nought.alias("_salt"))
    j = df.join(F.broadcast(hot), key, "left")
    spread = (F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(64 * parts)) + 1).cast("int")
    j = j.withColumn("_salt", F.when(F.col("_hot_r").isNull() & F.col(key).isNotNull(), F.lit(0)).otherwise(spread))
    j = j.join(cold, [key, "_salt"], "left")
    return (j.withColumn(out_rank, F.coalesce("_hot_r", "_cold_r")).withColumn(out_n, F.coalesce("_hot_n", "_cold_n"))
            .drop("_hot_r", "_hot_n", "_cold_r", "_cold_n", "_salt"))


def percentile_rank(df: DataFrame, key: str, out: str, n_buckets: int | None = None) -> DataFrame:
    """pandas ``rank(pct=True)`` (method='average') over the whole DataFrame."""
    r = average_rank(df, key, "_ar", "_an", n_buckets)
    return r.withColumn(out, F.col("_ar") / F.col("_an")).drop("_ar", "_an")


def percentile_rank_by(df: DataFrame, key: str, by: str, out: str) -> DataFrame:
    """``percentile_rank`` inside each value of ``by`` (which must not be NULL), however many
    rows one of them holds: the rank of (by, key) over all rows, less the rows of the values
    before it. The table of those offsets has one row a value of ``by``."""
    pair = F.when(F.col(key).isNotNull(), F.struct(F.col(by).alias("b"), F.col(key).alias("k")))
    ranked = average_rank(df.withColumn("_pair", pair), "_pair", "_ar", "_an").drop("_pair", "_an")
    per = df.groupBy(F.col(by).alias("_by")).agg(F.count(key).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_by").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = per.select("_by", "_n", before.alias("_before"))
    return (ranked.join(offsets, F.col(by) == F.col("_by")).withColumn(out, (F.col("_ar") - F.col("_before")) / F.col("_n"))
            .drop("_by", "_n", "_before", "_ar"))


def score_label_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    return (df.where(F.col(score).isNotNull())
            .groupBy(score).agg(F.count(F.lit(1)).alias("c"),
                                F.sum(F.col(label).cast("long")).alias("pos")))


def auc_binary(df: DataFrame, score: str, label: str, n_buckets: int | None = None) -> DataFrame:
    """ROC-AUC via Mann-Whitney U on average ranks (ties count one half). One row."""
    ps = prefix_sums(score_label_counts(df, score, label), score, ["c", "pos"], n_buckets)
    ar = F.col("cum_c") - F.col("c") + (F.col("c") + 1) / 2.0
    agg = ps.agg(F.sum(F.col("pos") * ar).alias("rs"), F.max("tot_pos").alias("P"), F.max("tot_c").alias("N_all"))
    P = F.col("P").cast("double")
    N = (F.col("N_all") - F.col("P")).cast("double")
    return agg.select((F.col("rs") - P * (P + 1) / 2.0) / (P * N)).toDF("auc")


def average_precision(df: DataFrame, score: str, label: str, n_buckets: int | None = None) -> DataFrame:
    """Step-wise AP: sum over distinct scores (descending) of (delta recall) x precision."""
    ps = prefix_sums(score_label_counts(df, score, label), score, ["c", "pos"], n_buckets)
    tp = F.col("tot_pos") - F.col("cum_pos") + F.col("pos")     # positives with score >= s
    npred = F.col("tot_c") - F.col("cum_c") + F.col("c")         # rows with score >= s
    term = (F.col("pos") / F.col("tot_pos")) * (tp / npred)
    return ps.agg(F.sum(term).alias("average_precision"))


def exact_quantiles_many(df: DataFrame, cols: list[str], probs: list[float], n_buckets: int | None = None) -> dict[str, list]:
    """Exact quantiles of several columns in one pass, with linear interpolation
    (numpy/pandas 'linear', SQL ``percentile_cont``): the distinct (column, value) pairs are
    counted and prefix-summed together, and only the (at most 2 x len(probs)) order
    statistics of each column reach the driver. NULLs are ignored; a column without a
    value gives NULLs."""
    if not cols:
        return {}
    pair = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("double").alias("v")) for i, c in enumerate(cols)]))
    vc = (df.select(pair.alias("_k")).where(F.col("_k.v").isNotNull()).groupBy("_k").agg(F.count(F.lit(1)).alias("_c")))
    ps = cut_lineage(prefix_sums(vc, "_k", ["_c"], n_buckets).select(F.col("_k.i").alias("_i"), F.col("_k.v").alias("_v"), "_c", "cum__c"))
    ends = {r["_i"]: (r["n"], r["upto"]) for r in ps.groupBy("_i").agg(F.sum("_c").alias("n"), F.max("cum__c").alias("upto")).collect()}
    wanted = {i: sorted({upto - n + int(f) for p in probs for f in (((n - 1) * p) // 1, -(-((n - 1) * p) // 1))}) for i, (n, upto) in ends.items()}
    if not wanted:
        return {c: [None for _ in probs] for c in cols}
    hit = F.lit(False)
    for i, at in wanted.items():
        for pos in at:
            hit = hit | ((F.col("_i") == i) & (F.col("cum__c") - F.col("_c") <= pos) & (F.col("cum__c") > pos))
    runs: dict[int, list] = {}
    for r in ps.where(hit).collect():
        runs.setdefault(r["_i"], []).append((r["cum__c"] - r["_c"], r["cum__c"], r["_v"]))

    def value(i: int, at: int):
        return next(v for lo, hi, v in runs[i] if lo <= at < hi)

    out: dict[str, list] = {}
    for i, c in enumerate(cols):
        if i not in ends:
            out[c] = [None for _ in probs]
            continue
        n, upto = ends[i]
        out[c] = []
        for p in probs:
            h = (n - 1) * p
            a, b = value(i, upto - n + int(h // 1)), value(i, upto - n + int(-(-h // 1)))
            out[c].append(a + (b - a) * (h - h // 1))
    return out


def exact_quantiles(df: DataFrame, col: str, probs: list[float], n_buckets: int | None = None) -> list:
    """``exact_quantiles_many`` of one column."""
    return exact_quantiles_many(df, [col], probs, n_buckets)[col]
