"""Mixing sources to target weights [native]: soft-membership mixing.

A naive Bayes classifier learned from the labelled table predicts each document's domain
posteriors; projected-gradient least squares then fits a non-negative rate per document so
that the expected tokens of each domain (rate x tokens x posterior, summed) match the
targets. Everything that touches documents is a DataFrame expression; the driver handles
only one number per domain and iteration.

Model: words are hashed into ``BUCKETS`` rows, so the broadcast weight table has a fixed
size. It is learned from at most ``SAMPLE`` labelled documents, the first by hash of the
id (a documented bound). Prediction reads every word of every document. The posterior is
softmax(log prior + ``SHARPNESS`` x mean word weight), so long texts are not
over-confident.

Fit: minimise 1/2 sum_d ((S_d - T_d) / tokens)^2 over rates r >= 0 and, of those that do,
take the rates next to 1 (weighted by tokens). This is projected gradient in its lazy form:
steps add up in one number u_d a domain, and the rate column is projected from their sum,
r = max(0, 1 - p . u), so equal posteriors get equal rates. A step has the second moment
(domains x domains) of the rows above 0 as metric, which is one aggregate over stored rows;
its length comes from one more aggregate, which sums the rates of every length in ``STEPS``
at once. The pull towards 1 has the weights ``PULL`` in turn, each solved until the
projected gradient is below ``TOLERANCE``; the next begins with u, or with u scaled as the
pull falls, whichever is nearer to its end. So the fit ends at the least squares whether or
not the targets can be reached, after some dozens of aggregates, however many rows there
are. ``PASSES`` only guards against numbers that are not finite.

More than ``MAX_DOMAINS`` label classes: those with a target and the most frequent ones
stay, all others together are the domain ``other``, which is learned, fitted and drawn
like any.

Defined results: a null or empty text has 0 tokens, the prior as posterior and the rate
that its posterior gets, at most the greatest of a row with tokens; a null doc_id is kept; repeated rows each get their rate; without
any labelled row there is one domain, ``all``; label rows with a null id, or null in every
class, are not learned from, and a document labelled twice counts once for each label;
targets of domains that were not learned are left out and the others scaled; an empty
table gives an empty result; other columns pass through whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import common as C

BUCKETS = 1 << 14
SAMPLE = 20_000
SHARPNESS = 24.0
MAX_DOMAINS = 32
OTHER = "other"
PASSES, TOLERANCE = 1000, 1e-10
PULL = (1e-2, 1e-4, 1e-6, 1e-8, 1e-10)
STEPS = tuple(2.0 ** e for e in range(-11, 4))
#: Target share of tokens by domain (quality and toxic label), and the tokens to draw as a
#: multiple of those there are.
TARGETS = {"q1t0": 0.92, "q1t1": 0.02, "q0t0": 0.05, "q0t1": 0.01}
BUDGET = 1.25


def words_of(text: Column) -> Column:
    t = F.btrim(C.ascii_lower(F.coalesce(text, F.lit(""))), F.lit(C.WS))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, C.WS_RUN))


def domain_of(labels: DataFrame) -> Column:
    return F.concat(F.lit("q"), F.coalesce(F.col("quality").cast("string"), F.lit("x")), F.lit("t"), F.coalesce(F.col("toxic").cast("string"), F.lit("x")))


def _bucket(word: str) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def _few(some: DataFrame, wanted: list[str]) -> DataFrame:
    """Labels with at most ``MAX_DOMAINS`` domains; they are counted by Spark."""
    if some.agg(F.count_distinct("domain")).first()[0] <= MAX_DOMAINS:
        return some
    named = F.col("domain").isin(list(wanted))
    top = (some.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).orderBy(named.desc(), F.col("n").desc(), "domain").limit(MAX_DOMAINS - 1).collect())
    return some.withColumn("domain", F.when(F.col("domain").isin([r["domain"] for r in top]), F.col("domain")).otherwise(OTHER))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, wanted: list[str] = ()) -> tuple[list[str], list[float], DataFrame | None]:
    """Domains, their log priors and the weight table (bucket, one column w_i a domain);
    weights are centred over domains, so a bucket that is not there weighs 0 for all."""
    some = (labels.where(F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
            .select(F.col("doc_id").cast("long").alias("id"), domain_of(labels).alias("domain"))
            .orderBy(F.xxhash64("id"), "id", "domain").limit(sample))
    some = _few(cut_lineage(some), wanted)
    words = (docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(some), "id")  # at most ``sample`` rows
             .select("domain", F.explode(words_of(F.col("text"))).alias("word")))
    counts = cut_lineage(words.groupBy("domain", _bucket("word").alias("bucket")).agg(F.count(F.lit(1)).alias("n")))
    totals = {r["domain"]: r["n"] for r in counts.groupBy("domain").agg(F.sum("n").alias("n")).collect()}
    domains = sorted(totals)
    if not domains:
        return ["all"], [0.0], None
    held = {r["domain"]: r["n"] for r in some.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = [math.log(held[d] / sum(held[x] for x in domains)) for d in domains]
    raw = counts.groupBy("bucket").agg(*[
        F.log((F.sum(F.when(F.col("domain") == d, F.col("n")).otherwise(0)) + 0.5) / F.lit(totals[d] + 0.5 * BUCKETS)).alias(f"l_{i}") for i, d in enumerate(domains)])
    mean = sum((F.col(f"l_{i}") for i in range(len(domains))), F.lit(0.0)) / len(domains)
    return domains, prior, raw.select("bucket", *[(F.col(f"l_{i}") - mean).alias(f"w_{i}") for i in range(len(domains))])


def posteriors(docs: DataFrame, domains: list[str], prior: list[float], weights: DataFrame | None) -> DataFrame:
    """id, key, n_tokens, p_0 ... for every row of ``docs`` (doc_id, text). Words are summed
    by document before anything is shuffled."""
    k = range(len(domains))
    base = docs.select(F.col("doc_id").cast("long").alias("id"), C.row_key().alias("key"), words_of(F.col("text")).alias("words"))
    if weights is None:
        return base.select("id", "key", F.size("words").cast("long").alias("n_tokens"), F.lit(1.0).alias("p_0"))
    each = base.select("id", "key", F.size("words").cast("long").alias("n_tokens"), F.posexplode_outer("words").alias("pos", "word"))
    each = each.withColumn("bucket", _bucket("word")).join(F.broadcast(weights), "bucket", "left")  # BUCKETS rows at most
    summed = each.groupBy("id", "key", "n_tokens").agg(
        *[F.sum(f"w_{i}").alias(f"s_{i}") for i in k], F.sum(F.when(F.coalesce("pos", F.lit(0)) == 0, 1).otherwise(0)).alias("rows"))
    per = F.greatest(F.col("n_tokens") * F.col("rows"), F.lit(1))
    logits = summed.select("id", "key", "n_tokens", "rows", *[(F.lit(prior[i]) + SHARPNESS * F.coalesce(F.col(f"s_{i}"), F.lit(0.0)) / per).alias(f"z_{i}") for i in k])
    top = F.greatest(*[F.col(f"z_{i}") for i in k]) if len(domains) > 1 else F.col("z_0")
    exps = logits.select("id", "key", "n_tokens", "rows", *[F.exp(F.col(f"z_{i}") - top).alias(f"e_{i}") for i in k])
    total = sum((F.col(f"e_{i}") for i in k), F.lit(0.0))
    out = exps.select("id", "key", "n_tokens", "rows", *[(F.col(f"e_{i}") / total).alias(f"p_{i}") for i in k])
    # rows that repeat id and text were summed together: as many rows again
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).drop("copy", "rows")


def shares(domains: list[str], targets: dict[str, float]) -> list[float]:
    known = [max(0.0, targets.get(d, 0.0)) for d in domains]
    return [x / sum(known) for x in known] if sum(known) > 0 else [1 / len(domains)] * len(domains)


def fit(post: DataFrame, domains: list[str], targets: dict[str, float], budget: float = BUDGET,
        iterations: int | None = None) -> tuple[DataFrame, list[dict]]:
    """Stored posteriors -> the same with ``rate``; per domain the tokens there are, the
    target, what the rates give and whether the fit came to its end. It always does unless
    ``iterations`` bounds the aggregates over the rows."""
    k = range(len(domains))
    pairs = [(i, j) for i in k for j in range(i, len(domains))]
    first = post.agg(F.sum("n_tokens").alias("n"), *[F.sum(F.col("n_tokens") * F.col(f"p_{i}")).alias(f"s_{i}") for i in k]).first()
    tokens = float(first["n"] or 0)
    if not tokens:
        return post.withColumn("rate", F.lit(1.0)), []
    goal = [budget * tokens * x for x in shares(domains, targets)]
    t = np.array(goal) / tokens
    rate = lambda u: F.greatest(F.lit(0.0), F.lit(1.0) - sum((F.col(f"p_{i}") * float(u[i]) for i in k), F.lit(0.0)))

    def look(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Sums of the rates of u, second moment of the rows above 0, greatest rate."""
        mass = F.col("n_tokens") * F.col("rate")
        above = F.when(F.col("rate") > 0, F.col("n_tokens")).otherwise(0)
        got = post.withColumn("rate", rate(u)).agg(
            *[F.sum(mass * F.col(f"p_{i}")) for i in k], *[F.sum(above * F.col(f"p_{i}") * F.col(f"p_{j}")) for i, j in pairs],
            F.max(F.when(F.col("n_tokens") > 0, F.col("rate")))).first()
        second = np.zeros((len(domains), len(domains)))
        for (i, j), x in zip(pairs, got[len(domains):]):
            second[i, j] = second[j, i] = x / tokens
        return np.array(got[:len(domains)]) / tokens, second, got[-1]

    def along(u: np.ndarray, step: np.ndarray, lengths: tuple[float, ...]) -> list[np.ndarray]:
        """Sums of the rates of u + length x step, for all lengths in one aggregate."""
        at, by = (sum((F.col(f"p_{i}") * float(v[i]) for i in k), F.lit(0.0)) for v in (u, step))
        rows = post.select("n_tokens", *[f"p_{i}" for i in k], at.alias("at"), by.alias("by"))
        rows = rows.select("*", *[(F.col("n_tokens") * F.greatest(F.lit(0.0), F.lit(1.0) - F.col("at") - F.col("by") * x)).alias(f"m_{a}") for a, x in enumerate(lengths)])
        got = rows.agg(*[F.sum(F.col(f"m_{a}") * F.col(f"p_{i}")) for a in range(len(lengths)) for i in k]).first()
        return [np.array(got[a * len(domains):(a + 1) * len(domains)]) / tokens for a in range(len(lengths))]

    def length(slopes: list[float], first: float) -> float:
        """Where the slope along a step is 0, from its values at ``STEPS`` (it only rises)."""
        if abs(slopes[STEPS.index(1.0)]) <= 0.1 * abs(first):
            return 1.0
        below = sum(x <= 0 for x in slopes)
        if below in (0, len(STEPS)):
            return STEPS[0] / 2 if not below else STEPS[-1]
        (a, b), (x, y) = STEPS[below - 1:below + 1], slopes[below - 1:below + 1]
        return a + (b - a) * x / (x - y)

    u, left, before = np.zeros(len(domains)), (PASSES if iterations is None else iterations) - 1, None
    sums, second, most = look(u)
    for pull in PULL:
        gradient = lambda v, s: t - s + pull * v  # noqa: B023, E731
        if before and left > 1:
            scaled = u * (before / pull)
            (near,) = along(scaled, np.zeros(len(domains)), (0.0,))
            left -= 1
            if np.linalg.norm(gradient(scaled, near)) < np.linalg.norm(gradient(u, sums)):
                u, left = scaled, left - 1
                sums, second, most = look(u)
        before = pull
        down = gradient(u, sums)
        while np.linalg.norm(down) > TOLERANCE and left > 1:
            step = -np.linalg.solve(second + pull * np.eye(len(domains)), down)
            slopes = [gradient(u + x * step, s) @ step for x, s in zip(STEPS, along(u, step, STEPS))]
            u = u + length(slopes, down @ step) * step
            sums, second, most = look(u)
            left -= 2
            down = gradient(u, sums)
        done = bool(np.linalg.norm(down) <= TOLERANCE)
        if not done or np.linalg.norm(sums - t) <= TOLERANCE:
            break
    if not done and iterations is None:
        raise RuntimeError(f"mixing: no fit after {PASSES} passes; off by {np.linalg.norm(down):.3g} of all tokens")
    rated = post.withColumn("rate", F.when(F.col("n_tokens") > 0, rate(u)).otherwise(F.least(rate(u), F.lit(float(most)))))
    return rated, [{"domain": d, "tokens": first[f"s_{i}"], "target": goal[i], "expected": float(sums[i]) * tokens, "converged": done} for i, d in enumerate(domains)]


def copies(rate: Column, key: Column) -> Column:
    """How often a row is drawn: the rate rounded up or down by a hash of its key, so that
    the expected number is the rate."""
    unit = F.pmod(F.xxhash64(key, F.lit("mixing")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return F.floor(rate + unit).cast("int")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, budget: float = BUDGET,
        iterations: int | None = None) -> tuple[DataFrame, list[str], list[dict]]:
    """Rows (id, key, n_tokens, p_i, rate, copies) of all documents, the domains in the
    order of the p_i, and the fit's totals."""
    two = docs.select("doc_id", "text")
    targets = TARGETS if targets is None else targets
    domains, prior, weights = train(two, labels, wanted=list(targets))
    post = cut_lineage(posteriors(two, domains, prior, weights))
    rated, totals = fit(post, domains, targets, budget, iterations)
    return rated.withColumn("copies", copies(F.col("rate"), F.col("key"))), domains, totals


def draw(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, budget: float = BUDGET, iterations: int | None = None) -> DataFrame:
    """The mixture itself: every row of ``docs`` as often as its rate says, with the columns
    of ``docs``."""
    rated, _, _ = mix(docs, labels, targets, budget, iterations)
    own = {x: C.internal(docs, x) for x in ("row_key", "copies", "copy", "rows")}
    chosen = cut_lineage(rated.groupBy(F.col("key").alias(own["row_key"])).agg(F.max("copies").alias(own["copies"]), F.count(F.lit(1)).alias(own["rows"])))
    keyed = docs.withColumn(own["row_key"], C.row_key())
    # rows that repeat id and text have nothing else to be dealt by than where they stand
    rows = C.attach(keyed, chosen, [own["row_key"]], own["rows"], [own["copies"]], F.monotonically_increasing_id())
    again = rows.where(F.col(own["copies"]) > 0).withColumn(own["copy"], F.explode(F.sequence(F.lit(1), F.col(own["copies"]))))
    return again.select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    """Query: posteriors, rate and number of copies of every document."""
    rated, domains, _ = mix(C.table(spark, sf_dir, "documents").select("doc_id", "text"), C.table(spark, sf_dir, "labels"))
    return rated.select(F.col("id").alias("doc_id"), "n_tokens", *[F.col(f"p_{i}").alias(f"p_{d}") for i, d in enumerate(domains)], "rate", "copies")
