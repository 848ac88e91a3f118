"""Scores -> one snapshot row per member with EWS percentile, risk band and reason."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import reasons as R
from ..session import cut_lineage
from . import ranking
from .weekly import MEMBER, WEEK


def score_frame(features: DataFrame, ews_col: str = "EWS", k_weeks: int = C.K_WEEKS, carry: tuple[str, ...] = ()) -> DataFrame:
    """member_id, week, prob_churn_{k}w, EWS, reasons + the weekly columns carried along
    (engagement, paused) — the source's scores ⟕ weekly join becomes a projection."""
    return features.select(
        MEMBER, WEEK, F.col(ews_col).alias(f"prob_churn_{k_weeks}w"), F.col(ews_col).alias("EWS"),
        R.reason_codes(features, k_weeks).alias("reasons"), "engagement", "paused", *carry)


def _one_of_ties(df: DataFrame, member: str) -> DataFrame:
    """One row per member of the few that are left, by a hash of the row: the same one in
    every run. The partitioning of the window before it is reused."""
    first = F.row_number().over(Window.partitionBy(member).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])))
    return df.withColumn("_first", first).where(F.col("_first") == 1).drop("_first")


def latest_preferring_nonpaused(df: DataFrame, member: str = MEMBER, week: str = WEEK) -> DataFrame:
    """Last non-paused week of each member, else the last week. A NULL ``paused`` counts
    as not non-paused (as ``paused == 0`` is false for NaN).

    Written as max(struct(non_paused, week)) over the member partition: an unordered
    window that reuses the member sort of the feature windows (a row_number over a new
    order would add a sort of all rows). Of rows that tie exactly one is kept."""
    key = F.struct(F.coalesce(F.col("paused") == 0, F.lit(False)).alias("np"), F.col(week).alias("w"))
    best = F.max(key).over(Window.partitionBy(member))
    return _one_of_ties(df.withColumn("_best", best).where(key == F.col("_best")).drop("_best"), member)


def latest_per_member(df: DataFrame, member: str = MEMBER, week: str = WEEK) -> DataFrame:
    """Row of the latest week per member (unordered window max); of rows that tie exactly
    one is kept."""
    return _one_of_ties(df.withColumn("_mw", F.max(week).over(Window.partitionBy(member)))
                        .where(F.col(week) == F.col("_mw")).drop("_mw"), member)


def build_snapshots(scores: DataFrame, n_buckets: int | None = None, by: str | None = None) -> DataFrame:
    """Latest row per member, global average-rank percentile of EWS (distributed),
    risk band and primary reason.

    The one-row-per-member snapshot is checkpointed (reliable, shared folder) before
    ranking: the rank needs a pass for its bucket edges and a pass for the ranks, and
    both then read the materialised snapshot instead of re-running the weekly
    pipeline. It also cuts the lineage of everything downstream (profile join,
    outreach, evaluation). With ``by`` (a column that members do not share) the percentile
    is that inside each of its values."""
    snap = cut_lineage(latest_preferring_nonpaused(scores))
    snap = ranking.percentile_rank_by(snap, "EWS", by, "ews_pct") if by else ranking.percentile_rank(snap, "EWS", "ews_pct", n_buckets)
    return (snap.withColumn("risk_band", R.risk_band(F.col("ews_pct")))
                .withColumn("main_reason", R.primary_reason(F.col("reasons"))))


def join_scores_weekly(scores: DataFrame, weekly: DataFrame, member: str = MEMBER, week: str = WEEK) -> DataFrame:
    """Scores of a table of their own with the engagement and pause of their week (left
    join on member and week, which is one row a member and week on the right)."""
    return scores.join(weekly.select(member, week, "engagement", "paused"), [member, week], "left")


def join_canceled(weekly: DataFrame, cancellations: DataFrame, member: str = MEMBER, week: str = WEEK) -> DataFrame:
    """``weekly`` with ``canceled`` from a table of cancellations: 1 in a week that has one,
    however many, else 0."""
    hit = cancellations.groupBy(member, week).agg(F.max(F.coalesce(F.col("canceled"), F.lit(0)).cast("int")).alias("canceled"))
    return weekly.drop("canceled").join(hit, [member, week], "left").withColumn("canceled", F.coalesce("canceled", F.lit(0)))


def relabel_snapshot(snap: DataFrame) -> DataFrame:
    return (snap.withColumn("main_reason", R.relabel_reason(F.col("main_reason")))
                .withColumn("reasons", R.relabel_reason(F.col("reasons"))))
