"""Outreach queues from snapshots: cooldown, playbook, severity order, capacity top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import reasons as R
from ..functions.columns import coerce_date

QUEUE_COLS = ["member_id", "week", "engagement", "paused", "EWS", "risk_band", "main_reason", "reasons",
              "action_tag", "subject", "message"]


def split_active_paused(snap: DataFrame) -> tuple[DataFrame, DataFrame]:
    return snap.where(F.col("paused") == 0), snap.where(F.col("paused") == 1)


def latest_contacts(recent_contacts: DataFrame) -> DataFrame:
    """One row per member: the most recent parsable contact date (duplicates would
    otherwise fan the join out)."""
    return (recent_contacts.select("member_id", coerce_date(F.col("last_contact_date")).alias("last_contact_date"))
            .groupBy("member_id").agg(F.max("last_contact_date").alias("last_contact_date")))


def cooldown_filter(active: DataFrame, recent_contacts: DataFrame, cooldown_days: int = C.COOLDOWN_DAYS) -> DataFrame:
    rc = latest_contacts(recent_contacts)
    j = active.join(rc, "member_id", "left")
    return j.where(F.col("last_contact_date").isNull()
                   | (F.datediff(F.col("week"), F.col("last_contact_date")) >= cooldown_days))


def active_candidates(snap: DataFrame, recent_contacts: DataFrame | None = None,
                      cooldown_days: int = C.COOLDOWN_DAYS) -> DataFrame:
    active, _ = split_active_paused(snap)
    if recent_contacts is not None:
        active = cooldown_filter(active, recent_contacts, cooldown_days)
    active = R.attach_playbook(active)
    return active.withColumn("sev_rank", R.severity_rank(F.col("main_reason")))


def outreach_topk(active: DataFrame, capacity: int = C.OUTREACH_CAPACITY) -> DataFrame:
    """Severity ascending, EWS descending, member_id as a deterministic tiebreak;
    ``limit`` after ``orderBy`` plans as a distributed TakeOrderedAndProject."""
    return active.orderBy(F.col("sev_rank").asc(), F.col("EWS").desc(), F.col("member_id").asc()).limit(capacity)


def ews_threshold_filter(active: DataFrame, ews_threshold: float) -> DataFrame:
    return active.where(F.col("EWS") >= ews_threshold)


def paused_queue(snap: DataFrame) -> DataFrame:
    _, paused = split_active_paused(snap)
    return R.attach_playbook(paused).orderBy(F.col("week").desc(), F.col("member_id").asc())


def build_outreach(snap: DataFrame, capacity: int = C.OUTREACH_CAPACITY, ews_threshold: float | None = None,
                   recent_contacts: DataFrame | None = None, cooldown_days: int = C.COOLDOWN_DAYS
                   ) -> tuple[DataFrame, DataFrame]:
    active = active_candidates(snap, recent_contacts, cooldown_days)
    if ews_threshold is not None:
        active_q = ews_threshold_filter(active, ews_threshold)
    else:
        active_q = outreach_topk(active, capacity)
    return active_q.select(*QUEUE_COLS), paused_queue(snap).select(*QUEUE_COLS)
