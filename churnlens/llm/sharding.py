"""Sharding: a permutation-filled lookup table with constant-time placement.

Each shard has its own preference order over the slots of a table of prime size M (an
offset and a step taken from its name's digest); the shards take turns claiming their next
free slot until all are taken, so each holds M / N slots to within one (or in proportion
to its weight), and when a shard leaves, few slots other than its own change owner. The
table has M rows whatever the data (``MAX_SLOTS`` is checked), and a row is placed by one
broadcast lookup: slot = digest of its key modulo M.

Defined results: a null key is placed like the empty string; equal keys share a shard;
an empty table gives an empty result; extra columns pass through whatever their names;
texts are not read. Placement depends on the key alone, so a hot source is spread when
rows are placed by doc_id.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

SLOTS = 65537
SHARDS = 256
#: Largest table that is broadcast (two integers a row: 64 MB).
MAX_SLOTS = 4_000_037


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def preference(name: str, slots: int) -> tuple[int, int]:
    """Offset and step of a shard's permutation: slot number j of it is
    (offset + j * step) mod slots, which visits every slot because slots is prime."""
    d = hashlib.md5(name.encode()).hexdigest()
    return int(d[:15], 16) % slots, int(d[15:30], 16) % (slots - 1) + 1


def fill(shards: list[str], slots: int = SLOTS, weights: dict[str, int] | None = None) -> list[int]:
    """The owner (index into ``shards``) of every slot. A shard of weight w takes w turns
    in each round."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be there and differ")
    if not is_prime(slots) or len(shards) > slots or slots > MAX_SLOTS:
        raise ValueError(f"slots must be a prime from the number of shards to {MAX_SLOTS}")
    turns = [i for i, s in enumerate(shards) for _ in range((weights or {}).get(s, 1))]
    if not turns:
        raise ValueError("no shard has a weight")
    at, step = map(list, zip(*[preference(s, slots) for s in shards]))
    owner, free = [-1] * slots, slots
    while True:
        for i in turns:
            while owner[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % slots
            owner[at[i]] = i
            free -= 1
            if not free:
                return owner


def lookup(spark: SparkSession, shards: list[str], slots: int = SLOTS, weights: dict[str, int] | None = None) -> DataFrame:
    rows = [(s, i, shards[i]) for s, i in enumerate(fill(shards, slots, weights))]
    return spark.createDataFrame(rows, "slot INT, shard_no INT, shard STRING")


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return (F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long") % slots).cast("int")


def place(df: DataFrame, key: str, shards: list[str], slots: int = SLOTS, weights: dict[str, int] | None = None
          ) -> tuple[DataFrame, dict[str, str]]:
    """``df`` plus slot, shard number and shard name; the new columns' names by role."""
    names = {k: C.internal(df, k) for k in ("slot", "shard_no", "shard")}
    table = lookup(df.sparkSession, shards, slots, weights).select(*[F.col(k).alias(v) for k, v in names.items()])
    return df.withColumn(names["slot"], slot_of(F.col(f"`{key}`"), slots)).join(F.broadcast(table), names["slot"]).select(
        *[F.col(f"`{c}`") for c in df.columns], *[F.col(v) for v in names.values()]), names


def write_shards(df: DataFrame, key: str, shards: list[str], path: str, files_per_shard: int = 1, slots: int = SLOTS) -> None:
    """Write ``df`` as one folder per shard (shard=...); a shard's slots are dealt over
    ``files_per_shard`` tasks, so that no task gets a whole shard of a large table."""
    placed, n = place(df, key, shards, slots)
    if "shard" in {c.lower() for c in df.columns}:
        raise ValueError("the table has a column named shard; rename it before writing folders")
    piece = F.pmod(F.col(n["slot"]), F.lit(files_per_shard))
    (placed.repartition(len(shards) * files_per_shard, F.col(n["shard_no"]), piece)
     .withColumnRenamed(n["shard"], "shard").drop(n["slot"], n["shard_no"]).write.mode("errorifexists").partitionBy("shard").parquet(path))


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    """Query: slot and shard of every document, by doc_id."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id")
    out, n = place(docs, "doc_id", shard_names())
    return out.select("doc_id", F.col(n["slot"]).alias("slot"), F.col(n["shard_no"]).alias("shard_no"), F.col(n["shard"]).alias("shard"))
