"""Exact dedup: a persistent digest index, bucketed and sorted by digest.

``DigestIndex`` is a Parquet table at a shared path, hash-bucketed and sorted by the
digest of the normalised text. A batch is reduced to one row per digest before any
shuffle, deduplicated against the index by a sort-merge anti-join (the index side is
read bucket by bucket, without a shuffle), and only new digests are appended. The verdict
of every row is then read back from the index.

Defined results: null text equals the empty text; of equal texts the row with the smallest
doc_id stays (null ids come last; of rows that repeat that id exactly one stays); a text
that an earlier batch holds keeps that batch's id and none of the new rows; running a
batch again changes nothing; an empty batch gives an empty result; extra columns pass
through whatever their names; a digest that a third of all rows share is one row in the
index and is joined back by a bounded broadcast (``common.attach``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir, cut_lineage
from . import common as C

_SCHEMA = "digest STRING, keep_id BIGINT, n BIGINT, batch STRING"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), C.WS_RUN, " ")


def digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


class DigestIndex:
    """The index at ``path`` (a shared folder); opened again, it continues where it was.
    ``buckets`` counts for a new index and must stay the same for one path."""

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.name = "llm_digest_index_" + uuid.uuid5(uuid.NAMESPACE_URL, path).hex
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({_SCHEMA}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, batch: DataFrame, batch_id: str) -> None:
        """Append the digests (columns digest, keep_id, n; one row each) that no stored
        row has. Anti-join and append share one partitioning: the index's buckets."""
        known = self.rows().select("digest").hint("merge")
        fresh = batch.repartition(self.buckets, "digest").join(known, "digest", "left_anti")
        fresh.select("digest", "keep_id", "n", F.lit(batch_id).alias("batch")).write.insertInto(self.name)

    def find(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` (column digest, one row each) with what the index holds of
        them: one merge of the sorted buckets, whose result is no larger than the batch."""
        return batch.repartition(self.buckets, "digest").join(self.rows().hint("merge"), "digest")

    def close(self) -> None:
        """Forget the table's name; its files stay at the path."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def dedup(docs: DataFrame, index: DigestIndex, batch_id: str, doc_id: str = "doc_id", text: str = "text"
          ) -> tuple[DataFrame, dict[str, str]]:
    """Every row of ``docs`` with four more columns, whose names are returned by role:
    digest, keep_id, n (rows of its batch that hold the text) and kept."""
    names = {k: C.internal(docs, k) for k in ("digest", "keep_id", "n", "kept")}
    salt, held = C.internal(docs, "salt"), C.internal(docs, "held")
    ident, dig = F.col(f"`{doc_id}`").cast("long"), digest(F.col(f"`{text}`"))
    batch = cut_lineage(docs.select(ident.alias("id"), dig.alias("digest")).groupBy("digest").agg(
        F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n")))
    index.add(batch, batch_id)
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns], dig.alias(names["digest"]))
    known = cut_lineage(index.find(batch.select("digest", F.col("n").alias(held))).select(
        F.col("digest").alias(names["digest"]), F.col("keep_id").alias(names["keep_id"]), F.col("n").alias(names["n"]),
        (F.col("batch") == batch_id).alias(names["kept"]), held))
    out = C.attach(rows, known, [names["digest"]], held, [names["keep_id"], names["n"], names["kept"]], F.col(f"`{doc_id}`"), salt=salt)
    # rows that repeat the id that stays: one of them does
    first = F.row_number().over(Window.partitionBy(names["digest"], salt, f"`{doc_id}`").orderBy(F.lit(1)))
    kept = F.col(names["kept"]) & ident.eqNullSafe(F.col(names["keep_id"])) & (first == 1)
    return out.withColumn(names["kept"], kept).drop(salt), names


def new_index(spark: SparkSession, path: str | None = None) -> DigestIndex:
    """An index with one bucket per shuffle partition, at a new folder of the shared
    checkpoint directory unless a path is given."""
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/llm-digest-index/{uuid.uuid4().hex}"
    return DigestIndex(spark, path, C.shuffle_partitions(spark))


def keep_documents(docs: DataFrame) -> DataFrame:
    """The rows that stay of one batch against a new index, with the columns of ``docs``."""
    out, names = dedup(docs, new_index(docs.sparkSession), "documents")
    return out.where(F.col(names["kept"])).select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Query: every row of documents with the id that stays of its text."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    out, n = dedup(docs, new_index(spark), "documents")
    return out.select("doc_id", F.col(n["keep_id"]).alias("keep_id"), F.col(n["n"]).alias("group_size"),
                      F.col(n["kept"]).alias("kept"), F.col(n["digest"]).alias("text_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1),
r AS (SELECT *, row_number() OVER (PARTITION BY text_sha256, doc_id) AS i FROM d JOIN g USING (text_sha256))
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AND i = 1 AS kept, text_sha256 FROM r
"""
