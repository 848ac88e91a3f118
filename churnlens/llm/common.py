"""Helpers shared by the training-data operators.

Tables are read by path through Spark only; intermediate tables go to the shared folder
named by ``spark.checkpoint.dir`` (``session.cut_lineage``), never to a local folder.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of every operator here: space, tab, line feed, vertical tab, form feed, return.
WS = " \t\n\x0b\f\r"
WS_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128-bit key of a row's id and text, never null: rows that repeat both share it."""
    ident = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("null"))
    return F.md5(F.concat(ident, F.lit(":"), text_or_empty(f"`{text}`")))


def internal(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = f"__{base}"
    while name.lower() in taken:
        name += "_"
    return name


def attach(rows: DataFrame, keyed: DataFrame, key: list[str], count: str, values: list[str], spread: Column,
           salt: str | None = None) -> DataFrame:
    """Left join of ``rows`` to ``keyed`` (one row per key, ``count`` = rows of ``rows`` that
    hold the key) that no frequent key can overload; keys must not be null.

    Keys with more than 1/(4 P) of all rows (P shuffle partitions; so at most 4 P keys,
    the proven bound of the broadcast) are joined by broadcast. The others go through a
    shuffle join on (key, salt): a row of a frequent key has a salt of 1 to 64 P from
    ``spread``, so these rows are dealt evenly and meet no partner there; all others have
    0, as ``keyed`` has. There 0 is an expression of the key, since a literal would be
    moved into a condition and both sides be dealt by the key alone. ``keyed`` is read
    three times and should be a stored table. ``salt`` names a column to keep the salt in;
    the result is then dealt out by (key, salt), which a window or aggregate over them can
    use.
    """
    spark = rows.sparkSession
    parts = shuffle_partitions(spark)
    total = keyed.agg(F.sum(count)).first()[0] or 0
    limit = max(1, total // (4 * parts))
    own = {x: internal(rows, f"attach_{x}") for x in ("hot", "cold", "salt", "cold_salt", "got", *[f"h{i}" for i in range(len(key))], *[f"c{i}" for i in range(len(key))])}
    hot = keyed.where(F.col(count) > limit).select(
        *[F.col(f"`{k}`").alias(own[f"h{i}"]) for i, k in enumerate(key)], F.struct(*values).alias(own["hot"]))
    nought = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in key]), F.lit(1)).cast("int")
    cold = keyed.where(F.col(count) <= limit).select(
        *[F.col(f"`{k}`").alias(own[f"c{i}"]) for i, k in enumerate(key)], nought.alias(own["cold_salt"]), F.struct(*values).alias(own["cold"]))
    on_hot, on_cold = F.lit(True), F.col(own["salt"]) == F.col(own["cold_salt"])
    for i, k in enumerate(key):
        on_hot = on_hot & (F.col(f"`{k}`") == F.col(own[f"h{i}"]))
        on_cold = on_cold & (F.col(f"`{k}`") == F.col(own[f"c{i}"]))
    out = rows.join(F.broadcast(hot), on_hot, "left")
    out = out.withColumn(own["salt"], F.when(F.col(own["hot"]).isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(spread), F.lit(64 * parts)).cast("int") + 1))
    out = out.join(cold, on_cold, "left").withColumn(own["got"], F.coalesce(own["hot"], own["cold"]))
    return out.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.col(own["got"])[v].alias(v) for v in values],
                      *([F.col(own["salt"]).alias(salt)] if salt else []))


def blocks(batch: pa.RecordBatch, column: str, limit: int = 4 << 20):
    """Row ranges (start, stop) of an Arrow batch with at most ``limit`` bytes of the text
    column each (one row at least), so that memory follows the block, not the batch."""
    import pyarrow.compute as pc
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total + int(n) > limit and i > start:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(sizes):
        yield start, len(sizes)
