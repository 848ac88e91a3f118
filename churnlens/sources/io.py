"""Typed readers and writers (parquet, CSV) and newest-artifact lookup.

Paths may be any Hadoop-compatible URI; scratch output of the registered queries goes
below the shared checkpoint folder (``session.shared_path``), never a machine-local one
on a cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    return checkpoint_dir(spark).rstrip("/") + "/churnlens-out/" + name


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Partitioned parquet; with partition columns only the partitions present in ``df``
    are replaced (dynamic overwrite), so re-running one as-of date is idempotent."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)


def read_csv_typed(spark: SparkSession, path: str, schema: StructType | str, date_format: str | None = None
                   ) -> DataFrame:
    """CSV with an explicit schema (no inference) and a header row; unparsable
    fields become NULL (PERMISSIVE) like ``errors='coerce'``. ``typed.scan_csv`` keeps the
    rows that do not fit."""
    r = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if date_format:
        r = r.option("dateFormat", date_format)
    return r.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    (df.write.mode(mode).option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def artifacts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Artifacts below ``path`` and when they were last written, from the files' metadata
    alone (one row a file, no content is read): a folder of part files is one artifact,
    any other file is its own."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
             .select("path", "modificationTime"))
    folder = F.regexp_extract("path", r"^(.*)/part-[^/]*$", 1)
    return files.groupBy(F.when(folder != "", folder).otherwise(F.col("path")).alias("artifact")).agg(F.max("modificationTime").alias("written"))


def latest_artifact(spark: SparkSession, path: str, pattern: str = "*.parquet") -> str | None:
    """The artifact written last (ties: the greater name); None if there is none."""
    top = artifacts(spark, path, pattern).orderBy(F.col("written").desc(), F.col("artifact").desc()).limit(1).collect()
    return top[0]["artifact"] if top else None


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet artifact written last below ``path``, with its partition columns; no other
    file is opened, so older ones may have another schema."""
    newest = latest_artifact(spark, path)
    if newest is None:
        raise FileNotFoundError(f"no artifact below {path}")
    return spark.read.option("basePath", path).parquet(newest)
