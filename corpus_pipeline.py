"""The corpus pipeline: raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir), where docs holds all that the stage before kept,
and returns a DataFrame; all but the last return the columns of docs. Rows without a text
are handled as the operators define it (no words: the quality rules reject them). The
result has one row per drawn copy of a document: its columns but the text, and its ids.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from churnlens.llm import common, exact_dedup, mixing, pieces, quality, simhash
from churnlens.session import checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return quality.keep_documents(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    return exact_dedup.keep_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked fingerprints the document with the smallest id."""
    return simhash.keep_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the fitted rates say."""
    return mixing.draw(docs, common.table(spark, sf_dir, "labels"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Columns but the text, with ids and whether they decode to the text."""
    out, names = pieces.encode(docs, keep=[c for c in docs.columns if c != "text"])
    return out.withColumnsRenamed({names["ids"]: "ids", names["round_trip"]: "round_trip"})


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact),
    ("simhash_dedup", near),
    ("mixing", mix),
    ("sentencepiece", tokens),
]
#: Fingerprints, fitted rates and ids are beyond SQL; tests hold the stages against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each keeps is stored below the shared checkpoint
    folder and read again."""
    docs = common.table(spark, sf_dir, "documents")
    root = f"{checkpoint_dir(spark).rstrip('/')}/corpus-pipeline/{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
