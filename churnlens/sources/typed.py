"""Typed scans: declared schemas, checked against the files, with rows that do not fit kept
in a table of their own instead of turning into NULLs.

A scan is written once to the shared folder (typed columns, and for a row that does not fit
its source and the names of the fields at fault); the good rows and the rejects are two
filters of that table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, ShortType, StringType, StructField, StructType

from ..session import cut_lineage


def _schema(required: str, **columns: str) -> StructType:
    kinds = {"string": StringType(), "date": DateType(), "int": IntegerType(), "double": DoubleType(), "short": ShortType()}
    return StructType([StructField(name, kinds[kind], name != required) for kind, names in columns.items() for name in names.split("|")])


# The columns of the source tables that the jobs read, by type.
MEMBERSHIPS = _schema(
    "MembershipID",
    string="MembershipID|MemberID|Status Desc|SubCategory|Category|Origin|Channel|ClubName|MembershipTypeDesc|Gender|PaymentFrequency|Term|Member Name",
    date="Start Date|ActiveOn Date|End Date|DOB|Original Start Date|DateLastAccessed", double="RegularPayment|Discount|Base Amount",
    int="TermDays|Lump Sum Flag|Transferred_IN|Transferred_OUT|EndedWithinCoolingPeriod")
ATTENDANCE = _schema("MembershipID", string="MembershipID", date="WeekBeginningDate",
                     int="WeekVisits|OnPauseThisWeek|payment_failed|discount_active|price_change|canceled")
PANEL_RESULT = _schema("member_id", string="member_id", date="week", int="engagement", short="paused")


@dataclass
class Scan:
    """``good``: rows with the declared types; ``rejects``: source (the row as JSON, or the
    raw line) and fields (names of those that do not fit)."""

    good: DataFrame
    rejects: DataFrame


class SchemaMismatch(ValueError):
    """A declared column that the files do not have."""


def require_schema(df: DataFrame, schema: StructType) -> None:
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise SchemaMismatch(f"columns that the files do not have: {missing}")


def typed(df: DataFrame, schema: StructType, date_format: str | None = None) -> Scan:
    """The declared columns of ``df`` in their declared types. A row with a value that does
    not convert, or a NULL in a column declared as not nullable, is rejected whole; the
    table's other columns are not read."""
    require_schema(df, schema)
    have = {f.name: f.dataType for f in df.schema.fields}
    out, faults = [], []
    for f in schema.fields:
        raw = F.col(f"`{f.name}`")
        value = raw
        if have[f.name] != f.dataType:
            if isinstance(f.dataType, DateType) and date_format and isinstance(have[f.name], StringType):
                value = F.try_to_timestamp(raw, F.lit(date_format)).cast("date")
            else:
                value = raw.try_cast(f.dataType)
            faults.append(F.when(raw.isNotNull() & value.isNull(), F.lit(f.name)))
        if not f.nullable:
            faults.append(F.when(raw.isNull(), F.lit(f.name)))
        out.append(value.alias(f.name))
    fields = F.array_compact(F.array(*faults)) if faults else F.array().cast("array<string>")
    source = F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in schema.fields]))
    rows = df.select(*out, fields.alias("__fields"), F.when(F.size(fields) > 0, source).alias("__source"))
    return _split(rows, schema)


def _split(rows: DataFrame, schema: StructType) -> Scan:
    stored = cut_lineage(rows)
    bad = F.size("__fields") > 0
    return Scan(stored.where(~bad).select(*[F.col(f"`{f.name}`") for f in schema.fields]),
                stored.where(bad).select(F.col("__source").alias("source"), F.col("__fields").alias("fields")))


def scan_parquet(spark: SparkSession, path: str, schema: StructType) -> Scan:
    return typed(spark.read.parquet(path), schema)


def scan_csv(spark: SparkSession, path: str, schema: StructType, date_format: str | None = None) -> Scan:
    """CSV with a header. Every field is read as text and converted by ``typed``, so that a
    reject names its fields; a line with too many or too few fields is one of field
    ``<line>``, kept as it stands in the file."""
    line = "__line"
    text = StructType([*[StructField(f.name, StringType()) for f in schema.fields], StructField(line, StringType())])
    header = spark.read.option("header", True).csv(path).columns
    require_schema(spark.createDataFrame([], StructType([StructField(c, StringType()) for c in header])), schema)
    order = StructType([*[StructField(c, StringType()) for c in header], text[line]])
    raw = spark.read.schema(order).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", line).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    raw = cut_lineage(raw)
    scan = typed(raw.where(F.col(line).isNull()).drop(line), schema, date_format)
    broken = raw.where(F.col(line).isNotNull()).select(F.col(line).alias("source"), F.array(F.lit("<line>")).alias("fields"))
    return Scan(scan.good, scan.rejects.unionByName(broken))
