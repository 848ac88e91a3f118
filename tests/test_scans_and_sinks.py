"""Typed scans, the newest artifact by file time, and the observed publish."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from churnlens.sources import io as IO
from churnlens.sources import sinks as SK
from churnlens.sources import typed as TY

SCHEMA = StructType([StructField("id", StringType(), False), StructField("day", DateType()), StructField("n", IntegerType())])


def test_rows_that_do_not_fit_are_kept(spark):
    df = spark.createDataFrame([("a", "2001-02-03", "1", 9), ("b", "2001-31-12", "x", 9), (None, "2001-01-01", "2", 9), ("d", None, None, 9)],
                               "id string, day string, n string, other int")
    scan = TY.typed(df, SCHEMA)
    assert sorted(map(tuple, scan.good.collect()), key=str) == [("a", dt.date(2001, 2, 3), 1), ("d", None, None)]
    assert scan.good.dtypes == [("id", "string"), ("day", "date"), ("n", "int")]
    rejects = {tuple(r.fields): r.source for r in scan.rejects.collect()}
    assert set(rejects) == {("day", "n"), ("id",)} and '"2001-31-12"' in rejects["day", "n"]
    with pytest.raises(TY.SchemaMismatch, match="day"):
        TY.typed(df.drop("day"), SCHEMA)
    assert TY.typed(df.limit(0), SCHEMA).good.count() == 0


def test_csv_lines_that_do_not_fit(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,id,day\n1,a,03.02.2001\n2,b\n3,c,2001\nx,d,04.02.2001\n5,e,05.02.2001,more\n")
    scan = TY.scan_csv(spark, str(tmp_path), SCHEMA, date_format="dd.MM.yyyy")
    assert [tuple(r) for r in scan.good.collect()] == [("a", dt.date(2001, 2, 3), 1)]
    assert sorted((tuple(r.fields), r.source) for r in scan.rejects.collect())[:2] == [(("<line>",), "2,b"), (("<line>",), "5,e,05.02.2001,more")]
    assert scan.rejects.count() == 4


def test_newest_artifact_is_read_alone(spark, tmp_path):
    base = str(tmp_path)
    spark.range(5).select(F.col("id").alias("old")).write.parquet(f"{base}/as_of=2009-01-01")
    spark.range(3).select(F.col("id").alias("new")).write.parquet(f"{base}/as_of=2001-01-01")
    for folder, when in (("as_of=2009-01-01", 1_000_000_000), ("as_of=2001-01-01", 1_100_000_000)):
        for name in os.listdir(f"{base}/{folder}"):
            os.utime(f"{base}/{folder}/{name}", (when, when))
    got = IO.read_latest(spark, base)
    assert got.columns == ["new", "as_of"] and got.count() == 3 and str(got.first().as_of) == "2001-01-01"
    assert IO.artifacts(spark, base, "*.parquet").count() == 2
    with open(f"{base}/as_of=2009-01-01/part-00000-broken.parquet", "w") as f:  # an older file that cannot be read does not matter
        f.write("no parquet")
    os.utime(f"{base}/as_of=2009-01-01/part-00000-broken.parquet", (1, 1))
    assert IO.read_latest(spark, base).count() == 3
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        IO.read_latest(spark, str(tmp_path / "none"))


def test_publish_observes_one_run(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    rows = [(f"m{i}" if i % 10 else None, "2001-01-01" if i % 4 else "2002-01-01") for i in range(100)]
    df = spark.createDataFrame(rows, "MembershipID string, RunDate string").mapInArrow(count, "MembershipID string, RunDate string")
    got = SK.publish(df, str(tmp_path / "sink"), "2001-01-01").first()
    good = sum(m is not None and d == "2001-01-01" for m, d in rows)
    assert tuple(got) == (good, 100, 100 - good, 2) and runs.value == 100
    back = SK.read_sink(spark, str(tmp_path / "sink"))
    assert back.count() == good and back.where("RunDate <> '2001-01-01'").count() == 0
    assert tuple(SK.publish(df.limit(0), str(tmp_path / "sink"), "2001-01-01").first())[:3] == (0, 0, 0)
