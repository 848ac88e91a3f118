"""A task's share of the rows does not grow with the input."""

import pytest
from pyspark.sql import functions as F

from churnlens import session as S
from churnlens.operators import weekly as WK


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Members of five dates of attendance each, in a file."""
    path = str(tmp_path_factory.mktemp("sizes") / "attendance of weeks")
    member = F.concat(F.lit("M"), F.floor(F.col("id") / 20))
    week = F.date_add(F.lit("2000-01-03").cast("date"), (F.col("id") % 20 * 7).cast("int"))
    spark.range(40_000).select(member.alias("MembershipID"), week.alias("WeekBeginningDate"), (F.col("id") % 3).cast("int").alias("WeekVisits"),
                               F.lit(0).alias("OnPauseThisWeek")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def members(stored):
    return stored.select("MembershipID").distinct().select(
        "MembershipID", F.lit("1999-01-01").cast("date").alias("ActiveOn Date"), F.lit(None).cast("date").alias("End Date"),
        F.lit("x").alias("SubCategory"), F.lit("Contract").alias("Category"))


def test_input_bytes_are_those_of_the_files(stored):
    from urllib.parse import unquote, urlparse
    from pathlib import Path
    assert S.input_bytes(stored) == sum(Path(unquote(urlparse(f).path)).stat().st_size for f in stored.inputFiles()) > 0
    assert S.input_bytes(stored.sparkSession.range(3).toDF("k")) == 0


def test_panel_partitions_follow_the_input(spark, stored, members, monkeypatch):
    small = WK.weekly_panel(members, stored, "2001-01-01")
    monkeypatch.setattr(S, "INPUT_BYTES_PER_TASK", max(1, S.input_bytes(stored) // 40))
    large = WK.weekly_panel(members, stored, "2001-01-01")
    assert large.rdd.getNumPartitions() >= 40 and sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))
    feats = WK.member_features(large)
    assert feats.select(F.spark_partition_id().alias("p")).distinct().count() > 30
    per = feats.select("member_id", F.spark_partition_id().alias("p")).distinct()
    assert per.count() == per.select("member_id").distinct().count()  # a member is in one partition


def test_panels_of_dates_partitions_follow_the_members(spark, stored, members, monkeypatch):
    dated = members.select("*", F.explode(F.array(F.lit("2000-06-01").cast("date"), F.lit("2001-01-01").cast("date"))).alias("as_of"))
    per = S.cut_lineage(WK.attendance_by_member(stored, ["2000-06-01", "2001-01-01"]))
    show = lambda df: sorted(map(tuple, df.collect()))
    few = WK.weekly_panels(dated, per)
    monkeypatch.setattr(WK, "MEMBERS_PER_TASK", 50)
    many = WK.weekly_panels(dated, per)
    assert many.rdd.getNumPartitions() == 40 and show(few) == show(many) and many.count() > 0


def test_stored_for_fits(spark):
    few = S.stored_for_fits(spark.range(1000, numPartitions=16).toDF("x"), 600)
    many = S.stored_for_fits(spark.range(9000, numPartitions=3).toDF("x"), 600)
    assert few.rdd.getNumPartitions() == 2 and few.count() == 1000
    assert many.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and many.distinct().count() == 9000
    assert max(many.groupBy(F.spark_partition_id()).count().toPandas()["count"]) < 9000 / spark.sparkContext.defaultParallelism + 50


def _used(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


@pytest.fixture
def many_shuffle_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_panel_is_dealt_though_the_session_has_more_partitions(stored, members, monkeypatch, many_shuffle_partitions):
    monkeypatch.setattr(S, "INPUT_BYTES_PER_TASK", max(1, S.input_bytes(stored) // 40))
    assert _used(WK.member_features(WK.weekly_panel(members, stored, "2001-01-01"))) > 30  # else one for every core


def test_rows_count_however_well_they_compress(spark, stored, members, monkeypatch, many_shuffle_partitions):
    assert S.input_rows(stored) == 40_000 and S.input_rows(spark.range(3).toDF("k")) == 0
    monkeypatch.setattr(S, "INPUT_ROWS_PER_TASK", 1_000)
    assert _used(S.spread(stored, "MembershipID")) > 30
    rows = S.spread(stored, "MembershipID").select("MembershipID", F.spark_partition_id().alias("p")).distinct()
    assert rows.count() == 2_000
    monkeypatch.setattr(S, "INPUT_ROWS_PER_TASK", 30_000)
    assert _used(S.spread(stored, "MembershipID")) == spark.sparkContext.defaultParallelism  # not fewer than there are cores


def test_rows_of_tables_partitioned_by_a_column(spark, tmp_path):
    spark.range(60).select("id", (F.col("id") % 3).alias("part")).write.partitionBy("part").parquet(str(tmp_path / "t"))
    spark.range(5).toDF("other").write.parquet(str(tmp_path / "u [x] 7%"))
    both = spark.read.parquet(str(tmp_path / "t")).join(spark.read.parquet(str(tmp_path / "u \\[x\\] 7%")), F.col("id") == F.col("other"))
    assert S.input_rows(both) == 65


def test_weeks_of_members_are_moved_by_no_sort(spark, stored, members):
    dates = ["2000-06-01", "2001-01-01"]
    dated = members.select("*", F.explode(F.array(*[F.lit(T).cast("date") for T in dates])).alias("as_of"))
    per = S.cut_lineage(WK.attendance_by_member(stored, dates))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        panel = WK.weekly_panels(dated, per)
        plan = panel._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" in plan
        got = {(str(r.as_of), r.MembershipID, str(r.week), r.engagement) for r in panel.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    own = {(T, r.member_id, str(r.week), r.engagement) for T in dates for r in WK.weekly_panel(members, stored, T).collect()}
    assert got == own and len(got) > 0
