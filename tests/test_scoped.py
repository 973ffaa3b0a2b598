"""Settings that stay with a frame after the caller's session has others."""

import pytest
from pyspark.sql import functions as F

from citypulse.catalog import QUERIES
from citypulse.operators.joins import NO_AUTO_BROADCAST
from citypulse.operators.scoped import adopted, built_with, planned_with, session_with
from conftest import SF_SMALL

BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


def ran(df):
    """(rows, the plan that ran)."""
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["join_scoped_threshold", "join_scoped_threshold_sql"])
def test_scoped_report_runs_without_size_broadcast(spark, key):
    before = spark.conf.getAll
    rows, plan = ran(QUERIES[key](spark, SF_SMALL))
    plain, plain_plan = ran(QUERIES["income_extremes_auto"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plain_plan
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert sorted(map(tuple, rows)) == sorted(map(tuple, plain))
    assert spark.conf.getAll == before
    assert not [v for v in spark.catalog.listTables() if v.name.startswith("cp_moved")]


def test_frame_keeps_its_settings_when_the_caller_changes_them(spark):
    a = spark.range(1000).withColumn("v", F.col("id") % 7)
    b = spark.range(7).withColumnRenamed("id", "v")
    df = planned_with(a.join(b, "v"), NO_AUTO_BROADCAST)
    old = spark.conf.get(BROADCAST)
    spark.conf.set(BROADCAST, "100MB")
    try:
        rows, plan = ran(df.groupBy("v").count())
    finally:
        spark.conf.set(BROADCAST, old)
    assert len(rows) == 7 and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_session_carries_the_callers_settings_and_views(spark):
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.range(5).createOrReplaceTempView("cp_scoped_view")
    spark.conf.set(key, "3")
    try:
        child = session_with(spark, {BROADCAST: "-1"}, views=["cp_scoped_view"])
    finally:
        spark.conf.set(key, old)
    assert (child.conf.get(key), child.conf.get(BROADCAST)) == ("3", "-1") and spark.conf.get(BROADCAST) != "-1"
    assert child.sql("SELECT count(*) AS n FROM cp_scoped_view").first().n == 5
    child.range(1).createOrReplaceTempView("cp_only_there")
    assert not spark.catalog.tableExists("cp_only_there")
    spark.catalog.dropTempView("cp_scoped_view")


def test_settings_of_the_application_are_refused(spark):
    with pytest.raises(ValueError):
        session_with(spark, {"spark.executor.memory": "1g"})


def test_builders_get_frames_of_their_session(spark):
    def build(session, many, one):
        assert {d.sparkSession.conf.get(BROADCAST) for d in [*many, one]} == {"-1"}
        one.createOrReplaceTempView("one")
        return session.sql("SELECT count(*) AS n FROM one").unionByName(many[0].agg(F.count("*").alias("n")))

    out = built_with(spark, NO_AUTO_BROADCAST, build, [spark.range(3)], spark.range(4))
    assert [r.n for r in out.collect()] == [4, 3]
    assert adopted(spark, out.limit(1)).count() == 1  # and back
