"""Tables derived once per application; joins with hot keys."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from citypulse.catalog import QUERIES
from citypulse.operators.skew import heavy_hitters, hot_key_join
from citypulse.sources.derived import DerivedTables, fingerprint
from conftest import ROOT, SF_SMALL


def local(path):
    return path.removeprefix("file:")


def numbers(path, spark, n):
    spark.range(n).write.mode("overwrite").parquet(path)
    return path


def test_derived_once_while_its_files_stay(spark, tmp_dir):
    source, built = numbers(f"{tmp_dir}/source", spark, 10), []

    def build():
        built.append(1)
        return spark.read.parquet(source).withColumn("part", F.col("id") % 2)

    with DerivedTables(spark) as owner:
        first = owner.table(spark, "t", [source], build, ["part"])
        again = owner.table(spark.newSession(), "t", [source], build, ["part"])
        assert len(built) == 1 and first.count() == again.count() == 10
        assert first.where("part = 1").count() == 5
        other = owner.table(spark, "u", [source], build)
        numbers(source, spark, 4)                              # changed files: a new table
        assert owner.table(spark, "t", [source], build, ["part"]).count() == 4 and len(built) == 3
        assert other.count() == 10 and len(owner.entries) == 3
        folder = local(owner.folder)
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_last_use_deletes(spark, tmp_dir):
    source = numbers(f"{tmp_dir}/source", spark, 3)
    with DerivedTables(spark) as owner:
        write = lambda path: spark.range(3).write.parquet(path)
        path = owner.path("t", [source], write)
        with pytest.raises(Exception):
            owner.path("u", [source], lambda path: spark.range(1).select(F.raise_error(F.lit("no"))).write.parquet(path))
        owner.release(owner.path("u", [source], write))       # a build that failed is begun anew
        assert owner.path("t", [source], write) == path
        owner.release(path)
        assert os.path.isdir(local(path))
        owner.release(path)
        assert not os.path.exists(local(path)) and not owner.entries


def test_fingerprint_tells_files_apart(spark, tmp_dir):
    a, b = numbers(f"{tmp_dir}/a", spark, 3), numbers(f"{tmp_dir}/b", spark, 3)
    assert fingerprint(spark, [a]) == fingerprint(spark, [a]) != fingerprint(spark, [b])


@pytest.mark.parametrize("key", ["top_months_sql", "income_extremes_auto", "own_dist_by_year", "scan_csv_header"])
def test_reports_scan_the_derived_table_only(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert rows and "orders.parquet" not in plan and "events.parquet" not in plan


def test_nothing_is_left_at_the_end(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from citypulse.catalog import QUERIES
from citypulse.session import local_session
spark = local_session(cores=2)
spark.sparkContext.setCheckpointDir({str(tmp_path)!r})
for key in ("day_parts_sql", "scan_csv_typed"):
    assert QUERIES[key](spark, {SF_SMALL!r}).collect()
import glob
assert glob.glob({str(tmp_path)!r} + "/*/derived-*")
spark.stop()
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=200)
    assert out.returncode == 0, out.stderr[-2000:]
    for _ in range(100):                                       # the JVM ends a moment after
        left = [f for _, _, files in os.walk(tmp_path) for f in files]
        if not left:
            break
        __import__("time").sleep(0.1)
    assert left == []


# ------------------------------------------------------------------ hot keys


def sides(spark, n=6000, right_hot=1):
    left = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit("0")).otherwise((F.col("id") % 900).cast("string")).alias("a"),
                                 F.lit("0").alias("a2"), F.col("id").alias("v"))
    right = spark.range(900).select(F.col("id").cast("string").alias("b"), F.lit("0").alias("b2"), (F.col("id") * 2).alias("w"))
    more = spark.range(right_hot - 1).select(F.lit("0").alias("b"), F.lit("0").alias("b2"), (F.col("id") + 10_000).alias("w"))
    nulls = spark.createDataFrame([(None, "0", 1), ("1", None, 2)], "x string, y string, z long")
    return left.union(nulls), right.union(more).union(nulls)


@pytest.mark.parametrize("right_hot, per_task", [(1, 100), (300, 100), (300, 1_000_000), (40, 7)])
def test_hot_key_join_equals_the_plain_join(spark, right_hot, per_task):
    left, right = sides(spark, right_hot=right_hot)
    on = [("a", "b"), ("a2", "b2")]
    got = hot_key_join(left, right, on, rows_per_task=per_task)
    plain = left.join(right, (F.col("a") == F.col("b")) & (F.col("a2") == F.col("b2")))
    assert got.columns == plain.columns
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0


def test_a_hot_key_is_spread_over_tasks(spark):
    from citypulse.operators.joins import NO_AUTO_BROADCAST
    from citypulse.operators.scoped import session_with
    child = session_with(spark, {**NO_AUTO_BROADCAST, "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"})
    left, right = sides(child)
    share = lambda df: df.where("a = '0'").groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("*")).first()
    on = [("a", "b"), ("a2", "b2")]
    split, whole = share(hot_key_join(left, right, on, rows_per_task=100)), share(left.join(right, [F.col(x) == F.col(y) for x, y in on]))
    assert whole[1] == 1 and split[1] >= 8 and split[0] < whole[0] / 3


def test_heavy_hitters(spark):
    left, _ = sides(spark)
    assert list(heavy_hitters(left, ["a", "a2"], 500).values()) == [pytest.approx(2000, rel=0.05)]
    assert heavy_hitters(left, ["a", "a2"], 5000) == {} and heavy_hitters(left.limit(0), ["a"], 1) == {}


def test_positions_grow_with_customers(spark):
    """One position per customer but for those at '0', '0'."""
    from citypulse.sources import tables as T
    keys = spark.range(1, 200_001).select(F.col("id").alias("c"))
    lat, lon = T._position_text(F.col("c"), F.col("c") % T.ZERO_COORD_MOD == 0)
    assert keys.select(lat, lon).distinct().count() == 200_000 - 200_000 // T.ZERO_COORD_MOD + 1
