"""Reports whose incidents meet many geocode rows: customers share positions, the '0', '0' ones too."""

import os

import duckdb
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from citypulse import oracle
from citypulse.catalog import QUERIES
from citypulse.operators.skew import hot_key_join

KEYS = (
    "income_extremes_sql",
    "income_extremes_auto",
    "income_extremes_broadcast",
    "income_extremes_merge",
    "join_hint_merge",
    "income_extremes_merge_small",
    "income_extremes_shuffle_hash",
    "join_hint_shuffle_hash",
    "income_extremes_replicate_nl",
    "join_hint_replicate_nl",
    "income_extremes_sql_broadcast",
    "income_extremes_sql_merge",
    "income_extremes_sql_merge_small",
    "income_extremes_sql_shuffle_hash",
    "income_extremes_sql_replicate_nl",
    "join_scoped_threshold",
    "join_composite_key",
)

# the customers 1 and 1001 have one position, 97 * 1 and 97 * 9 stand at '0', '0'
ROWS = {
    "orders": [Row(o_orderkey=k, o_custkey=c) for k, c in ((1, 1), (2, 1), (3, 1001), (4, 97), (5, 873), (6, 2))],
    "customer": [Row(c_custkey=c, c_nationkey=0) for c in (1, 2, 1001, 97, 873)],
    "supplier": [Row(s_suppkey=1, s_name="S1", s_nationkey=0, s_acctbal=10.0)],
    "nation": [Row(n_nationkey=0, n_name="KENYA", n_regionkey=0)],
    "region": [Row(r_regionkey=0, r_name="AFRICA")],
    "events": [Row(event_id=1, event_type="view")],
}


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    for name, rows in ROWS.items():
        df = spark.createDataFrame(rows)
        ints = {c: df[c].cast("int") for c in df.columns if c in ("c_nationkey", "s_nationkey", "n_nationkey", "n_regionkey", "r_regionkey")}
        more = {"orders": {"o_orderdate": "timestamp_ntz'2020-01-02 03:04:05'"}, "events": {"ts": "timestamp_ntz'2020-01-02 03:04:05'"}}
        df = df.withColumns(ints).selectExpr("*", *[f"{e} AS {c}" for c, e in more.get(name, {}).items()])
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    con = duckdb.connect()
    for name in ROWS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(folder, name)}.parquet/*.parquet')")
    return folder, con


@pytest.mark.parametrize("key", KEYS)
def test_every_pair_counts(spark, made, key):
    folder, con = made
    df = QUERIES[key](spark, folder)
    got = sorted(map(str, (tuple(r) for r in df.collect())))
    assert got == sorted(map(str, con.execute(oracle.SQL[key]).fetchall()))
    # 3 incidents of 1 and 1001 meet 2 geocode rows each, 2 at '0', '0' both of those, that of 2 meets 1
    pairs = len(got) if key == "join_composite_key" else sum(r["#"] for r in df.collect()) / 2   # richest and poorest
    assert pairs == 3 * 2 + 2 * 2 + 1


def test_many_pairs_of_a_key_are_spread_over_tasks(spark):
    from citypulse.operators.joins import NO_AUTO_BROADCAST
    from citypulse.operators.scoped import session_with
    child = session_with(spark, {**NO_AUTO_BROADCAST, "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"})
    left = child.range(3000).select(F.when(F.col("id") < 900, "0").otherwise(F.col("id").cast("string")).alias("a"), F.col("id").alias("v"))
    right = child.range(300).select(F.when(F.col("id") < 100, "0").otherwise((F.col("id") * 9).cast("string")).alias("b"), F.col("id").alias("w"))
    plain = left.join(right, F.col("a") == F.col("b"))
    got = hot_key_join(left, right, [("a", "b")], rows_per_task=1000, pairs_per_task=5000)
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    share = got.where("a = '0'").groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("*")).first()
    assert share[0] < 90_000 / 3 and share[1] >= 8


def stored_apart(spark, **settings):
    from citypulse.operators.joins import NO_AUTO_BROADCAST
    from citypulse.operators.scoped import session_with
    return session_with(spark, {**NO_AUTO_BROADCAST, "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "4", **settings})


def test_many_pairs_take_little_room(spark, tmp_path):
    """Six keys of 5,000 right rows each, more values than a column file's dictionary holds: 1,200,000 pairs."""
    child = stored_apart(spark, **{"spark.sql.shuffle.partitions": "1"})
    left = child.range(240).select((F.col("id") % 6).alias("a"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    right = child.range(30_000).select((F.col("id") % 6).alias("b"), F.sha2((-F.col("id")).cast("string"), 256).alias("w"))
    got = hot_key_join(left, right, [("a", "b")], rows_per_task=100_000, pairs_per_task=100_000)
    got.select("v", "w").write.parquet(at := str(tmp_path / "pairs"))
    assert child.read.parquet(at).distinct().count() == 1_200_000
    assert sum(os.path.getsize(os.path.join(at, f)) for f in os.listdir(at)) < 8_000_000   # 30,000 values of 64 bytes


@pytest.mark.parametrize("rows_per_task, pairs_per_task", [(1000, 3000), (1000, 200_000), (70, 3000), (1_000_000, 90_000)])
def test_blocks_of_pairs_equal_the_plain_join(spark, rows_per_task, pairs_per_task):
    """Copies on both sides, keys and values that are null, keys of two kinds, one key's rows over several blocks."""
    child = stored_apart(spark)
    i = F.col("id")
    key = F.when(i % 7 == 0, F.lit(None)).when(i % 2 == 0, "0").otherwise((i % 90).cast("string"))
    zero = F.when(i % 3 == 0, F.lit(0.0)).otherwise(F.lit(-0.0))
    value = F.when(i % 5 == 0, F.lit(None)).otherwise(i % 400)
    left = child.range(1200).select(key.alias("a"), zero.alias("a 2"), value.alias("v.1"))
    right = child.range(900).select(value.alias("w"), zero.alias("b 2"), key.alias("b"))
    plain = left.join(right, (F.col("a") == F.col("b")) & (F.col("`a 2`") == F.col("`b 2`")))
    got = hot_key_join(left, right, [("a", "b"), ("a 2", "b 2")], rows_per_task=rows_per_task, pairs_per_task=pairs_per_task)
    assert "__rows_l" in got._jdf.queryExecution().toString()
    assert got.dtypes == plain.dtypes
    texts = [f"to_json(struct(`{c}`)) AS `{c}`" for c in plain.columns]     # 0.0 and -0.0 differ as texts
    assert got.selectExpr(texts).exceptAll(plain.selectExpr(texts)).count() == 0
    assert plain.selectExpr(texts).exceptAll(got.selectExpr(texts)).count() == 0
    keys_only = hot_key_join(left.select("a"), right.select("b"), [("a", "b")], rows_per_task=rows_per_task, pairs_per_task=pairs_per_task)
    assert keys_only.groupBy("a", "b").count().exceptAll(left.select("a").join(right.select("b"), F.col("a") == F.col("b")).groupBy("a", "b").count()).count() == 0


def test_pairs_of_a_block_are_made_outside_of_the_join(spark):
    """The join's generated code keeps what it makes of a left row until it has met all right ones."""
    child = stored_apart(spark)
    left, right = child.range(500).selectExpr("id % 2 AS a", "id AS v"), child.range(500).selectExpr("id % 2 AS b", "id AS w")
    got = hot_key_join(left, right, [("a", "b")], rows_per_task=1000, pairs_per_task=1000)
    lines = got._jdf.queryExecution().executedPlan().toString().splitlines()
    joins = [x for x in lines if "SortMergeJoin" in x]
    generates = [x for x in lines if "Generate explode" in x and lines.index(x) < lines.index(joins[0])]
    stage = lambda x: x.partition("*(")[2].partition(")")[0]
    assert len(joins) == 1 and len(generates) == 2
    assert stage(joins[0]) not in [stage(x) for x in generates]


def test_one_key_of_many_pairs_by_the_query(spark, made, monkeypatch):
    from citypulse import catalog
    folder, con = made
    monkeypatch.setattr(catalog, "HOT_PAIRS", 2)
    monkeypatch.setattr(catalog, "HOT_ROWS", 2)
    got = QUERIES["join_composite_key"](spark, folder)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, con.execute(oracle.SQL["join_composite_key"]).fetchall()))


def test_the_count_of_rows_leaves_no_shuffle_behind(spark):
    import time
    from citypulse.operators.skew import heavy_hitters
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: sum("shuffle_" in str(disk.getAllFiles().apply(i)) for i in range(disk.getAllFiles().size()))
    df = stored_apart(spark).range(1000).selectExpr("id % 10 AS a", "id").distinct()
    before = files()
    assert len(heavy_hitters(df, ["a"], 1)) == 10
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before


def test_only_rows_with_a_copy_are_moved_whole(spark, made):
    """No row of these has a copy, so the dedupe before the join moves none by all its columns."""
    folder, _ = made
    assert "Aggregate" not in QUERIES["join_composite_key"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
