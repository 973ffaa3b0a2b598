"""Join strategies: the physical operator each one yields, equal rows, and
the size guard on replicated sides."""

import pytest
from pyspark.sql import functions as F

from citypulse.catalog import QUERIES
from citypulse.operators.joins import (NO_AUTO_BROADCAST, check_strategy, granted,
                                       scoped_conf, strategy_join)

from conftest import SF_SMALL

EXPECT = {
    "broadcast": "BroadcastHashJoin",
    "merge": "SortMergeJoin",
    "shuffle_hash": "ShuffledHashJoin",
    "shuffle_replicate_nl": "CartesianProduct",
}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def sides(spark):
    big = spark.range(0, 2000).select((F.col("id") % 50).cast("string").alias("k"), F.col("id").alias("v"))
    small = spark.range(0, 20).select(F.col("id").cast("string").alias("k2"), (F.col("id") * 10).alias("w"))
    return big, small


@pytest.mark.parametrize("strategy", list(EXPECT))
def test_strategy_gives_named_operator(spark, sides, strategy):
    big, small = sides
    with scoped_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        df = strategy_join(big, small, big["k"] == small["k2"], "inner", strategy)
        assert EXPECT[strategy] in _plan(df)
        rows = sorted(df.select("v", "w").collect())
    ref = sorted(big.join(small, big["k"] == small["k2"]).select("v", "w").collect())
    assert rows == ref


def test_nested_loop_refused_for_large_side(spark, sides):
    big, small = sides
    with scoped_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        df = strategy_join(small, big, small["k2"] == big["k"], "inner", "shuffle_replicate_nl")
        plan = _plan(df)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_broadcast_refused_beyond_bound(spark, sides):
    big, small = sides
    with scoped_conf(spark, {"spark.sql.adaptive.enabled": "false", **NO_AUTO_BROADCAST}):
        df = strategy_join(small, big, small["k2"] == big["k"], "inner", "broadcast", max_bytes=100)
        assert "BroadcastHashJoin" not in _plan(df)


def test_bounds_come_from_the_plan(spark, sides):
    big, _ = sides
    unbounded = big.where("v > 3").groupBy("k").count()
    assert granted(unbounded, "shuffle_replicate_nl") == "auto"
    assert granted(unbounded.orderBy("k").limit(6), "shuffle_replicate_nl") == "shuffle_replicate_nl"
    assert granted(unbounded.limit(6), "shuffle_replicate_nl", max_rows=0) == "auto"
    assert granted(big, "broadcast") == "broadcast" and granted(big, "broadcast", max_bytes=0) == "auto"
    assert granted(unbounded, "merge") == "merge"


HINTED = {"broadcast": "BroadcastHashJoin", "merge": "SortMergeJoin", "shuffle_hash": "ShuffledHashJoin",
          "replicate_nl": "CartesianProduct"}


@pytest.mark.parametrize("key", [f"{form}_{s}" for form in ("income_extremes", "income_extremes_sql") for s in HINTED]
                         + [f"{form}_{s}" for form in ("own_dist", "own_dist_sql") for s in HINTED if s != "replicate_nl"])
def test_hint_keys_run_their_operator_on_the_given_tables(spark, key):
    off = {"spark.sql.adaptive.enabled": "false", **NO_AUTO_BROADCAST}
    with scoped_conf(spark, off):
        plan = _plan(QUERIES[key](spark, SF_SMALL))
    named = next(op for s, op in HINTED.items() if key.endswith("_" + s))
    assert named in plan, plan


def test_hinted_reports_are_equal_both_ways(spark):
    plain = QUERIES["income_extremes_auto"](spark, SF_SMALL)
    for s in HINTED:
        for form in ("income_extremes", "income_extremes_sql"):
            other = QUERIES[f"{form}_{s}"](spark, SF_SMALL)
            assert plain.exceptAll(other.toDF(*plain.columns)).count() == 0, (form, s)
            assert other.exceptAll(plain.toDF(*other.columns)).count() == 0, (form, s)


def test_scoped_threshold_turns_off_size_broadcast(spark, sides):
    big, small = sides
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    with scoped_conf(spark, {"spark.sql.adaptive.enabled": "false", **NO_AUTO_BROADCAST}):
        plan = _plan(big.join(small, big["k"] == small["k2"]))
        assert "SortMergeJoin" in plan
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before
    assert "BroadcastHashJoin" in _plan(big.join(small, big["k"] == small["k2"]))


def test_strategy_names():
    assert check_strategy("MERGEJOIN") == "merge"
    with pytest.raises(ValueError):
        check_strategy("nested")
