"""No side whose rows are repeated for the cells around them goes through the driver."""

import re
from itertools import takewhile

import pytest

from citypulse.catalog import QUERIES

KEYS = (
    "nearest_station",
    "nearest_by_division",
    "nearest_by_year",
    "nearest_sql_by_division",
    "nearest_sql_by_year",
)


def broadcast_parts(plan):
    """The steps of a plan's text that lead into each broadcast, back to a shuffle, join or aggregate:
    what lies behind these has been sized."""
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            yield list(takewhile(lambda x: not re.search("Exchange|Join|Aggregate|Union", x), lines[i + 1:]))


def ran_plans(spark, since):
    """(number of executions, plans as they ran after the first ``since``)."""
    store = spark._jsparkSession.sharedState().statusStore()
    n = store.executionsCount()
    found = store.executionsList(0, n)
    return n, [found.apply(i).physicalPlanDescription().split("== Initial Plan ==")[0] for i in range(since, n)]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("nearest"))
    when = "timestamp_ntz'2020-01-02 03:04:05'"
    tables = {
        "orders": spark.range(2000).selectExpr("id AS o_orderkey", "id AS o_custkey", f"{when} AS o_orderdate"),
        "events": spark.range(10).selectExpr("id AS event_id", f"{when} AS ts", "'view' AS event_type"),
        "supplier": spark.range(300).selectExpr("id AS s_suppkey", "concat('S', id) AS s_name", "0 AS s_nationkey", "1D AS s_acctbal"),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("key", KEYS)
def test_no_repeated_rows_are_broadcast(spark, made, key):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    before, _ = ran_plans(spark, 0)
    rows = QUERIES[key](spark, made).collect()
    assert rows
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    _, plans = ran_plans(spark, before)
    assert any("SortMergeJoin" in p for p in plans) and any("Generate" in p for p in plans)
    bad = [part for p in plans for part in broadcast_parts(p) if any("Generate" in line for line in part)]
    assert not bad, bad[0]


REPORTS = (
    "nearest_by_division",
    "nearest_by_year",
    "nearest_sql_by_division",
    "nearest_sql_by_year",
)


@pytest.mark.parametrize("key", REPORTS)
def test_no_stations_or_positions_are_broadcast(spark, made, key):
    """Neither the stations' columns nor the positions with their station, however few they are."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    before, _ = ran_plans(spark, 0)
    assert QUERIES[key](spark, made).collect()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    _, plans = ran_plans(spark, before)
    reports = [p for p in plans if "InsertIntoHadoopFs" not in p]   # writing the parts is no step of the report
    assert any("LeftOuter" in p for p in reports)
    bad = [p for p in reports if "BroadcastExchange" in p]
    assert not bad, bad[0]
