"""The scale properties claimed in the README, checked on the plans."""

import re

from citypulse.catalog import QUERIES
from citypulse.operators.joins import scoped_conf

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _static(spark, name):
    with scoped_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        df = QUERIES[name](spark, SF_SMALL)
        return _plan(df)


def test_top_months_has_group_limit_and_one_wide_exchange(spark):
    plan = _static(spark, "top_months_df")
    assert plan.count("WindowGroupLimit") == 2            # partial + final
    wide = [l for l in plan.splitlines() if "Exchange hashpartitioning" in l and "DR_NO" in l]
    assert len(wide) == 1                                   # the dedupe is the only row-wide shuffle
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_day_parts_filter_below_distinct(spark):
    plan = _static(spark, "day_parts_df")
    lines = plan.splitlines()
    dedupe = max(i for i, l in enumerate(lines) if "Exchange hashpartitioning" in l and "DR_NO" in l)
    filters = [i for i, l in enumerate(lines) if "Filter" in l and "STREET" in l]
    assert filters and all(i > dedupe for i in filters)    # deeper in the tree = before the shuffle
    assert len(filters) >= 4                               # in every union branch


def test_income_extremes_preaggregates_before_join(spark):
    plan = _static(spark, "income_extremes_auto")
    # the big join reads counted positions, not rows: an aggregate keyed by the join keys feeds it
    assert re.search(r"HashAggregate\(keys=\[LAT#\d+, LON#\d+, Vict Descent#\d+\]", plan)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_own_station_preaggregates_by_area_and_position(spark):
    plan = _static(spark, "own_dist_by_year")
    assert re.search(r"HashAggregate\(keys=\[AREA#\d+, _groupingexpression#\d+, LAT#\d+, LON#\d+\]", plan)


def test_nearest_never_builds_a_cartesian_product(spark):
    from pyspark.sql.classic.dataframe import DataFrame
    seen = []
    original = DataFrame.checkpoint

    def spy(self, eager=True):
        seen.append(_plan(self))
        return original(self, eager)

    DataFrame.checkpoint = spy
    try:
        QUERIES["nearest_by_year"](spark, SF_SMALL).collect()
    finally:
        DataFrame.checkpoint = original
    joined = [p for p in seen if "Join" in p]
    assert joined, "the grid join ran"
    for p in seen:
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
