"""The dedupe that moves only possible copies gives the rows of ``distinct()`` and
sends far fewer bytes where copies are few."""

import pytest
from pyspark.sql import functions as F

from citypulse.catalog import _parts
from citypulse.operators.dedupe import distinct_moving_copies, hashable, repeated_hashes
from citypulse.operators.joins import scoped_conf
from citypulse.sources.csv import union_parts

from conftest import SF_SMALL


def _same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _rows(spark, n, copies):
    """``n`` wide rows and ``copies`` repeats of some of them."""
    one = spark.range(n).withColumn("number", F.col("id") % 7).withColumns(
        {f"c{i}": F.concat(F.sha2(F.concat_ws("-", F.lit(i), "id"), 256), F.lit("x")) for i in range(3)})
    return one.unionAll(one.where(F.col("id") < copies)).repartition(4, "c0")


def test_equal_to_distinct(spark):
    odd = spark.createDataFrame(
        [(None, None, 0.0), (None, None, -0.0), (None, "a", 1.0), ("a", None, 1.0), ("", None, float("nan")),
         ("", None, float("nan")), ("", "", None)] + [("hot", "row", 1.5)] * 500, "bits string, `a``b.c` string, x double").repartition(5)
    _same(distinct_moving_copies(odd), odd.distinct())
    for n, copies in ((3000, 40), (3000, 0), (50, 50)):
        rows = _rows(spark, n, copies)
        _same(distinct_moving_copies(rows), rows.distinct())
        _same(distinct_moving_copies(rows, bits_each=1), rows.distinct())  # many false alarms
    assert distinct_moving_copies(rows.limit(0)).count() == 0
    parts = union_parts(_parts(spark, SF_SMALL))
    _same(distinct_moving_copies(parts), parts.distinct())


def test_other_ways(spark):
    rows = _rows(spark, 2000, 1500)
    _same(distinct_moving_copies(rows, most_filter_bytes=100), rows.distinct())
    nested = spark.range(20).select(F.array(F.col("id") % 3).alias("a"))
    assert not hashable(nested)
    _same(distinct_moving_copies(nested), nested.distinct())


def _sent(df):
    """Bytes that the exchanges of a frame's own plan wrote, after running it."""
    df.collect()
    total, nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "Exchange":
            total += node.metrics().get("dataSize").get().value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


def test_bytes_sent_with_one_copy_in_a_hundred(spark, tmp_dir):
    _rows(spark, 20000, 200).write.parquet(f"{tmp_dir}/rows")
    rows = spark.read.parquet(f"{tmp_dir}/rows")
    with scoped_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        whole, hashes = _sent(rows.distinct()), _sent(repeated_hashes(rows))
        final = _sent(distinct_moving_copies(rows))
    assert 0 < hashes and hashes + final < whole / 5


def test_rows_outside_the_filter_are_not_dealt(spark):
    rows = spark.range(1000).withColumn("t", F.lit("x")).unionAll(spark.range(3).withColumn("t", F.lit("x")))
    plan = distinct_moving_copies(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(id") == 1 and "Union" in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("most", [1, 64 << 20])
def test_all_rows_equal(spark, most):
    rows = spark.range(400).select(F.lit("same").alias("a"), F.lit(None).cast("int").alias("b"))
    assert [tuple(r) for r in distinct_moving_copies(rows, most).collect()] == [("same", None)]
