"""Edge inputs of the distance, the nearest search and the SQL texts."""

import math
import random

import pytest
from pyspark.sql import functions as F

from citypulse.functions import geodesy
from citypulse.functions.geodesy import with_geodesic_km
from citypulse.operators.nearest import nearest
from citypulse.plans import day_parts


def _km(spark, pairs):
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pairs)], "i int, a double, b double, c double, d double")
    return [r["km"] for r in with_geodesic_km(df, "a", "b", "c", "d", "km").orderBy("i").collect()]


def test_published_distances(spark):
    # fixed values: WGS-84 geodesics (metres / 1000): a quarter meridian, one degree of the
    # equator and of the meridian at it, a degree at the pole, Flinders Peak - Buninyong
    want = [((0, 0, 90, 0), 10001.965729), ((0, 0, 0, 1), 111.319491), ((0, 0, 1, 0), 110.574389),
            ((89, 0, 90, 0), 111.693865), ((-37.95103342, 144.42486789, -37.65282114, 143.92649554), 54.972271), ((5, 5, 5, 5), 0.0)]
    for got, (_, km) in zip(_km(spark, [p for p, _ in want]), want):
        assert got == pytest.approx(km, abs=2e-3)  # the pair of surveyed points is on another ellipsoid (GRS 80)


def test_no_distance_where_there_is_none(spark):
    assert _km(spark, [(0, 361, 0.5, 179.5), (math.nan, 0, 1, 1), (340.1, 0, 1, 1), (0, math.inf, 1, 1)]) == [None] * 4


def test_far_side_distances(spark):
    # published solutions of pairs on which the plain iteration fails, metres / 1000
    want = [((0, 0, 0, 180), 20003.931459), ((0, 0, 0.5, 179.5), 19936.288579), ((0, 0, 0.5, 179.7), 19944.127421),
            ((90, 10, -90, -77), 20003.931459), ((0, 0, 0, 179.2), 6378.137 * math.radians(179.2)), ((0, -10, 0, 350), 0.0)]
    for got, (_, km) in zip(_km(spark, [p for p, _ in want]), want):
        assert got == pytest.approx(km, abs=1e-6)


def test_far_side_solver_equals_the_iteration_elsewhere(spark):
    rnd = random.Random(3)
    pairs = [(rnd.uniform(-90, 90), rnd.uniform(-180, 180), rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(300)]
    df = spark.createDataFrame(pairs, "a double, b double, c double, d double")
    steps = dict(geodesy.vincenty_steps("a", "b", "c", "d", "km"))
    names = [geodesy.PREFIX + n for n in ("d", "l", "u1", "u2", "su1", "cu1", "su2", "cu2")]
    df = with_geodesic_km(df, "a", "b", "c", "d", "km")
    for n in names:
        df = df.withColumn(n, F.expr(steps[n]))
    far = F.expr(geodesy.far_side_km(*names[4:], names[1]))
    assert df.select(F.max(F.abs(far - F.col("km")))).first()[0] < 1e-6


def _near(spark, points, stations, **more):
    pts = spark.createDataFrame(points, "k string, lat double, lon double")
    sts = spark.createDataFrame(stations, "s int, la double, lo double, v int")
    return nearest(pts, sts, ["k"], "lat", "lon", "la", "lo", "s", ["v"], **more)


def test_nearest_keeps_every_point(spark):
    points = [("a", 34.0, -118.0), ("b", 35.0, -117.0), (None, 34.0, -118.1), ("n", math.nan, 0.0), ("z", 95.0, 0.0)]
    stations = [(1, 34.0, -118.2, 10), (2, 35.1, -117.0, 20), (3, math.nan, 0.0, 30), (4, 95.0, 0.0, 40)]
    got = _near(spark, points, stations, max_per_cell=1).collect()
    assert sorted(((r["k"], r["s"], r["v"]) for r in got), key=str) == sorted(
        [("a", 1, 10), ("b", 2, 20), (None, 1, 10), ("n", None, None), ("z", None, None)], key=str)


def test_nearest_without_stations_has_the_same_schema(spark):
    points = [("a", 34.0, -118.0)]
    one, none = _near(spark, points, [(1, 34.0, -118.2, 10)]), _near(spark, points, [(3, math.nan, 0.0, 30)])
    assert none.schema.simpleString() == one.schema.simpleString()
    assert [r["v"] for r in none.collect()] == [None]


def test_dense_cluster_and_sparse_rest(spark):
    stations = [(i, 34 + i % 20 * 1e-5, -118 + i // 20 * 1e-5, i) for i in range(200)] + [(900, -40.0, 20.0, 900), (901, 60.0, 100.0, 901)]
    points = [(str(i), lat, lon) for i, (lat, lon) in enumerate([(34.0001, -118.0), (10.0, 10.0), (55.0, 90.0), (-33.0, 140.0)])]
    got = {r["k"]: r["distance"] for r in _near(spark, points, stations).collect()}
    pts = spark.createDataFrame(points, "k string, lat double, lon double")
    sts = spark.createDataFrame(stations, "s int, la double, lo double, v int")
    brute = with_geodesic_km(pts.crossJoin(sts), "lat", "lon", "la", "lo", "d").groupBy("k").agg(F.min("d").alias("d"))
    for r in brute.collect():
        assert got[r["k"]] == pytest.approx(r["d"], abs=1e-9)


def test_quotes_in_values_of_the_sql_form(spark):
    parts = [spark.createDataFrame([("1", "d", "0930", "DRIVER'S LOT")], "`DR_NO` string, `DATE OCC` string, `TIME OCC` string, `Premis Desc` string")]
    got = day_parts.day_parts_sql(spark, parts, premise="DRIVER'S LOT", labels=("it's am", "b", "c", "d", "e")).collect()
    assert [tuple(r) for r in got] == [("it's am", 1)]
