"""Grid nearest-station search against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from citypulse.functions.geodesy import with_geodesic_km
from citypulse.operators import nearest as N
from citypulse.operators.nearest import nearest
from citypulse.session import checkpoint_dir


def _brute(spark, pts, sts):
    p = spark.createDataFrame(pts, "pid long, lat double, lon double")
    s = spark.createDataFrame(sts, "slat double, slon double, seq long, name string")
    pairs = with_geodesic_km(p.crossJoin(s), "lat", "lon", "slat", "slon", "d")
    best = pairs.groupBy("pid").agg(F.min(F.struct("d", "seq", "name")).alias("b"))
    return {r.pid: (r.b.d, r.b.seq) for r in best.collect()}


def _grid(spark, pts, sts, most=4):
    p = spark.createDataFrame(pts, "pid long, lat double, lon double")
    s = spark.createDataFrame(sts, "slat double, slon double, seq long, name string")
    out = nearest(p, s, ["pid"], "lat", "lon", "slat", "slon", "seq", ["name"], "d", max_per_cell=most)
    return {r.pid: (r.d, r.seq) for r in out.collect()}


@pytest.mark.parametrize("most", [4, 1, 1000])
def test_matches_brute_force(spark, most):
    rnd = random.Random(7)
    sts = [(34 + rnd.random() * 0.5, -118.5 + rnd.random() * 0.5, i, f"s{i}") for i in range(60)]
    sts.append((sts[5][0], sts[5][1], 99, "dup"))           # exact tie: seq 5 wins
    pts = [(i, 34 + rnd.random() * 0.6 - 0.05, -118.5 + rnd.random() * 0.6 - 0.05) for i in range(300)]
    pts.append((1000, sts[5][0], sts[5][1]))                # on top of the tied pair
    pts.append((1001, 0.0, 0.0))                            # thousands of km away
    pts.append((1002, -33.9, 151.2))                        # other side of the world
    want = _brute(spark, pts, sts)
    got = _grid(spark, pts, sts, most)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][1] == want[k][1], k
        assert got[k][0] == pytest.approx(want[k][0], abs=1e-9)
    assert got[1000] == (0.0, 5)


def test_null_points_and_no_stations(spark):
    pts = [(1, None, -118.0), (2, 34.0, -118.0)]
    sts = [(34.0, -118.01, 1, "a")]
    got = _grid(spark, pts, sts)
    assert got[1] == (None, None) and got[2][1] == 1
    none = _grid(spark, pts, [])
    assert none == {1: (None, None), 2: (None, None)}


def test_more_stations_than_points_and_no_usable_points(spark):
    rnd = random.Random(11)
    sts = [(34 + rnd.random() * 0.2, -118.3 + rnd.random() * 0.2, i, f"s{i}") for i in range(200)]
    pts = [(i, 34 + rnd.random() * 0.2, -118.3 + rnd.random() * 0.2) for i in range(15)]
    pts.append((99, 10.0, 10.0))                 # far from every station
    want = _brute(spark, pts, sts)
    got = _grid(spark, pts, sts)
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()}
    only_bad = _grid(spark, [(1, None, None)], sts)
    assert only_bad == {1: (None, None)}


def test_non_finite_points_get_nulls(spark):
    pts = [(1, float("nan"), -118.0), (2, float("inf"), -118.0), (3, 34.0, -118.0)]
    sts = [(34.0, -118.01, 1, "a"), (34.5, -118.0, 2, "b")]
    got = _grid(spark, pts, sts)
    assert got[1] == (None, None) and got[2] == (None, None) and got[3][1] == 1


def _clustered(rnd, dense):
    """20 stations over ~50 km, 10 copies of one position, ``dense`` within ~100 m; points among all."""
    sts = [(33.8 + rnd.random() * 0.5, -118.3 + rnd.random() * 0.5, 300 + i, f"s{i}") for i in range(20)]
    sts += [(33.9, -118.1, 400 + i, f"c{i}") for i in range(10)]
    pts = [(i, 33.8 + rnd.random() * 0.5, -118.3 + rnd.random() * 0.5) for i in range(40)]
    pts += [(200, 33.9, -118.1), (201, 34.002, -118.002)]
    sts += [(34.0 + rnd.random() * 1e-3, -118.0 + rnd.random() * 1e-3, i, f"d{i}") for i in range(dense)]
    return pts + [(100 + i, 34.0 + rnd.random() * 1e-3, -118.0 + rnd.random() * 1e-3) for i in range(10)], sts


def test_dense_cluster_stays_exact(spark):
    pts, sts = _clustered(random.Random(5), 300)
    want = _brute(spark, pts, sts)
    got = _grid(spark, pts, sts)
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()}
    assert got[200] == (0.0, 400)                          # first of the copies


def _levels(spark, sts, most=4):
    s = spark.createDataFrame(sts, "a double, b double, __no long, name string")
    s = N._finest(s.withColumns(dict(zip(("__x", "__y", "__z"), N.ecef_km("a", "b"))))).distinct()
    return N.pyramid(s, most).collect()


def test_pyramid_is_deep_only_where_stations_are_dense(spark):
    checkpoint_dir(spark)
    _, sparse = _clustered(random.Random(5), 0)
    _, both = _clustered(random.Random(5), 300)
    few, many = (_levels(spark, [x for x in sts if x[3][0] != "c"]) for sts in (sparse, both))  # copies are one position
    assert min(r["__k"] for r in many) < min(r["__k"] for r in few)
    own = {(r["__k"], r["__cx"], r["__cy"], r["__cz"]): r["__many"] for r in many}
    for (k, x, y, z), n in own.items():
        if k < N.TOP:                                       # a cell is there as its wider one is split
            assert own[(k + 2, x >> 2, y >> 2, z >> 2)] > 4
    for r in few:                                           # sparse regions are as without the cluster
        assert (r["__k"], r["__cx"], r["__cy"], r["__cz"]) in own


def test_steps_do_not_grow_with_a_cluster(spark, monkeypatch):
    steps, kind = [], type(spark.range(1))
    plain = kind.checkpoint
    monkeypatch.setattr(kind, "checkpoint", lambda self, *a: (steps.append(1), plain(self, *a))[1])
    _grid(spark, *_clustered(random.Random(5), 0))
    without = len(steps)
    _grid(spark, *_clustered(random.Random(5), 300))
    assert without == 5 and len(steps) == 10


def test_minima_by_hash_and_no_forced_broadcast(spark):
    pts, sts = _clustered(random.Random(5), 30)
    p = spark.createDataFrame(pts, "pid long, lat double, lon double")
    s = spark.createDataFrame(sts, "slat double, slon double, seq long, name string")
    out = nearest(p, s, ["pid"], "lat", "lon", "slat", "slon", "seq", ["name"], "d")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert "strategy=broadcast" not in out._jdf.queryExecution().logical().toString()


def test_world_wide_stations_and_points_on_the_far_side(spark):
    rnd = random.Random(12)
    at = lambda: (rnd.uniform(-90, 90), rnd.uniform(-180, 180))
    sts = [(*at(), i, f"w{i}") for i in range(40)]
    pts = [(i, *at()) for i in range(80)] + [(900, 90.0, 0.0), (901, -90.0, 50.0), (902, 0.0, 180.0), (903, 0.0, -180.0)]
    want, got = _brute(spark, pts, sts), _grid(spark, pts, sts)
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()}
    one = [(0.0, 0.0, 1, "only"), (0.0, 0.5, 2, "other")]
    pts = [(1, 0.0, 180.0), (2, 0.5, 179.7), (3, 0.0, -179.6)]
    assert _grid(spark, pts, one) == _brute(spark, pts, one)


def test_keys_and_payload_with_any_name(spark):
    p = spark.createDataFrame([(None, 34.0, -118.0), ("a", 34.1, -118.0)], "`a b` string, lat double, lon double")
    s = spark.createDataFrame([(34.0, -118.0, "z", "x y")], "slat double, slon double, seq string, `my name` string")
    out = nearest(p, s, ["a b"], "lat", "lon", "slat", "slon", "seq", ["my name"])
    assert sorted((r["a b"] or "", r["my name"], r.seq) for r in out.collect()) == [("", "x y", "z"), ("a", "x y", "z")]
