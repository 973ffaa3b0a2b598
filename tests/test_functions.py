"""Column functions: lenient casts, money, day parts, decoding, distance."""

import math

import pytest

from citypulse.functions import dayparts as D
from citypulse.functions import lenient as L
from citypulse.functions.geodesy import with_geodesic_km
from citypulse.functions.labels import DESCENT_LABELS, decode


def test_lenient_casts_turn_bad_text_into_null(spark):
    df = spark.createDataFrame([("12", "34.5"), ("x", "abc"), (None, None), (" 7", "1e3")], "a string, b string")
    out = df.select(L.to_int("a").alias("i"), L.to_double("b").alias("d")).collect()
    assert [r.i for r in out] == [12, None, None, 7]
    assert [r.d for r in out] == [34.5, None, None, 1000.0]


def test_parse_timestamp_twelve_hour_and_bad_text(spark):
    df = spark.createDataFrame([("01/05/2010 01:30:00 PM",), ("bad",), (None,), ("12/31/2019 12:00:00 AM",)], "t string")
    out = df.select(L.parse_timestamp("t").alias("ts")).collect()
    assert out[0].ts.hour == 13 and out[0].ts.minute == 30
    assert out[1].ts is None and out[2].ts is None
    assert out[3].ts.hour == 0 and out[3].ts.day == 31


def test_parse_money(spark):
    df = spark.createDataFrame([("$33,887",), ("$1,234,567",), (" $5",), ("$",), (None,), ("$12.5",)], "m string")
    out = [r.v for r in df.select(L.parse_money("m").alias("v")).collect()]
    assert out[:2] == [33887.0, 1234567.0]
    assert out[2] is None and out[3] is None and out[4] is None
    assert out[5] == 12.5


def test_zip_prefix(spark):
    df = spark.createDataFrame([("90001-1234",), ("9000",), (None,)], "z string")
    assert [r.z5 for r in df.select(L.zip_prefix("z").alias("z5")).collect()] == ["90001", "9000", None]


TIMES = ["0000", "0459", "0500", "1159", "1200", "1659", "1700", "2059", "2100", "2359", "5", "930", None, "ab"]


def test_day_parts_by_hour(spark):
    df = spark.createDataFrame([(t,) for t in TIMES], "t string")
    got = [r.p for r in df.select(D.by_hour("t").alias("p")).collect()]
    assert got == ["Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening",
                   "Evening", "Night", "Night", "Morning", "Night", "Unknown", "Unknown"]


def test_day_parts_by_text(spark):
    df = spark.createDataFrame([(t,) for t in TIMES], "t string")
    got = [r.p for r in df.select(D.by_text("t").alias("p")).collect()]
    # unpadded '5' and '930' compare as text: both sort after '2100'
    assert got == ["Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening",
                   "Evening", "Night", "Night", "Night", "Night", "Unknown", "Night"]


def test_day_parts_padding_makes_rules_agree(spark):
    df = spark.createDataFrame([(t,) for t in TIMES[:12]], "t string")
    a = [r.p for r in df.select(D.by_hour("t", pad=True).alias("p")).collect()]
    b = [r.p for r in df.select(D.by_text("t", pad=True).alias("p")).collect()]
    assert a == b


def test_decode_labels(spark):
    df = spark.createDataFrame([("W",), ("Z",), ("Q",), (None,)], "c string")
    got = [r.l for r in df.select(decode("c").alias("l")).collect()]
    assert got == ["White", "Asian Indian", "Q", None]
    assert len(DESCENT_LABELS) == 19


def _dist(spark, pairs, iterations=6):
    df = spark.createDataFrame(pairs, "a double, b double, c double, d double")
    return [r.km for r in with_geodesic_km(df, "a", "b", "c", "d", "km", iterations).collect()]


def test_geodesic_reference_point(spark):
    # Newport, RI to Cleveland, OH: 866.4554329 km on WGS-84 (published example)
    (km,) = _dist(spark, [(41.49008, -71.312796, 41.499498, -81.695391)])
    assert km == pytest.approx(866.4554329, abs=1e-6)


def test_geodesic_zero_and_symmetry(spark):
    a, b, c = _dist(spark, [(34.05, -118.25, 34.05, -118.25),
                            (34.05, -118.25, 33.94, -118.40),
                            (33.94, -118.40, 34.05, -118.25)])
    assert a == 0.0
    assert b == pytest.approx(c, abs=1e-9)
    assert 15 < b < 20


def test_geodesic_short_pair_converges(spark):
    four, six = _dist(spark, [(34.0, -118.0, 34.08, -118.05)], 4)[0], _dist(spark, [(34.0, -118.0, 34.08, -118.05)])[0]
    assert four == pytest.approx(six, abs=1e-9)
    assert not math.isnan(six)
