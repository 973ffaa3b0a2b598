"""One rule for positions in both forms of the distance, and ties by reading order."""

import pytest

from citypulse.plans import station_distance as W4
from citypulse.sources.csv import read_header_csv, write_header_csv
from citypulse.sources.tables import INCIDENT_COLUMNS

POSITIONS = [("34.0", "-118.0"), ("NaN", "-118.0"), ("340.1", "-118.0"), ("34.0", "361"), ("34.0", "242.0"), ("x", "1"),
             ("Infinity", "0"), ("-34.0", "62.0"), ("-34.1", "61.9")]


def incidents(spark):
    rows = [{**dict.fromkeys(INCIDENT_COLUMNS), "DR_NO": str(i), "DATE OCC": "01/05/2010 01:30:00 PM", "AREA ": str(1 + i % 2),
             "Weapon Used Cd": "102", "LAT": lat, "LON": lon} for i, (lat, lon) in enumerate(POSITIONS)]
    schema = ", ".join(f"`{c}` string" for c in INCIDENT_COLUMNS)
    return [spark.createDataFrame([tuple(r[c] for c in INCIDENT_COLUMNS) for r in rows], schema)]


def stations(spark, rows=(("-118.2", "34.05", "1", "Central"), ("-118.3", "34.0", "2", "West"))):
    return spark.createDataFrame(list(rows), "X string, Y string, FID string, DIVISION string")


@pytest.mark.parametrize("bad", [None, ("-118.3", "95.0", "2", "West"), ("NaN", "34.0", "2", "West")])
def test_both_forms_give_the_same_distances(spark, bad):
    st = stations(spark, [("-118.2", "34.05", "1", "Central"), bad]) if bad else stations(spark)
    plain = W4.own_station_rows(incidents(spark), st)
    text = W4.own_station_rows_sql(spark, incidents(spark), st)
    rows, other = ([(r.year, r.DIVISION, r.n, r.distance) for r in df.collect()] for df in (plain, text))
    assert sorted(map(repr, rows)) == sorted(map(repr, other))
    by = {(division, distance is None) for _, division, _, distance in rows}
    assert ("Central", True) in by and ("Central", False) in by         # NaN, 340.1 and 361 have none
    if bad is None:
        assert max(r[3] for r in rows if r[3] is not None) > 19_900    # the other side of the world has one
    else:
        assert ("West", False) not in by


def test_ties_follow_the_files_in_any_layout(spark, tmp_dir):
    twins = [("-118.2", "34.05", str(i), f"d{i}") for i in (5, 3, 9, 1, 7, 8)] + [("-118.9", "34.05", "2", "far")]
    whole = write_header_csv(stations(spark, twins).coalesce(1), f"{tmp_dir}/one")
    parts = [write_header_csv(stations(spark, twins[a:b]).coalesce(1), f"{tmp_dir}/many{i}")
             for i, (a, b) in enumerate([(0, 1), (1, 5), (5, 7)])]
    got = [{r.DIVISION for r in W4.nearest_station_rows(incidents(spark), read_header_csv(spark, p)).collect() if r.distance is not None}
           for p in (whole, parts, list(reversed(parts)))]
    assert got == [{"d5", "far"}] * 3               # the first in the files, not the least name or FID
