"""Readers and the multi-part union."""

import os

from pyspark.sql import types as T

from citypulse.sources.csv import (read_header_csv, read_typed_csv, trim_names, union_distinct,
                                   union_parts, write_header_csv)

from fixtures import INCIDENT_HEADER, LAST_HEADER, write_csv, write_incident_csvs


def test_header_csv_is_all_text_and_trims_names(spark, tmp_dir):
    p = write_csv(os.path.join(tmp_dir, "a.csv"), ["AREA ", " LAT", "n"], [["01", "34.10", "5"]])
    df = read_header_csv(spark, p)
    assert df.columns == ["AREA", "LAT", "n"]
    assert all(t == "string" for _, t in df.dtypes)
    assert df.first()["AREA"] == "01" and df.first()["LAT"] == "34.10"   # text kept as is
    raw = read_header_csv(spark, p, trim=False)
    assert raw.columns[0] == "AREA "


def test_union_parts_positional_keeps_duplicates(spark, tmp_dir):
    paths = write_incident_csvs(tmp_dir)
    parts = [read_header_csv(spark, p, trim=False) for p in paths]
    assert parts[3].columns == LAST_HEADER
    u = union_parts(parts)
    assert u.columns == [c.strip() for c in INCIDENT_HEADER]
    assert u.count() == 22 and union_distinct(parts).count() == 21


def test_typed_csv_lenient(spark, tmp_dir):
    p = write_csv(os.path.join(tmp_dir, "t.csv"), ["id", "when", "age", "lat"],
                  [["1", "01/05/2010 01:30:00 PM", "30", "34.1"], ["2", "junk", "x", "abc"]])
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("when", T.TimestampNTZType()),
                           T.StructField("age", T.IntegerType()), T.StructField("lat", T.DoubleType())])
    rows = read_typed_csv(spark, p, schema).orderBy("id").collect()
    assert rows[0].when.hour == 13 and rows[0].age == 30 and rows[0].lat == 34.1
    assert rows[1].when is None and rows[1].age is None and rows[1].lat is None


def test_write_then_read_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("a", None), ("b", "x")], "k string, v string")
    path = write_header_csv(df, os.path.join(tmp_dir, "out"))
    back = read_header_csv(spark, path).orderBy("k").collect()
    assert [(r.k, r.v) for r in back] == [("a", None), ("b", "x")]


def test_trim_names_noop(spark):
    df = spark.range(1)
    assert trim_names(df) is df
