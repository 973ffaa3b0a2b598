"""Registry of the end-to-end queries over the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame; the DuckDB
twin of each lives under the same key in ``citypulse.oracle.SQL``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from .functions import lenient as L
from .functions.geodesy import with_geodesic_km
from .functions.labels import decode
from .operators.joins import NO_AUTO_BROADCAST
from .operators.dedupe import distinct_moving_copies
from .operators.nearest import nearest
from .operators.rows import dedup_rows, ordered_limit, project, q, rename
from .operators.scoped import built_with, planned_with
from .plans import day_parts as W2
from .plans import income_extremes as W3
from .plans import station_distance as W4
from .plans import top_months as W1
from .plans.incidents import combined, row_count, typed_ingest
from .operators.skew import hot_key_join
from .sources import csv as CSV
from .sources import tables as T
from .sources.derived import DerivedTables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


_parts, _geo, _income, _stations = T.incident_parts, T.geocode, T.income, T.stations


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


@register("top_months_df")
def _top_months_df(spark, sf_dir):
    return W1.top_months_df(_parts(spark, sf_dir))


@register("top_months_sql")
def _top_months_sql(spark, sf_dir):
    return W1.top_months_sql(spark, _parts(spark, sf_dir))


# ------------------------------------------------------------- W2 day parts


@register("day_parts_df")
def _day_parts_df(spark, sf_dir):
    return W2.day_parts_df(_parts(spark, sf_dir))


@register("day_parts_sql")
def _day_parts_sql(spark, sf_dir):
    return W2.day_parts_sql(spark, _parts(spark, sf_dir))


@register("day_parts_rows")
def _day_parts_rows(spark, sf_dir):
    return W2.day_parts_rows(_parts(spark, sf_dir))


@register("sort_by_time_code")
def _sort_by_time_code(spark, sf_dir):
    return W2.street_rows_by_time(_parts(spark, sf_dir))


# ------------------------------------------------------- W3 income extremes


def _w3_tables(spark, sf_dir, name):
    shared = name in T.SHARED_POSITIONS
    return _parts(spark, sf_dir, shared), _geo(spark, sf_dir, shared), _income(spark, sf_dir)


def _w3(spark, sf_dir, name, strategy):
    return W3.income_extremes(*_w3_tables(spark, sf_dir, name), strategy, community_like=T.COMMUNITY_PATTERN)


def _w3_variant(name, strategy):
    return lambda spark, sf_dir: _w3(spark, sf_dir, name, strategy)


for _s, _key in (("auto", "auto"), ("broadcast", "broadcast"), ("merge", "merge"),
                 ("merge_small", "merge_small"), ("shuffle_hash", "shuffle_hash"),
                 ("shuffle_replicate_nl", "replicate_nl")):
    for _name in (f"income_extremes_{_key}", f"join_hint_{_key}")[:1 if _s == "auto" else 2]:
        QUERIES[_name] = _w3_variant(_name, _s)


def _w3_sql_variant(name, strategy="auto"):
    return lambda spark, sf_dir: W3.income_extremes_sql(
        spark, *_w3_tables(spark, sf_dir, name), community_like=T.COMMUNITY_PATTERN, strategy=strategy)


QUERIES["income_extremes_sql"] = _w3_sql_variant("income_extremes_sql")


for _s, _key in (("broadcast", "broadcast"), ("merge", "merge"), ("merge_small", "merge_small"),
                 ("shuffle_hash", "shuffle_hash"), ("shuffle_replicate_nl", "replicate_nl")):
    _name = f"income_extremes_sql_{_key}"
    QUERIES[_name] = _w3_sql_variant(_name, _s)


@register("join_scoped_threshold")
def _join_scoped_threshold(spark, sf_dir):
    """The unhinted report, run without size-based broadcast wherever it is collected."""
    return planned_with(_w3(spark, sf_dir, "join_scoped_threshold", "auto"), NO_AUTO_BROADCAST)


@register("join_scoped_threshold_sql")
def _join_scoped_threshold_sql(spark, sf_dir):
    """The SQL text, registered and run in a session of its own without size-based broadcast."""
    def build(session, parts, geocode, income):
        return W3.income_extremes_sql(session, parts, geocode, income, community_like=T.COMMUNITY_PATTERN)

    return built_with(spark, NO_AUTO_BROADCAST, build, *_w3_tables(spark, sf_dir, "join_scoped_threshold_sql"))


# ------------------------------------------------------ W4 station distance


def _rounded(report):
    """Means to 4 decimals, for the comparison with the oracle."""
    return report.withColumn("average_distance", F.round("average_distance", 4))


def _own_rows(spark, sf_dir, strategy="auto"):
    return W4.own_station_rows(_parts(spark, sf_dir), _stations(spark, sf_dir), strategy)


def _nearest_rows(spark, sf_dir):
    return W4.nearest_station_rows(_parts(spark, sf_dir), _stations(spark, sf_dir),
                                   station_order=F.col("FID").try_cast("long"))


@register("own_dist_by_year")
def _own_by_year(spark, sf_dir):
    return _rounded(W4.report_sql(spark, _own_rows(spark, sf_dir), "year"))


@register("own_dist_by_division")
def _own_by_division(spark, sf_dir):
    return _rounded(W4.report_sql(spark, _own_rows(spark, sf_dir), "division"))


def _own_variant(strategy):
    return lambda spark, sf_dir: _rounded(W4.by_division(_own_rows(spark, sf_dir, strategy)))


for _s, _key in (("broadcast", "broadcast"), ("merge", "merge"),
                 ("shuffle_hash", "shuffle_hash"), ("shuffle_replicate_nl", "replicate_nl")):
    QUERIES[f"own_dist_{_key}"] = _own_variant(_s)


def _own_sql_variant(strategy):
    return lambda spark, sf_dir: _rounded(W4.report_sql(
        spark, W4.own_station_rows_sql(spark, _parts(spark, sf_dir), _stations(spark, sf_dir), strategy),
        "division"))


for _s, _key in (("broadcast", "broadcast"), ("merge", "merge"),
                 ("shuffle_hash", "shuffle_hash"), ("shuffle_replicate_nl", "replicate_nl")):
    QUERIES[f"own_dist_sql_{_key}"] = _own_sql_variant(_s)


@register("nearest_by_year")
def _nearest_by_year(spark, sf_dir):
    return _rounded(W4.by_year(_nearest_rows(spark, sf_dir)))


@register("nearest_sql_by_year")
def _nearest_sql_by_year(spark, sf_dir):
    return _rounded(W4.report_sql(spark, _nearest_rows(spark, sf_dir), "year"))


@register("nearest_sql_by_division")
def _nearest_sql_by_division(spark, sf_dir):
    return _rounded(W4.report_sql(spark, _nearest_rows(spark, sf_dir), "division"))


@register("nearest_by_division")
def _nearest_by_division(spark, sf_dir):
    return _rounded(W4.by_division(_nearest_rows(spark, sf_dir)))


# ------------------------------------------- single operators of the inventory
# Each key isolates one operator of the reference over the same derived
# tables; the end-to-end reports above combine them.

TEXT_COLUMNS = [c.strip() for c in T.INCIDENT_COLUMNS]
HOT_ROWS = 100_000   # rows of one position that a task of the two-key join may get
HOT_PAIRS = 50_000_000   # and pairs of them that it may return


def _incidents(spark, sf_dir):
    return combined(_parts(spark, sf_dir))


def _parts_as_csv(spark, sf_dir) -> list[str]:
    """The four parts as header CSV folders (the reference's input format), written once
    per application; returns their paths."""
    def write(path):
        for i, part in enumerate(_parts(spark, sf_dir), 1):
            CSV.write_header_csv(part, f"{path}/part{i}")

    names = [f"{sf_dir}/{t}.parquet" for t in ("orders", "events", "supplier")]
    folder = DerivedTables.of(spark).path("incidents-csv", names, write)
    return [f"{folder}/part{i}" for i in range(1, T.N_PARTS + 1)]


@register("scan_csv_header")
def _scan_csv_header(spark, sf_dir):
    return CSV.union_parts([CSV.read_header_csv(spark, p) for p in _parts_as_csv(spark, sf_dir)])


TYPED_SCHEMA = TY.StructType([
    TY.StructField("DR_NO", TY.StringType()),
    TY.StructField("Date Rptd", TY.TimestampNTZType()),
    TY.StructField("DATE OCC", TY.TimestampNTZType()),
    TY.StructField("TIME OCC", TY.StringType()),
    TY.StructField("AREA", TY.StringType()),
    TY.StructField("Premis Desc", TY.StringType()),
    TY.StructField("Vict Age", TY.IntegerType()),
    TY.StructField("Vict Descent", TY.StringType()),
    TY.StructField("Weapon Used Cd", TY.IntegerType()),
    TY.StructField("LAT", TY.DoubleType()),
    TY.StructField("LON", TY.DoubleType()),
])


@register("scan_csv_typed")
def _scan_csv_typed(spark, sf_dir):
    return CSV.union_parts([CSV.read_typed_csv(spark, p, TYPED_SCHEMA) for p in _parts_as_csv(spark, sf_dir)])


@register("union_parts")
def _union_parts(spark, sf_dir):
    return CSV.union_parts(_parts(spark, sf_dir))


@register("union_distinct")
def _union_distinct(spark, sf_dir):
    return CSV.union_distinct(_parts(spark, sf_dir))


@register("dedup_rows")
def _dedup_rows(spark, sf_dir):
    return dedup_rows(CSV.union_parts(_parts(spark, sf_dir)))


@register("dedup_few_copies")
def _dedup_few_copies(spark, sf_dir):
    """The same rows as ``dedup_rows``; only rows that may have a copy are shuffled."""
    return distinct_moving_copies(CSV.union_parts(_parts(spark, sf_dir)))


@register("union_filtered_parts")
def _union_filtered_parts(spark, sf_dir):
    parts = [CSV.trim_names(p).filter(q("Premis Desc") == "STREET")
             for p in _parts(spark, sf_dir)]
    return CSV.union_distinct(parts)


@register("typed_ingest")
def _typed_ingest(spark, sf_dir):
    return typed_ingest(_parts(spark, sf_dir))


@register("row_count")
def _row_count(spark, sf_dir):
    return row_count(typed_ingest(_parts(spark, sf_dir)))


@register("project_columns")
def _project_columns(spark, sf_dir):
    return project(_incidents(spark, sf_dir), ["DR_NO", "DATE OCC"])


@register("rename_columns")
def _rename_columns(spark, sf_dir):
    inc = project(_incidents(spark, sf_dir), ["DR_NO", "AREA", "Premis Desc"])
    return rename(inc, {"DR_NO": "#", "AREA": "Area Code", "Premis Desc": "Total Crimes"})


@register("select_star")
def _select_star(spark, sf_dir):
    _incidents(spark, sf_dir).createOrReplaceTempView("cp_select_star")
    return spark.sql("SELECT * FROM cp_select_star")


@register("filter_equality")
def _filter_equality(spark, sf_dir):
    return _incidents(spark, sf_dir).filter(q("Premis Desc") == "STREET")


@register("filter_code_range")
def _filter_code_range(spark, sf_dir):
    w = L.to_int(q("Weapon Used Cd"))
    return _incidents(spark, sf_dir).filter((w >= 100) & (w < 200))


@register("filter_nonzero_coords")
def _filter_nonzero_coords(spark, sf_dir):
    return _incidents(spark, sf_dir).filter((q("LAT") != "0") & (q("LON") != "0"))


@register("filter_not_null")
def _filter_not_null(spark, sf_dir):
    return _incidents(spark, sf_dir).filter(L.parse_timestamp(q("DATE OCC")).isNotNull())


@register("filter_like")
def _filter_like(spark, sf_dir):
    return _income(spark, sf_dir).filter(q("Community").like(T.COMMUNITY_PATTERN))


@register("join_single_key")
def _join_single_key(spark, sf_dir):
    inc = W4.firearm_incidents(_parts(spark, sf_dir))
    st = _stations(spark, sf_dir)
    return inc.join(st, inc["AREA"] == st["FID"]).select(
        "DR_NO", q("DATE OCC"), "LAT", "LON", "X", "Y", "DIVISION")


@register("join_composite_key")
def _join_composite_key(spark, sf_dir):
    shared = "join_composite_key" in T.SHARED_POSITIONS
    inc = combined(_parts(spark, sf_dir, shared), moving_copies=True)   # whole rows are most of what it would shuffle
    inc = inc.filter(q("Vict Descent").isNotNull()).select("DR_NO", "LAT", "LON", q("Vict Descent"))
    geo = (_geo(spark, sf_dir, shared).withColumnsRenamed({"LAT": "g_lat", "LON": "g_lon"})
           .filter(q("ZIPcode").isNotNull()))
    j = hot_key_join(inc, geo, [("LAT", "g_lat"), ("LON", "g_lon")], rows_per_task=HOT_ROWS, pairs_per_task=HOT_PAIRS)
    return j.select("DR_NO", q("Vict Descent"), "ZIPcode")


@register("group_count")
def _group_count(spark, sf_dir):
    return (_incidents(spark, sf_dir).groupBy("AREA", q("Vict Descent"))
            .agg(F.count(F.lit(1)).alias("count")))


@register("group_by_alias")
def _group_by_alias(spark, sf_dir):
    _geo(spark, sf_dir).createOrReplaceTempView("cp_geocode")
    return spark.sql("SELECT substring(ZIPcode, 1, 5) AS zip_code, count(*) AS n "
                     "FROM cp_geocode GROUP BY zip_code")


@register("limit_rows")
def _limit_rows(spark, sf_dir):
    return ordered_limit(typed_ingest(_parts(spark, sf_dir)), [q("DR_NO")], 50)


@register("top_bottom_k")
def _top_bottom_k(spark, sf_dir):
    return W3.top_and_last(_income(spark, sf_dir), T.COMMUNITY_PATTERN)


@register("parse_timestamp")
def _parse_timestamp(spark, sf_dir):
    return _incidents(spark, sf_dir).select(
        "DR_NO", L.parse_timestamp(q("DATE OCC")).alias("occurred"))


@register("date_parts")
def _date_parts(spark, sf_dir):
    ts = L.parse_timestamp(q("DATE OCC"))
    return _incidents(spark, sf_dir).select("DR_NO", L.year_of(ts).alias("Year"),
                                            L.month_of(ts).alias("Month"))


@register("cast_lenient")
def _cast_lenient(spark, sf_dir):
    return _incidents(spark, sf_dir).select(
        "DR_NO", L.to_int(q("Vict Age")).alias("age"),
        L.to_int(q("Weapon Used Cd")).alias("weapon"),
        L.to_double(q("LAT")).alias("lat"), L.to_double(q("LON")).alias("lon"))


@register("parse_money")
def _parse_money(spark, sf_dir):
    return _income(spark, sf_dir).select(
        q("Zip Code"), L.parse_money(q("Estimated Median Income")).alias("income"))


@register("zip_prefix")
def _zip_prefix(spark, sf_dir):
    return _geo(spark, sf_dir).select("ZIPcode", L.zip_prefix("ZIPcode").alias("zip_code"))


@register("decode_labels")
def _decode_labels(spark, sf_dir):
    return _incidents(spark, sf_dir).select(
        "DR_NO", q("Vict Descent"), decode(q("Vict Descent")).alias("victim_category"))


@register("geodesic_distance")
def _geodesic_distance(spark, sf_dir):
    inc = W4.firearm_incidents(_parts(spark, sf_dir))
    st = _stations(spark, sf_dir)
    j = inc.join(st, inc["AREA"] == st["FID"]).select(
        "DR_NO", L.to_double("LAT").alias("lat1"), L.to_double("LON").alias("lon1"),
        L.to_double("Y").alias("lat2"), L.to_double("X").alias("lon2"))
    j = with_geodesic_km(j, "lat1", "lon1", "lat2", "lon2", "distance")
    return j.select("DR_NO", F.round("distance", 4).alias("distance"))


@register("nearest_station")
def _nearest_station(spark, sf_dir):
    inc = W4.firearm_incidents(_parts(spark, sf_dir))
    pts = inc.select("LAT", "LON").distinct().select(
        "LAT", "LON", L.to_double("LAT").alias("plat"), L.to_double("LON").alias("plon"))
    st = _stations(spark, sf_dir).select(
        L.to_double("Y").alias("slat"), L.to_double("X").alias("slon"),
        F.col("FID").try_cast("long").alias("seq"), "DIVISION")
    near = nearest(pts, st, ["LAT", "LON"], "plat", "plon", "slat", "slon", "seq", ["DIVISION"])
    return near.select("LAT", "LON", F.round("distance", 4).alias("distance"), "DIVISION")
