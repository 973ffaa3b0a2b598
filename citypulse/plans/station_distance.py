"""W4: firearm incidents and their distance to a police station.

* W4a - to the station responsible for the incident's area
  (equi-join ``FID = AREA`` on text, under a selectable join strategy);
* W4b - to the nearest station (exact grid search, no cross join).

Each yields (year, division, distance_km, n) rows, where ``n`` counts
distinct incident rows sharing (area, year, position): distance depends
only on the position and the station, so rows are pre-aggregated before
the join and the distance is computed once per distinct position.  A hot
position or area (a third of all rows) collapses map-side to one row per
task.  Reports take a count-weighted mean, which equals the per-row mean.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lenient as L
from ..functions.geodesy import _batches, vincenty_steps, with_geodesic_km
from ..operators.joins import granted, strategy_join
from ..operators.nearest import nearest
from ..operators.rows import q
from ..sources.csv import trim_names
from ..sources.order import reading_order
from .incidents import distinct_incidents
from .top_months import distinct_sql, number_key_sql, register_parts

# The firearm code range [100, 200) and the "no position" text.
FIREARM_CODES = (100, 200)
ZERO_TEXT = "0"


def firearm_filter(df: DataFrame, codes=FIREARM_CODES) -> DataFrame:
    """Weapon code in [lo, hi) as integer (bad text drops the row) and a
    position other than the text '0' (NULL drops too)."""
    w = L.to_int(q("Weapon Used Cd"))
    return df.filter((w >= codes[0]) & (w < codes[1])
                     & (q("LAT") != ZERO_TEXT) & (q("LON") != ZERO_TEXT))


def firearm_incidents(parts: Sequence[DataFrame], codes=FIREARM_CODES,
                      dedup_keys: Sequence[str] | None = None) -> DataFrame:
    """Filter in every part, then UNION (distinct), as the reference does;
    ``dedup_keys``: see ``distinct_incidents`` (its columns only)."""
    filtered = [firearm_filter(trim_names(p), codes) for p in parts]
    return distinct_incidents(filtered, ["AREA", "DATE OCC", "LAT", "LON"], dedup_keys=dedup_keys)


def _year() -> F.Column:
    return L.year_of(L.parse_timestamp(q("DATE OCC"))).alias("year")


def own_station_rows(parts: Sequence[DataFrame], stations: DataFrame,
                     strategy: str = "auto", hint_side: str = "right",
                     dedup_keys: Sequence[str] | None = None,
                     normalize_keys: bool = False) -> DataFrame:
    """(year, DIVISION, distance_km, n) by the area's own station.

    ``normalize_keys`` matches area and station numbers as integers
    (``'01'`` = ``'1'``) instead of as text."""
    key = (lambda c: L.number_key(q(c), "bigint")) if normalize_keys else q
    inc = firearm_incidents(parts, dedup_keys=dedup_keys)
    agg = inc.groupBy(key("AREA").alias("AREA"), _year(), q("LAT"), q("LON")).agg(F.count(F.lit(1)).alias("n"))
    st = trim_names(stations).select(key("FID").alias("FID"), q("X"), q("Y"), q("DIVISION"))
    joined = strategy_join(agg, st, agg["AREA"] == st["FID"], "inner", strategy, hint_side)
    joined = joined.select(
        "year", "DIVISION", "n",
        L.to_double(q("LAT")).alias("__lat1"), L.to_double(q("LON")).alias("__lon1"),
        L.to_double(q("Y")).alias("__lat2"), L.to_double(q("X")).alias("__lon2"))
    joined = with_geodesic_km(joined, "__lat1", "__lon1", "__lat2", "__lon2", "distance")
    return joined.select("year", "DIVISION", "distance", "n")


def nearest_station_rows(parts: Sequence[DataFrame], stations: DataFrame,
                         station_order: F.Column | None = None,
                         dedup_keys: Sequence[str] | None = None) -> DataFrame:
    """(year, DIVISION, distance_km, n) by the nearest station.

    ``station_order`` decides ties (first wins); by default the order in which the
    stations stand in their files (``sources.order``).
    """
    inc = firearm_incidents(parts, dedup_keys=dedup_keys)
    agg = (inc.groupBy(_year(), q("LAT"), q("LON")).agg(F.count(F.lit(1)).alias("n"))
           .checkpoint())
    points = agg.select(q("LAT"), q("LON")).distinct().select(
        q("LAT"), q("LON"),
        L.to_double(q("LAT")).alias("__plat"), L.to_double(q("LON")).alias("__plon"))
    st = trim_names(stations)
    order = station_order if station_order is not None else reading_order(st)
    st = st.select(L.to_double(q("Y")).alias("__slat"), L.to_double(q("X")).alias("__slon"),
                   order.alias("__seq"), q("DIVISION"))
    near = nearest(points, st, ["LAT", "LON"], "__plat", "__plon", "__slat", "__slon",
                   "__seq", ["DIVISION"], distance="distance")
    # as many positions on either side: neither goes through the driver
    joined = agg.join(near.hint("merge"), ["LAT", "LON"], "left")
    return joined.select("year", "DIVISION", "distance", "n")


def _weighted(rows: DataFrame, key: F.Column, key_name: str) -> DataFrame:
    d, n = F.col("distance"), F.col("n")
    return rows.groupBy(key.alias(key_name)).agg(
        (F.sum(d * n) / F.sum(F.when(d.isNotNull(), n))).alias("average_distance"),
        F.sum(n).cast("bigint").alias("count"))


def by_year(rows: DataFrame) -> DataFrame:
    return _weighted(rows, F.col("year"), "year").orderBy("year")


def by_division(rows: DataFrame) -> DataFrame:
    return _weighted(rows, F.col("DIVISION"), "division").orderBy(F.col("count").desc(), "division")


def report_sql(spark: SparkSession, rows: DataFrame, by: str) -> DataFrame:
    """The two reports as SQL over a temp view of the distance rows."""
    view = "cp_w4_distances"
    rows.createOrReplaceTempView(view)
    avg = "sum(distance * n) / sum(CASE WHEN distance IS NOT NULL THEN n END)"
    if by == "year":
        return spark.sql(f"""
        WITH queryA AS (
            SELECT year, {avg} AS average_distance, CAST(sum(n) AS BIGINT) AS count
            FROM {view} GROUP BY year)
        SELECT * FROM queryA ORDER BY year""")
    return spark.sql(f"""
        WITH queryB AS (
            SELECT DIVISION AS division, {avg} AS average_distance, CAST(sum(n) AS BIGINT) AS count
            FROM {view} GROUP BY DIVISION)
        SELECT * FROM queryB ORDER BY count DESC, division""")


# SQL hint per strategy for the incidents-stations join, on the aliases of
# the SQL form below (the reference names the stations side, or the
# incidents side for the merge join).
SQL_HINTS = {
    "auto": "",
    "broadcast": "/*+ BROADCAST(stations) */",
    "merge": "/*+ MERGEJOIN(crimes) */",
    "shuffle_hash": "/*+ SHUFFLE_HASH(stations) */",
    "shuffle_replicate_nl": "/*+ SHUFFLE_REPLICATE_NL(stations) */",
}


def own_station_rows_sql(spark: SparkSession, parts: Sequence[DataFrame], stations: DataFrame,
                         strategy: str = "auto", codes=FIREARM_CODES,
                         dedup_keys: Sequence[str] | None = None, normalize_keys: bool = False) -> DataFrame:
    """W4a distance rows as one SQL text over temp views, with the
    reference's SQL join hint (granted as in the DataFrame form); ``dedup_keys``
    and ``normalize_keys`` as there."""
    views = register_parts([trim_names(p) for p in parts], "cp_w4")
    trim_names(stations).createOrReplaceTempView("cp_w4_stations")
    hint = SQL_HINTS[granted(spark.table("cp_w4_stations"), strategy)]
    w = "try_cast(`Weapon Used Cd` AS INT)"
    cond = f"{w} >= {codes[0]} AND {w} < {codes[1]} AND LAT != '{ZERO_TEXT}' AND LON != '{ZERO_TEXT}'"
    union = distinct_sql(views, ["AREA", "DATE OCC", "LAT", "LON"], cond, dedup_keys)
    area, fid = (number_key_sql(c, "BIGINT") if normalize_keys else c for c in ("AREA", "stations.FID"))
    pairs = spark.sql(f"""
    WITH combined_crime_data AS (
        {union}
    ), crimes AS (
        SELECT {area} AS AREA, year(try_to_timestamp(`DATE OCC`, '{L.INCIDENT_TS_FORMAT}')) AS year,
               LAT, LON, count(*) AS n
        FROM combined_crime_data
        GROUP BY {area}, year, LAT, LON
    )
    SELECT {hint} crimes.year, stations.DIVISION, crimes.n,
           try_cast(crimes.LAT AS DOUBLE) AS lat1, try_cast(crimes.LON AS DOUBLE) AS lon1,
           try_cast(stations.Y AS DOUBLE) AS lat2, try_cast(stations.X AS DOUBLE) AS lon2
    FROM crimes JOIN cp_w4_stations AS stations ON {fid} = crimes.AREA
    """)
    return spark.sql("SELECT year, DIVISION, distance, n FROM {rows}", rows=_with_distance_sql(spark, pairs))


def _with_distance_sql(spark: SparkSession, pairs: DataFrame, at_once: int = 20) -> DataFrame:
    """``pairs`` with ``distance`` by SQL texts, the steps as chains of WITH; a few
    texts, as the analyzer takes a round per step of a chain."""
    steps = list(_batches(vincenty_steps("lat1", "lon1", "lat2", "lon2", "distance")))
    for at in range(0, len(steps), at_once):
        chain, prev = [], "{rows}"
        for i, batch in enumerate(steps[at:at + at_once]):
            cols = ", ".join(f"{e} AS {c}" for c, e in batch)
            chain.append(f"v{i} AS (SELECT *, {cols} FROM {prev})")
            prev = f"v{i}"
        pairs = spark.sql(f"WITH {', '.join(chain)} SELECT * FROM {prev}", rows=pairs)
    return pairs
