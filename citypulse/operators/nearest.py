"""Exact nearest station per point, by two equi-joins on a grid of local density.

No cross join. Positions lie in earth-centred (ECEF) coordinates; a cell of level k
has edges of ``FINEST_KM * 2**k``, and its number on the finest level, shifted, gives
that on any other. Two facts bound the search: the straight chord between two points of
the ellipsoid never exceeds their geodesic, and a geodesic is never longer
than an arc of the ellipsoid's least radius of curvature over the same chord.

1. *Pyramid*: stations are counted per cell on every second level. A cell with more than
   ``MAX_PER_CELL`` is split; the levels reach as deep as stations are dense, region by
   region. *Posts* stand for the stations: all those of a cell that is not split, one
   of a cell that is.
2. *Reach*: each point meets the posts in the 3 x 3 x 3 block around it, on each
   level that tells cells apart, a bounded number a level. Its least chord bounds the
   geodesic to the nearest station, hence that station's chord.
3. *Search*: on the level whose cells are just wider than that bound, the block
   around the point holds the nearest station. The few stations within the bound get a
   geodesic distance, and the least wins.

A dense cluster deepens the pyramid where it is; points elsewhere and the number of
steps stay as they are. Stations at one exact position collapse to the first in
order (they tie for every point). Each join replicates the smaller side and shuffles both:
Spark's estimate of a side does not count the rows that ``explode`` repeats, so by size it would
broadcast millions of them through the driver; the stations' columns are joined so too, as their
estimate is that of compressed files. Distance (to a nanometre) and the station's number in order are
packed into one fixed-width value, so that minima are taken by hash aggregates, and
the station's columns are joined afterwards. Steps are checkpointed to the shared
checkpoint folder; only single numbers (counts, levels in play) reach the driver.

Distances are WGS-84 km (``citypulse.functions.geodesy``).
"""

from __future__ import annotations

import itertools
import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geodesy import WGS84_A, WGS84_B, ecef_km, valid_position, with_geodesic_km
from ..session import checkpoint_dir

EARTH_SPAN_KM = 12_800.0      # larger than the earth's extent on any axis
TOP = 24                      # the level whose cells are that wide
FINEST_KM = EARTH_SPAN_KM / 2 ** TOP   # 0.76 m
MARGIN_KM = 1e-3              # 1 m: covers rounding of distances and coordinates
MAX_PER_CELL = 4              # station positions of a cell that is not split
FEW_CELLS = 64                # levels with fewer cells in use than this tell little apart
LEAST_RADIUS_KM = WGS84_B ** 2 / WGS84_A / 1000   # least radius of curvature
_OFFSETS = list(itertools.product((-1, 0, 1), repeat=3))
_AXES = "xyz"


def _finest(df: DataFrame) -> DataFrame:
    """The cell on the finest level, ``__fx`` to ``__fz``, of positions ``__x`` to ``__z``."""
    return df.withColumns({f"__f{a}": F.floor(F.col(f"__{a}") / FINEST_KM) for a in _AXES})


def _at(level: Column | int, axis: str) -> Column:
    """The cell number on a level: numbers nest, as shifts round down."""
    return F.call_function("shiftright", F.col(f"__f{axis}"), F.lit(level) if isinstance(level, int) else level.cast("int"))


def _cells(df: DataFrame, around: bool) -> DataFrame:
    """Columns ``__cx`` to ``__cz``: the cell on level ``__k``, or a row for each of the 27 around it."""
    if not around:
        return df.withColumns({f"__c{a}": _at(F.col("__k"), a) for a in _AXES})
    steps = F.array(*[F.struct(*[F.lit(v).alias(a) for a, v in zip(_AXES, o)]) for o in _OFFSETS])
    return (df.select("*", F.explode(steps).alias("__o"))
            .withColumns({f"__c{a}": _at(F.col("__k"), a) + F.col(f"__o.{a}") for a in _AXES}).drop("__o"))


def _on_levels(df: DataFrame, levels: Sequence[int]) -> DataFrame:
    return df.select("*", F.explode(F.array(*[F.lit(v) for v in levels])).alias("__k"))


_CELL = ["__k", "__cx", "__cy", "__cz"]


def pyramid(stations: DataFrame, most: int = MAX_PER_CELL) -> DataFrame:
    """(level, cell, number of stations, first of them) of the cells on every second level whose
    wider cell is split, i.e. holds more than ``most``; the widest level is whole.

    ``stations``: finest cells and a number ``__no``."""
    counted = (_cells(_on_levels(stations, range(TOP, -1, -2)), False)
               .groupBy(*_CELL).agg(F.count(F.lit(1)).alias("__many"), F.min("__no").alias("__least"))).checkpoint()
    split = counted.where(F.col("__many") > most).select((F.col("__k") - 2).alias("__k"), *[F.col(f"__c{a}").alias(f"__w{a}") for a in _AXES])
    inner = counted.withColumns({f"__w{a}": F.shiftright(f"__c{a}", 2) for a in _AXES})
    inner = inner.join(split.hint("merge"), ["__k", "__wx", "__wy", "__wz"], "left_semi").select(counted.columns)
    return counted.where(F.col("__k") == TOP).unionByName(inner)


def _chord2(a: str, b: str) -> Column:
    return sum(((F.col(f"{a}{x}") - F.col(f"{b}{x}")) * (F.col(f"{a}{x}") - F.col(f"{b}{x}")) for x in _AXES), F.lit(0.0))


def nearest(points: DataFrame, stations: DataFrame, key: Sequence[str],
            lat: str, lon: str, s_lat: str, s_lon: str, s_order: str,
            payload: Sequence[str], distance: str = "distance", max_per_cell: int = MAX_PER_CELL) -> DataFrame:
    """For each point the nearest station (geodesic km) and its payload.

    ``points``: unique ``key`` columns plus double ``lat``/``lon`` degrees.
    ``stations``: double ``s_lat``/``s_lon``, a sortable ``s_order`` (first
    wins a tie, to the nanometre) and ``payload`` columns.  Returns ``key + [distance,
    s_order, *payload]``; points without a valid position, or with no station that has
    one, get NULLs.  NULL keys are keys like others.
    """
    outer, payload = list(key), list(payload)
    # one struct of the key columns: unlike bare columns, its NULL fields are equal
    pts = points.select(F.struct(*[F.col(k) for k in outer]).alias("__key"), F.col(lat).alias("__plat"), F.col(lon).alias("__plon"))
    pts = pts.withColumns(dict(zip(("__x", "__y", "__z"), ecef_km("__plat", "__plon"))))
    kept = {f"__pl_{i}": p for i, p in enumerate(payload)}
    sts = (stations.filter(valid_position(s_lat, s_lon))
           .select(F.col(s_lat).alias("__slat"), F.col(s_lon).alias("__slon"),
                   F.col(s_order).alias("__sord"), *[F.col(p).alias(c) for c, p in kept.items()]))
    # stations at one exact position are equally far from every point, so only
    # the first in order can win: keep one row per position (a position holding
    # a third of all stations becomes one row); then number them in order
    sts = (sts.groupBy("__slat", "__slon").agg(F.min(F.struct("__sord", *kept)).alias("__m"))
           .select("__slat", "__slon", "__m.*").orderBy("__sord", *kept, "__slat", "__slon")
           .withColumn("__no", F.monotonically_increasing_id()))
    sts = sts.withColumns(dict(zip(("__x", "__y", "__z"), ecef_km("__slat", "__slon"))))

    checkpoint_dir(points.sparkSession)
    sts = _finest(sts).checkpoint()
    types = {f.name: f.dataType for f in sts.schema.fields}
    unfold = [F.col(f"__key.`{k}`").alias(k) for k in outer]
    nothing = [F.lit(None).cast("double").alias(distance), F.lit(None).cast(types["__sord"]).alias(s_order),
               *[F.lit(None).cast(types[c]).alias(p) for c, p in kept.items()]]
    cells = pyramid(sts, max_per_cell).checkpoint()
    in_use = {r["__k"]: r["n"] for r in cells.groupBy("__k").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not in_use:
        return pts.select(*unfold, *nothing)
    # on the widest level a block holds all posts; others with few cells tell as little
    levels = [k for k in sorted(in_use) if k == TOP or in_use[k] > FEW_CELLS or k == min(in_use)]

    usable = valid_position("__plat", "__plon")
    pts = _finest(pts).checkpoint()
    good = pts.filter(usable)
    n_points, n_stations = good.count(), sts.count()
    spot = ["__key", "__plat", "__plon", *[f"__p{a}" for a in _AXES], *[f"__f{a}" for a in _AXES]]
    good = good.withColumnsRenamed({f"__{a}": f"__p{a}" for a in _AXES})

    posts = _cells(_on_levels(sts.select("__no", "__x", "__y", "__z", *[f"__f{a}" for a in _AXES]), levels), False)
    posts = posts.join(cells.hint("merge"), _CELL).where((F.col("__many") <= max_per_cell) | (F.col("__no") == F.col("__least")))
    posts = posts.select("__k", "__x", "__y", "__z", *[f"__f{a}" for a in _AXES])
    fewer_stations = n_points > n_stations
    met = (_cells(_on_levels(good, levels), not fewer_stations)
           .join(_cells(posts, fewer_stations).drop(*[f"__f{a}" for a in _AXES]).hint("merge"), _CELL))
    met = met.groupBy(*spot).agg(F.min(_chord2("__p", "__")).alias("__c2"))
    half = F.sqrt("__c2") / (2 * LEAST_RADIUS_KM)
    reach = F.when(half < 1, 2 * LEAST_RADIUS_KM * F.asin(half) + MARGIN_KM).otherwise(EARTH_SPAN_KM)
    met = met.withColumn("__reach", reach)
    wide = F.greatest(F.lit(0), F.least(F.lit(TOP), F.ceil(F.log2(F.col("__reach") / FINEST_KM)))).cast("int")
    met = met.withColumn("__k", wide).checkpoint()
    found = [r[0] for r in met.select("__k").distinct().collect()] or [TOP]

    fewer_stations = n_points > n_stations * len(found)
    near = _cells(met, not fewer_stations).drop(*[f"__f{a}" for a in _AXES])
    there = _cells(_on_levels(sts.select("__no", "__slat", "__slon", "__x", "__y", "__z", *[f"__f{a}" for a in _AXES]), found), fewer_stations)
    near = near.join(there.drop(*[f"__f{a}" for a in _AXES]).hint("merge"), _CELL).where(_chord2("__p", "__") <= F.col("__reach") * F.col("__reach"))
    near = near.select("__key", "__plat", "__plon", "__slat", "__slon", "__no")
    near = with_geodesic_km(near, "__plat", "__plon", "__slat", "__slon", "__d")
    shift = "CAST('10000000000000000000' AS DECIMAL(20,0))"  # above every number
    packed = F.expr(f"CAST(CAST(round(__d * 1e12) AS DECIMAL(17,0)) * {shift} + __no AS DECIMAL(38,0))")
    best = (near.groupBy("__key").agg(F.min(packed).alias("__w"), F.min("__d").alias("__d"))
            .select("__key", "__d", F.expr(f"CAST(__w % {shift} AS BIGINT)").alias("__no")))
    best = best.join(sts.select("__no", "__sord", *kept).hint("merge"), "__no")
    best = best.select(*unfold, F.col("__d").alias(distance), F.col("__sord").alias(s_order), *[F.col(c).alias(p) for c, p in kept.items()])
    # points without a valid position keep NULLs
    return pts.filter(~usable).select(*unfold, *nothing).unionByName(best)
