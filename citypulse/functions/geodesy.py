"""Ellipsoidal (WGS-84) distance as native column expressions.

The distance is Vincenty's inverse solution with a fixed number of
iterations, written as a sequence of named steps.  Each step is one SQL
expression over earlier steps; Spark applies them as chained projections
(``withColumns``), which keeps the expression tree linear instead of
nesting it (a nested form grows exponentially), and every step stays in
whole-stage codegen.  Coincident points give 0.  Pairs on nearly opposite sides
of the earth, where the iteration does not settle, are solved by bisection
of the azimuth (``far_side_km``), evaluated for those rows only.  A position
that is not valid (``is_valid``) gives NULL; the steps hold that rule themselves,
so the DataFrame and the SQL forms share it.

``ecef_km`` gives earth-centred coordinates used by the nearest-station
grid: the straight chord between two points never exceeds their geodesic
distance, which is what makes the grid search exact.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The WGS-84 ellipsoid.
WGS84_A = 6378137.0                      # semi-major axis, metres
WGS84_F = 1 / 298.257223563              # flattening
WGS84_B = WGS84_A * (1 - WGS84_F)        # semi-minor axis, metres
WGS84_E2 = WGS84_F * (2 - WGS84_F)       # first eccentricity squared

DEFAULT_ITERATIONS = 6
SETTLED = 1e-10                          # radians: under 1 mm on the ground
BISECTIONS = 56                          # halvings of a half turn: down to the last bit
PREFIX = "__vin_"


def _lit(x: float) -> str:
    # exponent form is a DOUBLE literal in both Spark SQL and DuckDB
    r = repr(float(x))
    return r if "e" in r else r + "e0"


def vincenty_steps(lat1: str, lon1: str, lat2: str, lon2: str,
                   out: str, iterations: int = DEFAULT_ITERATIONS,
                   prefix: str = PREFIX) -> list[tuple[str, str]]:
    """(column, SQL expression) pairs computing ``out`` in km.

    Input names are SQL identifiers (quote them if needed).
    """
    p = prefix
    f, a, b = _lit(WGS84_F), _lit(WGS84_A), _lit(WGS84_B)
    one_f = _lit(1 - WGS84_F)
    ab2 = _lit((WGS84_A ** 2 - WGS84_B ** 2) / WGS84_B ** 2)
    steps = [
        (f"{p}d", f"radians({lon2}) - radians({lon1})"),
        (f"{p}l", f"{p}d - 2e0 * pi() * floor(({p}d + pi()) / (2e0 * pi()))"),
        (f"{p}u1", f"atan({one_f} * tan(radians({lat1})))"),
        (f"{p}u2", f"atan({one_f} * tan(radians({lat2})))"),
        (f"{p}su1", f"sin({p}u1)"),
        (f"{p}cu1", f"cos({p}u1)"),
        (f"{p}su2", f"sin({p}u2)"),
        (f"{p}cu2", f"cos({p}u2)"),
        (f"{p}lam0", f"{p}l"),
    ]
    for i in range(1, iterations + 1):
        lam = f"{p}lam{i - 1}"
        s = f"_{i}"
        sl, cl, ss, cs = f"{p}sl{s}", f"{p}cl{s}", f"{p}ss{s}", f"{p}cs{s}"
        sig, sa, c2a, c2m, cc = f"{p}sig{s}", f"{p}sa{s}", f"{p}c2a{s}", f"{p}c2m{s}", f"{p}cc{s}"
        steps += [
            (sl, f"sin({lam})"),
            (cl, f"cos({lam})"),
            (ss, f"sqrt(({p}cu2 * {sl}) * ({p}cu2 * {sl}) + "
                 f"({p}cu1 * {p}su2 - {p}su1 * {p}cu2 * {cl}) * "
                 f"({p}cu1 * {p}su2 - {p}su1 * {p}cu2 * {cl}))"),
            (cs, f"{p}su1 * {p}su2 + {p}cu1 * {p}cu2 * {cl}"),
            (sig, f"atan2({ss}, {cs})"),
            (sa, f"CASE WHEN {ss} = 0 THEN 0e0 ELSE {p}cu1 * {p}cu2 * {sl} / {ss} END"),
            (c2a, f"1e0 - {sa} * {sa}"),
            (c2m, f"CASE WHEN {c2a} = 0 THEN 0e0 ELSE {cs} - 2e0 * {p}su1 * {p}su2 / {c2a} END"),
            (cc, f"{f} / 16e0 * {c2a} * (4e0 + {f} * (4e0 - 3e0 * {c2a}))"),
            (f"{p}lam{i}", _cut(f"{p}l + (1e0 - {cc}) * {f} * {sa} * ({sig} + {cc} * {ss} * "
                                f"({c2m} + {cc} * {cs} * (-1e0 + 2e0 * {c2m} * {c2m})))")),
        ]
    s = f"_{iterations}"
    ss, cs, sig, c2a, c2m = f"{p}ss{s}", f"{p}cs{s}", f"{p}sig{s}", f"{p}c2a{s}", f"{p}c2m{s}"
    valid = f"coalesce({is_valid(lat1, lon1)} AND {is_valid(lat2, lon2)}, false)"
    steps += [
        (f"{p}usq", f"{c2a} * {ab2}"),
        (f"{p}ka", f"1e0 + {p}usq / 16384e0 * (4096e0 + {p}usq * (-768e0 + {p}usq * (320e0 - 175e0 * {p}usq)))"),
        (f"{p}kb", f"{p}usq / 1024e0 * (256e0 + {p}usq * (-128e0 + {p}usq * (74e0 - 47e0 * {p}usq)))"),
        (f"{p}ds", f"{p}kb * {ss} * ({c2m} + {p}kb / 4e0 * ({cs} * (-1e0 + 2e0 * {c2m} * {c2m}) - "
                   f"{p}kb / 6e0 * {c2m} * (-3e0 + 4e0 * {ss} * {ss}) * (-3e0 + 4e0 * {c2m} * {c2m})))"),
        (out, f"CASE WHEN NOT {valid} THEN NULL "
              f"WHEN abs({p}lam{iterations} - {p}lam{iterations - 1}) > {_lit(SETTLED)} OR abs({p}lam{iterations}) > pi() "
              f"THEN {far_side_km(f'{p}su1', f'{p}cu1', f'{p}su2', f'{p}cu2', f'{p}l')} "
              f"WHEN {ss} = 0 THEN 0e0 ELSE {b} * {p}ka * ({sig} - {p}ds) / 1000e0 END"),
    ]
    return steps


def is_valid(lat: str, lon: str) -> str:
    """SQL condition: degrees with |lat| <= 90 and |lon| <= 360 (NaN compares above all)."""
    return f"({lat} BETWEEN -90e0 AND 90e0 AND {lon} BETWEEN -360e0 AND 360e0)"


def _cut(value: str) -> str:
    """``value``, in a projection of its own. All steps in one generated method would be longer
    than what the JVM compiles (8,000 bytecodes) and be interpreted, at several times
    the cost; a higher-order function ends a generated stage."""
    return _let(value, "same", "same")


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def far_side_km(su1: str, cu1: str, su2: str, cu2: str, lon: str) -> str:
    """SQL expression: km between two points with the given sines and cosines of
    reduced latitude and difference of longitude in radians, within half a turn, at any distance.

    With the point farther from the equator first, and south, the difference of longitude
    that a geodesic reaches at the other point's latitude grows with its azimuth
    from 0 to half a turn, so bisecting the azimuth finds the one geodesic. Nothing divides
    by a small number, so opposite points are as good as others."""
    f, b = _lit(WGS84_F), _lit(WGS84_B)
    ab2 = _lit((WGS84_A ** 2 - WGS84_B ** 2) / WGS84_B ** 2)
    swap = f"abs({su1}) < abs({su2})"
    south = f"CASE WHEN CASE WHEN {swap} THEN {su2} ELSE {su1} END > 0e0 THEN -1e0 ELSE 1e0 END"
    # x: the pair in that order; lam in [0, pi]; a start on the equator is kept a little south of it
    pair = (f"struct(least({south} * CASE WHEN {swap} THEN {su2} ELSE {su1} END, -1e-200) AS s1, "
            f"{south} * CASE WHEN {swap} THEN {su1} ELSE {su2} END AS s2, "
            f"CASE WHEN {swap} THEN {cu2} ELSE {cu1} END AS c1, "
            f"abs({lon}) AS lam)")
    # g: arc positions of both ends on a geodesic with azimuth m, and its longitudes on the sphere
    start = ("struct(m AS m, sin(m) * x.c1 AS sa, cos(m) * x.c1 AS x1, "
             "sqrt(greatest(0e0, cos(m) * cos(m) * x.c1 * x.c1 + (x.s1 - x.s2) * (x.s1 + x.s2))) AS x2)")
    arcs = ("struct(a.m AS m, a.sa AS sa, 1e0 - a.sa * a.sa AS c2a, "
            "atan2(x.s2, a.x2) - atan2(x.s1, a.x1) AS sig, cos(atan2(x.s2, a.x2) + atan2(x.s1, a.x1)) AS c2m, "
            "atan2(a.sa * x.s2, a.x2) - atan2(a.sa * x.s1, a.x1) AS om)")
    cc = f"({f} / 16e0 * g.c2a * (4e0 + {f} * (4e0 - 3e0 * g.c2a)))"
    reached = _let(cc, "k", f"g.om - (1e0 - k) * {f} * g.sa * (g.sig + k * sin(g.sig) * "
                            "(g.c2m + k * cos(g.sig) * (-1e0 + 2e0 * g.c2m * g.c2m)))")
    geodesic = lambda azimuth, body: _let(azimuth, "m", _let(start, "a", _let(arcs, "g", body)))
    halved = geodesic("(t.lo + t.hi) / 2e0", f"CASE WHEN {reached} < x.lam THEN named_struct('lo', g.m, 'hi', t.hi) "
                                             "ELSE named_struct('lo', t.lo, 'hi', g.m) END")
    found = f"aggregate(sequence(1, {BISECTIONS}), named_struct('lo', 0e0, 'hi', pi()), (t, i) -> {halved}, t -> (t.lo + t.hi) / 2e0)"
    ka = "(1e0 + u / 16384e0 * (4096e0 + u * (-768e0 + u * (320e0 - 175e0 * u))))"
    kb = "(u / 1024e0 * (256e0 + u * (-128e0 + u * (74e0 - 47e0 * u))))"
    less = ("kb * sin(g.sig) * (g.c2m + kb / 4e0 * (cos(g.sig) * (-1e0 + 2e0 * g.c2m * g.c2m) - kb / 6e0 * g.c2m * "
            "(-3e0 + 4e0 * sin(g.sig) * sin(g.sig)) * (-3e0 + 4e0 * g.c2m * g.c2m)))")
    length = _let(f"g.c2a * {ab2}", "u", _let(kb, "kb", f"{b} * {ka} * (g.sig - {less}) / 1000e0"))
    return _let(pair, "x", geodesic(found, length))


def with_geodesic_km(df: DataFrame, lat1: str, lon1: str, lat2: str, lon2: str,
                     out: str = "distance_km",
                     iterations: int = DEFAULT_ITERATIONS) -> DataFrame:
    """Append ``out``: WGS-84 distance in km between two double lat/lon pairs.

    Column arguments are column names holding degrees as doubles.
    """
    q = lambda n: f"`{n}`"
    steps = vincenty_steps(q(lat1), q(lon1), q(lat2), q(lon2), q(out), iterations)
    for batch in _batches(steps):
        df = df.withColumns({name.strip("`"): F.expr(expr) for name, expr in batch})
    return df.drop(*[n for n, _ in steps if n.startswith(PREFIX)])


def valid_position(lat: str, lon: str) -> Column:
    """``is_valid`` of two columns; never NULL."""
    return F.coalesce(F.expr(is_valid(f"`{lat}`", f"`{lon}`")), F.lit(False))


def _batches(steps):
    """Group consecutive steps that do not read each other into one projection."""
    batch, names = [], set()
    for name, expr in steps:
        refs = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", expr))
        if refs & names:
            yield batch
            batch, names = [], set()
        batch.append((name, expr))
        names.add(name.strip("`"))
    if batch:
        yield batch


def ecef_km(lat: str | Column, lon: str | Column) -> tuple[Column, Column, Column]:
    """Earth-centred, earth-fixed x, y, z in km on the WGS-84 surface."""
    la = F.radians(F.col(lat) if isinstance(lat, str) else lat)
    lo = F.radians(F.col(lon) if isinstance(lon, str) else lon)
    n = F.lit(WGS84_A / 1000.0) / F.sqrt(F.lit(1.0) - F.lit(WGS84_E2) * F.sin(la) * F.sin(la))
    x = n * F.cos(la) * F.cos(lo)
    y = n * F.cos(la) * F.sin(lo)
    z = n * F.lit(1 - WGS84_E2) * F.sin(la)
    return x, y, z
