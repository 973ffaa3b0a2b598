"""DuckDB twins of the registered queries (the correctness oracle).

``PRELUDE`` derives the reference-shaped tables from the driver's views
exactly as ``citypulse.sources.tables`` does in Spark; each query text is
``WITH <prelude>, <its own CTEs> SELECT ...``.  Notes that keep the two
engines equal: integer results of ``year``/``month``/``row_number`` are
cast to INTEGER, Spark's NULL order is spelled out (ASC NULLS FIRST,
DESC NULLS LAST), every ORDER BY that feeds a LIMIT or a row number ends in
a unique key, and averages are rounded to 4 decimals.
"""

from __future__ import annotations

from .sources import tables as T

_POS = """CASE WHEN {zero} THEN '0' ELSE printf('%.9f', {base}e0 + ((({k} * {mul}) % 1000) * 1000 + ({k} // {thousands}) % 1000) / {div}e0) END"""


def _pos(k: str, axis: str, zero: str = "") -> str:
    base, mul, thousands, div = {"lat": ("33.7", 7919, 1_000_000, 1500000), "lon": ("-118.6", 104729, 1000, 1600000)}[axis]
    return _POS.format(k=k, zero=f"{k} % {T.ZERO_COORD_MOD} = 0{zero}", base=base, mul=mul, thousands=thousands, div=div)


_SHARED_POS = """CASE WHEN {k} % {z} = 0 THEN '0' ELSE printf('%.6f', {base}e0 + (({k} * {mul}) % {mod}) / {div}e0) END"""


def _shared_pos(k: str, axis: str) -> str:
    base, mul, mod, div = {"lat": ("33.7", 7919, 1000, 1500), "lon": ("-118.6", 104729, 1000, 1600)}[axis]
    return _SHARED_POS.format(k=k, z=T.ZERO_COORD_MOD, base=base, mul=mul, mod=mod, div=div)


_FEW = f" AND c_custkey <= {T.ZERO_COORD_MOD * T.ZERO_GEOCODES}"


def _station_pos(k: str, base: str, mul: int, mod: int, div: int) -> str:
    return f"printf('%.6f', {base}e0 + (({k} * {mul}) % {mod}) / {div}e0)"


_DATE = "strftime(o.o_orderdate, '%m/%d/%Y %I:%M:%S %p')"


def _prelude(shared: bool = False) -> str:
    pos, few = (lambda k, axis, _="": _shared_pos(k, axis), "") if shared else (_pos, _FEW)
    return f"""
cp_rows AS (
  SELECT o.o_orderkey AS k,
    CAST(o.o_orderkey AS VARCHAR) AS "DR_NO",
    {_DATE} AS "Date Rptd",
    CASE WHEN o.o_orderkey % {T.BAD_DATE_MOD} = 0 THEN 'not a date' ELSE {_DATE} END AS "DATE OCC",
    strftime(e.ts, '%H%M') AS "TIME OCC",
    CAST(o.o_custkey % (SELECT count(*) FROM supplier) AS VARCHAR) AS "AREA",
    CASE WHEN e.event_type = '{T.STREET_EVENT}' THEN 'STREET' ELSE upper(e.event_type) END AS "Premis Desc",
    CASE WHEN o.o_orderkey % {T.BAD_AGE_MOD} = 0 THEN 'x' ELSE CAST(18 + o.o_custkey % 70 AS VARCHAR) END AS "Vict Age",
    CASE WHEN o.o_orderkey % {T.NULL_DESCENT_MOD} = 0 THEN NULL
         ELSE substring('{T.DESCENT_CODES}', CAST(o.o_orderkey % 20 + 1 AS INTEGER), 1) END AS "Vict Descent",
    CAST({T.WEAPON_BASE} + o.o_orderkey % {T.WEAPON_MOD} AS VARCHAR) AS "Weapon Used Cd",
    {pos('o.o_custkey', 'lat')} AS "LAT",
    {pos('o.o_custkey', 'lon')} AS "LON"
  FROM orders o LEFT JOIN events e ON e.event_id = o.o_orderkey
),
cp_parts AS (
  SELECT * FROM cp_rows
  UNION ALL
  SELECT * FROM cp_rows WHERE k % {T.EXTRA_DUP_MOD} = 0
),
cp_all AS (
  SELECT "DR_NO", "Date Rptd", "DATE OCC", "TIME OCC", "AREA", "Premis Desc", "Vict Age",
         "Vict Descent", "Weapon Used Cd", "LAT", "LON" FROM cp_parts
),
cp_inc AS (SELECT DISTINCT * FROM cp_all),
cp_geo AS (
  SELECT {pos('c_custkey', 'lat', few)} AS "LAT",
         {pos('c_custkey', 'lon', few)} AS "LON",
         CASE WHEN c_custkey % {T.NULL_ZIP_MOD} = 0 THEN NULL
              ELSE '9' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') || '-' || CAST(c_custkey AS VARCHAR) END AS "ZIPcode"
  FROM customer
),
cp_supp AS (
  SELECT s_nationkey, CAST(sum(CAST(round(s_acctbal * 100) AS BIGINT)) AS BIGINT) AS cents, count(*) AS n
  FROM supplier GROUP BY s_nationkey
),
cp_income AS (
  SELECT '9' || lpad(CAST(n.n_nationkey AS VARCHAR), 4, '0') AS "Zip Code",
         r.r_name || ' (' || n.n_name || ')' AS "Community",
         '$' || format('{{:,}}', CAST(floor(s.cents / (s.n * 100e0)) AS BIGINT)) AS "Estimated Median Income"
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN cp_supp s ON n.n_nationkey = s.s_nationkey
),
cp_stations AS (
  SELECT {_station_pos('p', '-118.6', 3571, 991, 1600)} AS "X",
         {_station_pos('p', '33.7', 6101, 997, 1500)} AS "Y",
         CAST(s_suppkey AS VARCHAR) AS "FID", s_name AS "DIVISION", s_suppkey AS seq
  FROM (SELECT *, CASE WHEN s_suppkey % {T.TIED_STATION_MOD} = {T.TIED_STATION_MOD - 1}
                       THEN s_suppkey - 1 ELSE s_suppkey END AS p FROM supplier)
)"""


PRELUDE = _prelude()
SHARED_PRELUDE = _prelude(shared=True)   # for the queries in ``sources.tables.SHARED_POSITIONS``


class OracleSQL(str):
    """Query text that also remembers its own CTEs and final SELECT, so the
    same logic can run over other base tables (the hand-made test tables)."""

    body: str
    select: str

    def over(self, base_ctes: str) -> str:
        ctes = base_ctes + ("," + self.body if self.body.strip() else "")
        return f"WITH {ctes}\n{self.select}"


def with_prelude(body_ctes: str, select: str, prelude: str = PRELUDE) -> OracleSQL:
    ctes = prelude + ("," + body_ctes if body_ctes.strip() else "")
    out = OracleSQL(f"WITH {ctes}\n{select}")
    out.body, out.select = body_ctes, select
    return out


def geodesic_ctes(source: str, lat1: str, lon1: str, lat2: str, lon2: str,
                  out: str, name: str, rounds: int = 12) -> tuple[str, str]:
    """A chain of CTEs appending ``out`` (km) to ``source``; returns (ctes, last name).

    Written apart from the Spark steps: unit vectors of the auxiliary sphere, the longitude
    iterated more often, and the length by Helmert's expansion parameter."""
    f, a = "(1e0 / 298.257223563e0)", "6378137e0"
    b = f"({a} * (1e0 - {f}))"
    ok = " AND ".join(f"abs({x}) <= {most}" for x, most in ((lat1, 90), (lat2, 90), (lon1, 360), (lon2, 360)))
    good = f"CASE WHEN {ok} THEN {{}} END"  # NaN compares above all
    reduced = lambda lat: good.format(f"atan((1e0 - {f}) * tan(radians({lat})))")
    ctes = [f"""{name}_0 AS MATERIALIZED (SELECT *, {reduced(lat1)} AS gu1, {reduced(lat2)} AS gu2,
  {good.format(f"radians({lon2} - {lon1})")} AS gl FROM {source})""",
            f"{name}_s0 AS MATERIALIZED (SELECT *, gl AS glam FROM {name}_0)"]
    for i in range(rounds):
        last = i == rounds - 1
        ctes.append(f"""{name}_v{i} AS MATERIALIZED (SELECT *,
  cos(gu2) * sin(glam) AS gy, cos(gu1) * sin(gu2) - sin(gu1) * cos(gu2) * cos(glam) AS gz,
  sin(gu1) * sin(gu2) + cos(gu1) * cos(gu2) * cos(glam) AS gx FROM {name}_s{i})""")
        ctes.append(f"""{name}_a{i} AS MATERIALIZED (SELECT *, atan2(hypot(gy, gz), gx) AS gsig,
  CASE WHEN hypot(gy, gz) = 0 THEN 0e0 ELSE cos(gu1) * gy / hypot(gy, gz) END AS gsa FROM (
  SELECT *, sqrt(gy * gy + gz * gz) AS gss FROM {name}_v{i}))""".replace("hypot(gy, gz)", "gss"))
        ctes.append(f"""{name}_m{i} AS MATERIALIZED (SELECT *, CASE WHEN 1e0 - gsa * gsa < 1e-18 THEN 0e0
  ELSE cos(gsig) - 2e0 * sin(gu1) * sin(gu2) / (1e0 - gsa * gsa) END AS gm, {f} / 16e0 * (1e0 - gsa * gsa)
  * (4e0 + {f} * (1e0 + 3e0 * gsa * gsa)) AS gc FROM {name}_a{i})""")
        if not last:
            drop = "glam, gy, gz, gx, gss, gsig, gsa, gm, gc"
            ctes.append(f"""{name}_s{i + 1} AS MATERIALIZED (SELECT * EXCLUDE ({drop}), gl + (1e0 - gc) * {f} * gsa
  * (gsig + gc * sin(gsig) * (gm + gc * cos(gsig) * (2e0 * gm * gm - 1e0))) AS glam FROM {name}_m{i})""")
    root = f"sqrt(1e0 + (1e0 - gsa * gsa) * ({a} * {a} / ({b} * {b}) - 1e0))"
    ctes.append(f"{name}_k AS MATERIALIZED (SELECT *, ({root} - 1e0) / ({root} + 1e0) AS gk FROM {name}_m{rounds - 1})")
    kb = "(gk * (1e0 - 0.375e0 * gk * gk))"
    ctes.append(f"""{name}_d AS MATERIALIZED (SELECT *, CASE WHEN gss = 0 AND gx > 0 THEN 0e0 ELSE {b} / 1000e0 * (1e0 + gk * gk / 4e0)
  / (1e0 - gk) * (gsig - {kb} * sin(gsig) * (gm + {kb} / 4e0 * (cos(gsig) * (2e0 * gm * gm - 1e0)
  - {kb} / 6e0 * gm * (4e0 * sin(gsig) * sin(gsig) - 3e0) * (4e0 * gm * gm - 3e0)))) END AS {out} FROM {name}_k)""")
    return ",\n".join(ctes), f"{name}_d"


_TS = "try_strptime({c}, '%m/%d/%Y %I:%M:%S %p')"


def _year(c: str) -> str:
    return f"CAST(year({_TS.format(c=c)}) AS INTEGER)"


def _month(c: str) -> str:
    return f"CAST(month({_TS.format(c=c)}) AS INTEGER)"


def _top_months(count_name: str, rank_name: str) -> str:
    return with_prelude(f"""
w1_ym AS (SELECT {_year('"DATE OCC"')} AS "Year", {_month('"DATE OCC"')} AS "Month" FROM cp_inc),
w1_cnt AS (SELECT "Year", "Month", count(*) AS c FROM w1_ym GROUP BY "Year", "Month"),
w1_rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY "Year" ORDER BY c DESC, "Month") AS INTEGER) AS r
          FROM w1_cnt)""", f"""
SELECT "Year", "Month", c AS "{count_name}", r AS "{rank_name}" FROM w1_rk
WHERE r <= 3 AND "Year" IS NOT NULL""")


SQL: dict[str, str] = {}
SQL["top_months_df"] = _top_months("Total Crimes", "#")
SQL["top_months_sql"] = _top_months("Total_Crimes", "Rank")


# ---------------------------------------------------------------- W2 day parts
def _labels_sql(c: str, labels, by: str) -> str:
    from .functions import dayparts as D
    m, a, e, n, u = labels
    if by == "hour":
        h = f"TRY_CAST(substring({c}, 1, 2) AS INTEGER)"
        return (f"CASE WHEN {h} BETWEEN {D.MORNING_HOURS[0]} AND {D.MORNING_HOURS[1]} THEN '{m}' "
                f"WHEN {h} BETWEEN {D.AFTERNOON_HOURS[0]} AND {D.AFTERNOON_HOURS[1]} THEN '{a}' "
                f"WHEN {h} BETWEEN {D.EVENING_HOURS[0]} AND {D.EVENING_HOURS[1]} THEN '{e}' "
                f"WHEN {h} >= {D.NIGHT_FROM} OR {h} <= {D.NIGHT_TO} THEN '{n}' ELSE '{u}' END")
    return (f"CASE WHEN {c} >= '{D.MORNING_TEXT[0]}' AND {c} <= '{D.MORNING_TEXT[1]}' THEN '{m}' "
            f"WHEN {c} >= '{D.AFTERNOON_TEXT[0]}' AND {c} <= '{D.AFTERNOON_TEXT[1]}' THEN '{a}' "
            f"WHEN {c} >= '{D.EVENING_TEXT[0]}' AND {c} <= '{D.EVENING_TEXT[1]}' THEN '{e}' "
            f"WHEN {c} >= '{D.NIGHT_TEXT_FROM}' OR {c} <= '{D.NIGHT_TEXT_TO}' THEN '{n}' ELSE '{u}' END")


def _day_parts(label_col: str, count_col: str, labels, by: str) -> str:
    return with_prelude(f"""
w2_street AS (SELECT * FROM cp_inc WHERE "Premis Desc" = 'STREET')""", f"""
SELECT {_labels_sql('"TIME OCC"', labels, by)} AS "{label_col}", count(*) AS "{count_col}"
FROM w2_street GROUP BY 1""")


def _register_w2():
    from .functions import dayparts as D
    SQL["day_parts_df"] = _day_parts("TIME_OF_THE_DAY", "count", D.GREEKLISH, "text")
    SQL["day_parts_sql"] = _day_parts("time_periods", "countPeriods", D.GREEK, "hour")
    SQL["day_parts_rows"] = _day_parts("time_period", "count", D.GREEK, "hour")
    SQL["sort_by_time_code"] = with_prelude("", f"""
SELECT *, {_labels_sql('"TIME OCC"', D.GREEK, 'hour')} AS time_period
FROM cp_inc WHERE "Premis Desc" = 'STREET'""")


_register_w2()


# ------------------------------------------------------------ W3 income extremes
def _income_extremes(community_like: str, k: int = 3) -> str:
    from .functions.labels import DESCENT_LABELS
    cases = " ".join(f"WHEN cz.descent = '{c}' THEN '{lab}'" for c, lab in DESCENT_LABELS)
    tie = '"Zip Code", "Community", "Estimated Median Income"'
    return with_prelude(f"""
w3_cz AS (
  SELECT substring(g."ZIPcode", 1, 5) AS zip_code, count(*) AS total, c."Vict Descent" AS descent
  FROM cp_inc c JOIN cp_geo g ON g."LAT" = c."LAT" AND g."LON" = c."LON"
  WHERE c."Vict Descent" IS NOT NULL AND g."ZIPcode" IS NOT NULL
  GROUP BY substring(g."ZIPcode", 1, 5), c."Vict Descent"),
w3_inc AS (
  SELECT *, TRY_CAST(substring(regexp_replace("Estimated Median Income", ',', '', 'g'), 2) AS FLOAT) AS f
  FROM cp_income WHERE "Community" LIKE '{community_like}'),
w3_top AS (SELECT * FROM w3_inc ORDER BY f DESC NULLS LAST, {tie} LIMIT {k}),
w3_low AS (SELECT * FROM w3_inc ORDER BY f ASC NULLS FIRST, {tie} LIMIT {k}),
w3_t AS (SELECT * FROM w3_top UNION ALL SELECT * FROM w3_low)""", f"""
SELECT t."Zip Code", cz.total AS "#", cz.descent AS "Vict Descent",
       CASE {cases} ELSE cz.descent END AS victim_category
FROM w3_t t JOIN w3_cz cz ON cz.zip_code = t."Zip Code\"""")


def _register_w3():
    q = _income_extremes(T.COMMUNITY_PATTERN)
    for name in ("income_extremes_sql", "income_extremes_auto", "income_extremes_broadcast",
                 "income_extremes_merge", "income_extremes_merge_small",
                 "income_extremes_shuffle_hash", "income_extremes_replicate_nl",
                 "join_hint_broadcast", "join_hint_merge", "join_hint_merge_small",
                 "join_hint_shuffle_hash", "join_hint_replicate_nl", "join_scoped_threshold", "join_scoped_threshold_sql",
                 "income_extremes_sql_broadcast", "income_extremes_sql_merge",
                 "income_extremes_sql_merge_small", "income_extremes_sql_shuffle_hash",
                 "income_extremes_sql_replicate_nl"):
        SQL[name] = q


_register_w3()


# ------------------------------------------------------------ W4 station distance
_W4_INC = """
w4_inc AS (
  SELECT DISTINCT * FROM cp_all
  WHERE TRY_CAST("Weapon Used Cd" AS INTEGER) >= 100 AND TRY_CAST("Weapon Used Cd" AS INTEGER) < 200
    AND "LAT" != '0' AND "LON" != '0')"""


def _report(source: str, by: str) -> str:
    if by == "year":
        return (f"SELECT year, round(avg(distance), 4) AS average_distance, count(*) AS count "
                f"FROM {source} GROUP BY year")
    return (f"SELECT \"DIVISION\" AS division, round(avg(distance), 4) AS average_distance, "
            f"count(*) AS count FROM {source} GROUP BY \"DIVISION\"")


def _own_station(by: str) -> str:
    chain, last = geodesic_ctes("w4_j", "lat1", "lon1", "lat2", "lon2", "distance", "w4_v")
    return with_prelude(_W4_INC + f""",
w4_j AS (
  SELECT {_year('c."DATE OCC"')} AS year, s."DIVISION",
         TRY_CAST(c."LAT" AS DOUBLE) AS lat1, TRY_CAST(c."LON" AS DOUBLE) AS lon1,
         TRY_CAST(s."Y" AS DOUBLE) AS lat2, TRY_CAST(s."X" AS DOUBLE) AS lon2
  FROM w4_inc c JOIN cp_stations s ON s."FID" = c."AREA"),
{chain}""", _report(last, by))


def _nearest_station(by: str) -> str:
    chain, last = geodesic_ctes("w4_pairs", "lat1", "lon1", "lat2", "lon2", "d", "w4_v")
    return with_prelude(_W4_INC + f""",
w4_pts AS (
  SELECT DISTINCT "LAT", "LON", TRY_CAST("LAT" AS DOUBLE) AS lat1, TRY_CAST("LON" AS DOUBLE) AS lon1
  FROM w4_inc),
w4_pairs AS (
  SELECT p."LAT", p."LON", p.lat1, p.lon1, TRY_CAST(s."Y" AS DOUBLE) AS lat2,
         TRY_CAST(s."X" AS DOUBLE) AS lon2, s."DIVISION", s.seq
  FROM w4_pts p CROSS JOIN cp_stations s
  WHERE p.lat1 IS NOT NULL AND p.lon1 IS NOT NULL),
{chain},
w4_best AS (
  SELECT "LAT", "LON", d, "DIVISION" FROM (
    SELECT *, row_number() OVER (PARTITION BY "LAT", "LON" ORDER BY d, seq) AS r FROM {last})
  WHERE r = 1),
w4_rows AS (
  SELECT {_year('c."DATE OCC"')} AS year, b."DIVISION", b.d AS distance
  FROM w4_inc c LEFT JOIN w4_best b ON b."LAT" = c."LAT" AND b."LON" = c."LON")""",
        _report("w4_rows", by))


def _register_w4():
    for by in ("year", "division"):
        SQL[f"own_dist_by_{by}"] = _own_station(by)
        SQL[f"nearest_by_{by}"] = SQL[f"nearest_sql_by_{by}"] = _nearest_station(by)
    for s in ("broadcast", "merge", "shuffle_hash", "replicate_nl"):
        SQL[f"own_dist_{s}"] = SQL["own_dist_by_division"]
        SQL[f"own_dist_sql_{s}"] = SQL["own_dist_by_division"]


_register_w4()


# ------------------------------------------------------------ single operators
_TEXT = ('"DR_NO", "Date Rptd", "DATE OCC", "TIME OCC", "AREA", "Premis Desc", "Vict Age", '
         '"Vict Descent", "Weapon Used Cd", "LAT", "LON"')


def _typed_cols(ts: str = "TIMESTAMP") -> str:
    return (f'"DR_NO", {_TS.format(c=chr(34) + "Date Rptd" + chr(34))} AS "Date Rptd", '
            f'{_TS.format(c=chr(34) + "DATE OCC" + chr(34))} AS "DATE OCC", "TIME OCC", "AREA", '
            f'"Premis Desc", TRY_CAST("Vict Age" AS INTEGER) AS "Vict Age", "Vict Descent", '
            '"Weapon Used Cd", TRY_CAST("LAT" AS DOUBLE) AS "LAT", TRY_CAST("LON" AS DOUBLE) AS "LON"')


def _register_single():
    from .functions.labels import DESCENT_LABELS
    p = with_prelude
    SQL["scan_csv_header"] = p("", f"SELECT {_TEXT} FROM cp_all")
    SQL["scan_csv_typed"] = p("", f"SELECT {_typed_cols()} FROM cp_all"
                              ).replace('"Weapon Used Cd", TRY_CAST("LAT"',
                                        'TRY_CAST("Weapon Used Cd" AS INTEGER) AS "Weapon Used Cd", TRY_CAST("LAT"')
    SQL["union_parts"] = p("", "SELECT * FROM cp_all")
    SQL["union_distinct"] = p("", "SELECT * FROM cp_inc")
    SQL["dedup_rows"] = SQL["dedup_few_copies"] = p("", "SELECT * FROM cp_inc")
    SQL["select_star"] = p("", "SELECT * FROM cp_inc")
    SQL["union_filtered_parts"] = p("", "SELECT * FROM cp_inc WHERE \"Premis Desc\" = 'STREET'")
    SQL["filter_equality"] = SQL["union_filtered_parts"]
    SQL["typed_ingest"] = p("", f"SELECT {_typed_cols()} FROM cp_inc")
    SQL["row_count"] = p("", "SELECT count(*) AS row_count FROM cp_inc")
    SQL["project_columns"] = p("", 'SELECT "DR_NO", "DATE OCC" FROM cp_inc')
    SQL["rename_columns"] = p("", 'SELECT "DR_NO" AS "#", "AREA" AS "Area Code", '
                                  '"Premis Desc" AS "Total Crimes" FROM cp_inc')
    w = 'TRY_CAST("Weapon Used Cd" AS INTEGER)'
    SQL["filter_code_range"] = p("", f"SELECT * FROM cp_inc WHERE {w} >= 100 AND {w} < 200")
    SQL["filter_nonzero_coords"] = p("", "SELECT * FROM cp_inc WHERE \"LAT\" != '0' AND \"LON\" != '0'")
    SQL["filter_not_null"] = p("", f"SELECT * FROM cp_inc WHERE {_TS.format(c=chr(34) + 'DATE OCC' + chr(34))} IS NOT NULL")
    SQL["filter_like"] = p("", f"SELECT * FROM cp_income WHERE \"Community\" LIKE '{T.COMMUNITY_PATTERN}'")
    SQL["join_single_key"] = p(_W4_INC, 'SELECT c."DR_NO", c."DATE OCC", c."LAT", c."LON", s."X", s."Y", '
                                        's."DIVISION" FROM w4_inc c JOIN cp_stations s ON s."FID" = c."AREA"')
    SQL["join_composite_key"] = p("", 'SELECT c."DR_NO", c."Vict Descent", g."ZIPcode" FROM cp_inc c '
                                      'JOIN cp_geo g ON g."LAT" = c."LAT" AND g."LON" = c."LON" '
                                      'WHERE c."Vict Descent" IS NOT NULL AND g."ZIPcode" IS NOT NULL')
    SQL["group_count"] = p("", 'SELECT "AREA", "Vict Descent", count(*) AS count FROM cp_inc '
                               'GROUP BY "AREA", "Vict Descent"')
    SQL["group_by_alias"] = p("", 'SELECT substring("ZIPcode", 1, 5) AS zip_code, count(*) AS n '
                                  'FROM cp_geo GROUP BY zip_code')
    SQL["limit_rows"] = p("", f'SELECT {_typed_cols()} FROM cp_inc ORDER BY "DR_NO" LIMIT 50')
    occ = _TS.format(c='"DATE OCC"')
    SQL["parse_timestamp"] = p("", f'SELECT "DR_NO", {occ} AS occurred FROM cp_inc')
    SQL["date_parts"] = p("", f'SELECT "DR_NO", {_year(chr(34) + "DATE OCC" + chr(34))} AS "Year", '
                              f'{_month(chr(34) + "DATE OCC" + chr(34))} AS "Month" FROM cp_inc')
    SQL["cast_lenient"] = p("", f'SELECT "DR_NO", TRY_CAST("Vict Age" AS INTEGER) AS age, {w} AS weapon, '
                                'TRY_CAST("LAT" AS DOUBLE) AS lat, TRY_CAST("LON" AS DOUBLE) AS lon FROM cp_inc')
    SQL["parse_money"] = p("", 'SELECT "Zip Code", TRY_CAST(substring(regexp_replace('
                               '"Estimated Median Income", \',\', \'\', \'g\'), 2) AS FLOAT) AS income '
                               'FROM cp_income')
    SQL["zip_prefix"] = p("", 'SELECT "ZIPcode", substring("ZIPcode", 1, 5) AS zip_code FROM cp_geo')
    cases = " ".join(f"WHEN \"Vict Descent\" = '{c}' THEN '{lab}'" for c, lab in DESCENT_LABELS)
    SQL["decode_labels"] = p("", f'SELECT "DR_NO", "Vict Descent", CASE {cases} ELSE "Vict Descent" END '
                                 'AS victim_category FROM cp_inc')
    chain, last = geodesic_ctes("w4_j", "lat1", "lon1", "lat2", "lon2", "distance", "w4_v")
    SQL["geodesic_distance"] = p(_W4_INC + f""",
w4_j AS (
  SELECT c."DR_NO", TRY_CAST(c."LAT" AS DOUBLE) AS lat1, TRY_CAST(c."LON" AS DOUBLE) AS lon1,
         TRY_CAST(s."Y" AS DOUBLE) AS lat2, TRY_CAST(s."X" AS DOUBLE) AS lon2
  FROM w4_inc c JOIN cp_stations s ON s."FID" = c."AREA"),
{chain}""", f'SELECT "DR_NO", round(distance, 4) AS distance FROM {last}')
    near = _nearest_station("year")
    head, _ = near.rsplit(",\nw4_rows AS", 1)
    SQL["nearest_station"] = head + '\nSELECT "LAT", "LON", round(d, 4) AS distance, "DIVISION" FROM w4_best'
    inc_t = _income_extremes(T.COMMUNITY_PATTERN)
    head, _ = inc_t.rsplit("\nSELECT t.", 1)
    SQL["top_bottom_k"] = (head + '\nSELECT "Zip Code", "Community", "Estimated Median Income", '
                           'f AS estimated_median_income_float FROM w3_t')


_register_single()
for _name in T.SHARED_POSITIONS:
    SQL[_name] = with_prelude(SQL[_name].body, SQL[_name].select, SHARED_PRELUDE)
