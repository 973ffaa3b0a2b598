"""Reference-shaped tables derived from the driver's parquet tables.

The reference reads four incident CSV parts, an income-by-ZIP table, a
reverse-geocode table and a station table.  The driver ships TPC-H-like
parquet instead; these functions derive the same shapes (all columns text,
as a header CSV scan yields) with deterministic column expressions, so the
work of every report grows with the driver tables.  ``citypulse.oracle``
holds the same derivations in DuckDB SQL; the two must stay in step.

incident parts  <- orders (+ events for time and premise)
geocode         <- customer
income          <- nation, region, supplier
stations        <- supplier
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import DESCENT_LABELS
from ..functions.lenient import INCIDENT_TS_FORMAT
from .derived import DerivedTables

# Fixed values of the derivation (shared with citypulse.oracle).
N_PARTS = 4
EXTRA_DUP_MOD = 100          # keys divisible by this are also in the last part
BAD_DATE_MOD = 211           # keys divisible by this get an unparsable date
BAD_AGE_MOD = 53             # keys divisible by this get a non-numeric age
NULL_DESCENT_MOD = 37        # keys divisible by this get no descent code
ZERO_COORD_MOD = 97          # customers divisible by this sit at '0', '0'
NULL_ZIP_MOD = 89            # customers divisible by this have no ZIP
TIED_STATION_MOD = 50        # stations with key % 50 == 49 share the previous position
WEAPON_BASE, WEAPON_MOD = 90, 120
ZERO_GEOCODES = 4            # of those, so many have '0', '0' in the geocode table too
# Queries over shared positions: a position is that of all customers whose keys end in the same
# three digits, and every customer at '0', '0' is there in the geocode table too.
SHARED_POSITIONS: tuple[str, ...] = (
    "income_extremes_sql",
    "income_extremes_auto",
    "income_extremes_broadcast",
    "income_extremes_merge",
    "join_hint_merge",
    "income_extremes_merge_small",
    "income_extremes_shuffle_hash",
    "join_hint_shuffle_hash",
    "income_extremes_replicate_nl",
    "join_hint_replicate_nl",
    "income_extremes_sql_broadcast",
    "income_extremes_sql_merge",
    "income_extremes_sql_merge_small",
    "income_extremes_sql_shuffle_hash",
    "income_extremes_sql_replicate_nl",
    "join_scoped_threshold",
    "join_composite_key",
)
DESCENT_CODES = "".join(code for code, _ in DESCENT_LABELS) + "Q"   # the listed codes and one unlisted
STREET_EVENT = "view"        # event type that becomes premise 'STREET'
COMMUNITY_PATTERN = "%A (%"  # regions ending in A: AFRICA, AMERICA, ASIA
INCIDENT_COLUMNS = ("DR_NO", "Date Rptd", "DATE OCC", "TIME OCC", "AREA ",
                    "Premis Desc", "Vict Age", "Vict Descent",
                    "Weapon Used Cd", "LAT", "LON")
# the last part spells one header differently, as the reference's data does
LAST_PART_COLUMNS = tuple("Date OCC" if c == "DATE OCC" else c for c in INCIDENT_COLUMNS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _fixed(x: Column, decimals: int = 6) -> Column:
    return F.format_string(f"%.{decimals}f", x)


def _shuffled(key: Column, factor: int, thousands: int) -> Column:
    """0 to 999,999: the last three digits of the key, mixed, and three higher ones."""
    return (key * factor % 1000) * 1000 + F.floor(key / thousands) % 1000


def customer_lat(key: Column) -> Column:
    return F.lit(33.7) + _shuffled(key, 7919, 1_000_000) / 1500000.0


def customer_lon(key: Column) -> Column:
    """With the latitude, one position per customer up to a thousand million of them."""
    return F.lit(-118.6) + _shuffled(key, 104729, 1000) / 1600000.0


def _position_text(key: Column, zero: Column, shared: bool = False) -> tuple[Column, Column]:
    if shared:
        lat, lon = F.lit(33.7) + key * 7919 % 1000 / 1500.0, F.lit(-118.6) + key * 104729 % 1000 / 1600.0
        return tuple(F.when(zero, F.lit("0")).otherwise(_fixed(x)) for x in (lat, lon))
    lat = F.when(zero, F.lit("0")).otherwise(_fixed(customer_lat(key), 9))
    lon = F.when(zero, F.lit("0")).otherwise(_fixed(customer_lon(key), 9))
    return lat, lon


def incident_rows(spark: SparkSession, sf_dir: str, shared: bool = False) -> DataFrame:
    """All incident rows (text columns) plus the source key ``__k``; ``shared``: see ``SHARED_POSITIONS``."""
    orders = table(spark, sf_dir, "orders")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    n_areas = table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    date_text = F.date_format("o_orderdate", INCIDENT_TS_FORMAT)
    lat, lon = _position_text(c, c % ZERO_COORD_MOD == 0, shared)
    joined = orders.join(events, orders.o_orderkey == events.event_id, "left")
    return joined.select(
        k.alias("__k"),
        k.cast("string").alias("DR_NO"),
        date_text.alias("Date Rptd"),
        F.when(k % BAD_DATE_MOD == 0, F.lit("not a date")).otherwise(date_text).alias("DATE OCC"),
        F.date_format("ts", "HHmm").alias("TIME OCC"),
        (c % n_areas).cast("string").alias("AREA "),
        F.when(F.col("event_type") == STREET_EVENT, F.lit("STREET"))
         .otherwise(F.upper("event_type")).alias("Premis Desc"),
        F.when(k % BAD_AGE_MOD == 0, F.lit("x"))
         .otherwise((F.lit(18) + c % 70).cast("string")).alias("Vict Age"),
        F.when(k % NULL_DESCENT_MOD == 0, F.lit(None).cast("string"))
         .otherwise(F.substring(F.lit(DESCENT_CODES), (k % 20 + 1).cast("int"), 1)).alias("Vict Descent"),
        (F.lit(WEAPON_BASE) + k % WEAPON_MOD).cast("string").alias("Weapon Used Cd"),
        lat.alias("LAT"),
        lon.alias("LON"),
    )


def incident_table(spark: SparkSession, sf_dir: str, shared: bool = False) -> DataFrame:
    """All rows with the number of their part; some are in the last part too."""
    rows = incident_rows(spark, sf_dir, shared)
    k = F.col("__k")
    own = F.coalesce(F.pmod(k, F.lit(N_PARTS)), F.lit(0)).cast("int")  # every row is in a part
    last = F.lit(N_PARTS - 1)
    parts = F.when((k % EXTRA_DUP_MOD == 0) & (own != last), F.array(own, last)).otherwise(F.array(own))
    return rows.select(*[F.col(f"`{c}`") for c in INCIDENT_COLUMNS], F.explode(parts).alias("part"))


def incident_parts(spark: SparkSession, sf_dir: str, shared: bool = False) -> list[DataFrame]:
    """Four header-CSV-shaped parts; the last one repeats some rows of the first.

    Derived by one scan of ``orders`` and ``events`` per application (``sources.derived``)."""
    names = [os.path.join(sf_dir, f"{t}.parquet") for t in ("orders", "events", "supplier")]
    name = "incidents-shared" if shared else "incidents"
    rows = DerivedTables.of(spark).table(spark, name, names, lambda: incident_table(spark, sf_dir, shared), ["part"])
    return [rows.where(F.col("part") == i).drop("part").toDF(*(LAST_PART_COLUMNS if i == N_PARTS - 1 else INCIDENT_COLUMNS))
            for i in range(N_PARTS)]


def geocode(spark: SparkSession, sf_dir: str, shared: bool = False) -> DataFrame:
    """Reverse geocode: position text -> ZIP+suffix text (one row per customer)."""
    cust = table(spark, sf_dir, "customer")
    c = F.col("c_custkey")
    zero = c % ZERO_COORD_MOD == 0
    lat, lon = _position_text(c, zero if shared else zero & (c <= ZERO_COORD_MOD * ZERO_GEOCODES), shared)
    zipc = F.concat(F.lit("9"), F.lpad(F.col("c_nationkey").cast("string"), 4, "0"),
                    F.lit("-"), c.cast("string"))
    return cust.select(
        lat.alias("LAT"), lon.alias("LON"),
        F.when(c % NULL_ZIP_MOD == 0, F.lit(None).cast("string")).otherwise(zipc).alias("ZIPcode"),
    )


def income(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Income by ZIP: community ``REGION (NATION)``, money text ``$12,345``."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    supp = (table(spark, sf_dir, "supplier")
            .groupBy("s_nationkey")
            .agg(F.sum(F.round(F.col("s_acctbal") * 100).cast("bigint")).alias("cents"),
                 F.count(F.lit(1)).alias("n")))
    dollars = F.floor(F.col("cents") / (F.col("n") * 100.0)).cast("bigint")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .join(supp, nation.n_nationkey == supp.s_nationkey, "left")
            .select(
                F.concat(F.lit("9"), F.lpad(F.col("n_nationkey").cast("string"), 4, "0")).alias("Zip Code"),
                F.concat(F.col("r_name"), F.lit(" ("), F.col("n_name"), F.lit(")")).alias("Community"),
                F.concat(F.lit("$"), F.format_number(dollars, 0)).alias("Estimated Median Income"),
            ))


def station_lat(key: Column) -> Column:
    return F.lit(33.7) + (key * 6101 % 997) / 1500.0


def station_lon(key: Column) -> Column:
    return F.lit(-118.6) + (key * 3571 % 991) / 1600.0


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations: X = longitude text, Y = latitude text, FID, DIVISION.

    Every 50th station shares its predecessor's position (a distance tie).
    """
    s = F.col("s_suppkey")
    pos = F.when(s % TIED_STATION_MOD == TIED_STATION_MOD - 1, s - 1).otherwise(s)
    return table(spark, sf_dir, "supplier").select(
        _fixed(station_lon(pos)).alias("X"),
        _fixed(station_lat(pos)).alias("Y"),
        s.cast("string").alias("FID"),
        F.col("s_name").alias("DIVISION"),
    )
