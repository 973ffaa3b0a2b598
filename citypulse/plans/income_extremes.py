"""W3: victim-descent counts in the highest- and lowest-income areas.

Reference semantics: incidents (UNION of the parts) joined to the reverse
geocode on text (LAT, LON), counted per (ZIP5, descent); the 3 richest and
3 poorest matching communities (UNION ALL, so an area can appear twice);
their counts with the decoded descent label.

Plan (same rows, less data moved):
1. incidents are de-duplicated, then pre-aggregated to (LAT, LON, descent)
   counts, and geocode rows to (LAT, LON, ZIP5) counts, so a hot position
   crosses the shuffle once per task and the join sums count products
   instead of multiplying rows;
2. the top/bottom set (at most 2k rows by its LIMITs) becomes a semi-join
   filter, broadcast where granted, on the geocode, so only geocode rows of the
   chosen ZIPs reach the big join;
3. the two joins take the selected strategy (Catalyst's choice by default);
4. the descent label is a literal-map lookup, not a join.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lenient as L
from ..functions.labels import DESCENT_LABELS, decode
from ..operators.joins import granted, strategy_join
from ..operators.rows import q, top_bottom_k
from ..sources.csv import trim_names
from .incidents import distinct_incidents
from .top_months import distinct_sql, number_key_sql, register_parts

# Fixed value: the reference's community filter.
COMMUNITY_LIKE = "%Los Angeles (%"
K = 3

# Hint placement per variant: (side of the geocode join, side of the
# top/bottom join) - "right" is the geocode / top-bottom table.
HINT_SIDES = {
    "auto": ("right", "right"),
    "broadcast": ("right", "right"),
    "merge": ("left", "left"),           # named the big sides
    "merge_small": ("right", "right"),   # named the small sides
    "shuffle_hash": ("right", "right"),
    "shuffle_replicate_nl": ("right", "right"),
}


def income_with_value(income: DataFrame, community_like: str = COMMUNITY_LIKE) -> DataFrame:
    return (trim_names(income).filter(q("Community").like(community_like))
            .withColumn("estimated_median_income_float", L.parse_money(q("Estimated Median Income"))))


def top_and_last(income: DataFrame, community_like: str = COMMUNITY_LIKE, k: int = K) -> DataFrame:
    inc = income_with_value(income, community_like)
    tie = [q("Zip Code"), q("Community"), q("Estimated Median Income")]
    return top_bottom_k(inc, F.col("estimated_median_income_float"), tie, k)


def descent_counts(parts: Sequence[DataFrame], geocode: DataFrame,
                   zips: DataFrame | None = None, strategy: str = "auto",
                   hint_side: str = "right", dedup_keys: Sequence[str] | None = None,
                   normalize_keys: bool = False) -> DataFrame:
    """(zip_code, Vict Descent, total_vict_descent_count).

    ``normalize_keys`` joins positions as numbers (``34.10`` = ``34.1``)
    instead of as text."""
    key = (lambda c: L.number_key(q(c))) if normalize_keys else q
    inc = (distinct_incidents(parts, ["LAT", "LON", "Vict Descent"], q("Vict Descent").isNotNull(), dedup_keys)
           .groupBy(key("LAT").alias("LAT"), key("LON").alias("LON"), q("Vict Descent"))
           .agg(F.count(F.lit(1)).alias("n")))
    geo = (trim_names(geocode).filter(q("ZIPcode").isNotNull())
           .select(key("LAT").alias("g_lat"), key("LON").alias("g_lon"),
                   L.zip_prefix(q("ZIPcode")).alias("zip_code")))
    if zips is not None:
        chosen = zips.select(F.col("zip_code").alias("__z")).distinct()
        # 2k rows by the LIMITs: broadcast by their size, unless the session turns that off
        geo = geo.join(chosen, F.col("zip_code") == F.col("__z"), "left_semi")
    # geocode rows repeating a (position, ZIP5) multiply the join; count them
    # instead, so a crowded position is one row on each side
    geo = geo.groupBy("g_lat", "g_lon", "zip_code").agg(F.count(F.lit(1)).alias("g"))
    cond = (inc["LAT"] == geo["g_lat"]) & (inc["LON"] == geo["g_lon"])
    strat = "merge" if strategy == "merge_small" else strategy
    joined = strategy_join(inc, geo, cond, "inner", strat, hint_side)
    return (joined.groupBy("zip_code", q("Vict Descent"))
            .agg(F.sum(F.col("n") * F.col("g")).alias("total_vict_descent_count")))


def income_extremes(parts: Sequence[DataFrame], geocode: DataFrame, income: DataFrame,
                    strategy: str = "auto", community_like: str = COMMUNITY_LIKE,
                    k: int = K, labels=DESCENT_LABELS,
                    dedup_keys: Sequence[str] | None = None,
                    normalize_keys: bool = False) -> DataFrame:
    side1, side2 = HINT_SIDES[strategy]
    t = top_and_last(income, community_like, k).select(q("Zip Code"))
    zips = t.select(q("Zip Code").alias("zip_code"))
    cz = descent_counts(parts, geocode, zips, strategy, side1, dedup_keys, normalize_keys)
    strat = "merge" if strategy == "merge_small" else strategy
    joined = strategy_join(cz, t, cz["zip_code"] == t["Zip Code"], "inner", strat, side2)
    return (joined.select(
        q("Zip Code"),
        F.col("total_vict_descent_count").alias("#"),
        q("Vict Descent"),
        decode(q("Vict Descent"), labels).alias("victim_category"))
        .orderBy(q("Zip Code"), F.col("#").desc(), q("Vict Descent")))


# SQL hint text per strategy for the (geocode join, top/bottom join); the
# names are the CTE aliases of the SQL form below.
SQL_HINTS = {
    "auto": ("", ""),
    "broadcast": ("/*+ BROADCAST(g) */", "/*+ BROADCAST(t) */"),
    "merge": ("/*+ MERGEJOIN(p) */", "/*+ MERGEJOIN(cz) */"),
    "merge_small": ("/*+ MERGEJOIN(g) */", "/*+ MERGEJOIN(t) */"),
    "shuffle_hash": ("/*+ SHUFFLE_HASH(g) */", "/*+ SHUFFLE_HASH(t) */"),
    "shuffle_replicate_nl": ("/*+ SHUFFLE_REPLICATE_NL(g) */", "/*+ SHUFFLE_REPLICATE_NL(t) */"),
}


def income_extremes_sql(spark: SparkSession, parts: Sequence[DataFrame], geocode: DataFrame,
                        income: DataFrame, community_like: str = COMMUNITY_LIKE,
                        k: int = K, labels=DESCENT_LABELS, strategy: str = "auto",
                        dedup_keys: Sequence[str] | None = None, normalize_keys: bool = False) -> DataFrame:
    """W3 as one SQL text over temp views; ``strategy`` adds the reference's
    SQL join hints (granted as in the DataFrame form); ``dedup_keys`` and
    ``normalize_keys`` as there."""
    views = register_parts(parts, "cp_w3")
    lat, lon = (number_key_sql(c) if normalize_keys else c for c in ("LAT", "LON"))
    trim_names(geocode).createOrReplaceTempView("cp_w3_geocode")
    trim_names(income).createOrReplaceTempView("cp_w3_income")
    union = distinct_sql(views, ["LAT", "LON", "Vict Descent"], "`Vict Descent` IS NOT NULL", dedup_keys)
    cases = "\n            ".join(f"WHEN cz.`Vict Descent` = :code{i} THEN :label{i}" for i in range(len(labels)))
    texts = {f"code{i}": c for i, (c, _) in enumerate(labels)} | {f"label{i}": t for i, (_, t) in enumerate(labels)}
    texts["community"] = community_like
    la_income = f"""
        SELECT *, try_cast(substring(regexp_replace(`Estimated Median Income`, ',', ''), 2) AS FLOAT)
                  AS estimated_median_income_float
        FROM cp_w3_income WHERE Community LIKE :community"""
    top_and_last = f"""
        SELECT * FROM (SELECT * FROM la_income
                       ORDER BY estimated_median_income_float DESC NULLS LAST,
                                `Zip Code`, Community, `Estimated Median Income` LIMIT {int(k)})
        UNION ALL
        SELECT * FROM (SELECT * FROM la_income
                       ORDER BY estimated_median_income_float ASC NULLS FIRST,
                                `Zip Code`, Community, `Estimated Median Income` LIMIT {int(k)})"""
    geo = f"""
        SELECT {lat} AS LAT, {lon} AS LON, substring(ZIPcode, 1, 5) AS zip_code, count(*) AS g
        FROM cp_w3_geocode
        WHERE ZIPcode IS NOT NULL
          AND substring(ZIPcode, 1, 5) IN (SELECT `Zip Code` FROM top_and_last)
        GROUP BY {lat}, {lon}, substring(ZIPcode, 1, 5)"""
    picks = f"WITH la_income AS ({la_income}), top_and_last AS ({top_and_last})"
    strat = "merge" if strategy == "merge_small" else strategy
    allowed = [granted(spark.sql(f"{picks} {text}", args={"community": community_like}), strat) == strat
               for text in (geo, "SELECT * FROM top_and_last")]
    hint1, hint2 = (h if ok else "" for h, ok in zip(SQL_HINTS[strategy], allowed))
    return spark.sql(f"""
    WITH combined_crime_data AS (
        {union}
    ), by_position AS (
        SELECT {lat} AS LAT, {lon} AS LON, `Vict Descent`, count(*) AS n
        FROM combined_crime_data
        GROUP BY {lat}, {lon}, `Vict Descent`
    ), la_income AS ({la_income}
    ), top_and_last AS ({top_and_last}
    ), geo AS ({geo}
    ), crime_data_per_zip AS (
        SELECT {hint1} g.zip_code, p.`Vict Descent`, sum(p.n * g.g) AS total_vict_descent_count
        FROM by_position p JOIN geo g ON g.LAT = p.LAT AND g.LON = p.LON
        GROUP BY g.zip_code, p.`Vict Descent`
    )
    SELECT {hint2} t.`Zip Code`, cz.total_vict_descent_count AS `#`, cz.`Vict Descent`,
        CASE
            {cases}
            ELSE cz.`Vict Descent`
        END AS victim_category
    FROM top_and_last t JOIN crime_data_per_zip cz ON cz.zip_code = t.`Zip Code`
    ORDER BY t.`Zip Code`, cz.total_vict_descent_count DESC, cz.`Vict Descent`
    """, args=texts)
