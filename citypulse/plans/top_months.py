"""W1: per year, the N months with most incidents and their rank.

Plan shape: one n-ary union -> partial/final distinct -> (year, month)
partial/final count -> WindowGroupLimit + row_number per year.  Only the
distinct shuffles incident-sized data; everything after it is at most
(years x 12) rows.  Ties in the count go to the earlier month.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lenient as L
from ..operators.rows import q, top_n_per_group
from .incidents import distinct_incidents, typed


def top_months_df(parts: Sequence[DataFrame], n: int = 3,
                  dedup_keys: Sequence[str] | None = None) -> DataFrame:
    """``dedup_keys`` (e.g. ``["DR_NO"]``) compares the record key and the
    date instead of full rows: only these then cross the shuffle."""
    inc = typed(distinct_incidents(parts, ["DATE OCC"], dedup_keys=dedup_keys))
    ym = inc.select(L.year_of(q("DATE OCC")).alias("Year"), L.month_of(q("DATE OCC")).alias("Month"))
    counts = ym.groupBy("Year", "Month").agg(F.count(F.lit(1)).alias("count"))
    ranked = top_n_per_group(counts.filter(F.col("Year").isNotNull()), ["Year"],
                             [F.col("count").desc(), F.col("Month").asc()], n, "rank")
    return ranked.select(
        F.col("Year"), F.col("Month"),
        F.col("count").alias("Total Crimes"), F.col("rank").alias("#"))


def register_parts(parts: Sequence[DataFrame], prefix: str) -> list[str]:
    names = []
    for i, p in enumerate(parts, 1):
        name = f"{prefix}_p{i}"
        p.createOrReplaceTempView(name)
        names.append(name)
    return names


def distinct_sql(views: Sequence[str], used: Sequence[str], where: str = "",
                 dedup_keys: Sequence[str] | None = None) -> str:
    """The distinct incidents of a report as SQL text over its views: the SQL form of
    ``incidents.distinct_incidents``, with ``where`` in every branch."""
    every = "DISTINCT *" if len(views) == 1 else "*"
    branches = [f"SELECT {every} FROM {v}" + (f" WHERE {where}" if where else "") for v in views]
    if not dedup_keys:
        return "\n        UNION DISTINCT\n        ".join(branches)
    columns = ", ".join("`" + c.replace("`", "``") + "`" for c in dict.fromkeys([*dedup_keys, *used]))
    union = "\n            UNION ALL\n            ".join(branches)
    return f"SELECT DISTINCT {columns} FROM (\n            {union})"


def number_key_sql(column: str, kind: str = "DOUBLE") -> str:
    """The SQL form of ``lenient.number_key``."""
    return f"coalesce(CAST(try_cast({column} AS {kind}) AS STRING), {column})"


def top_months_sql(spark: SparkSession, parts: Sequence[DataFrame], n: int = 3,
                   dedup_keys: Sequence[str] | None = None) -> DataFrame:
    """``dedup_keys``: as in the DataFrame form."""
    views = register_parts(parts, "cp_w1")
    return spark.sql(f"""
    WITH combined AS (
        {distinct_sql(views, ["DATE OCC"], "", dedup_keys)}
    ), dated AS (
        SELECT try_to_timestamp(`DATE OCC`, '{L.INCIDENT_TS_FORMAT}') AS occ FROM combined
    ), ym AS (
        SELECT year(occ) AS Year, month(occ) AS Month FROM dated
    ), ranked AS (
        SELECT Year, Month, count(*) AS crime_count,
               row_number() OVER (PARTITION BY Year ORDER BY count(*) DESC, Month) AS crime_rank
        FROM ym
        GROUP BY Year, Month
    )
    SELECT Year, Month, crime_count AS Total_Crimes, crime_rank AS Rank
    FROM ranked
    WHERE crime_rank <= {int(n)} AND Year IS NOT NULL
    """)
