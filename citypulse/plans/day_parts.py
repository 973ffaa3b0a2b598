"""W2: incidents on the street, counted per part of day, most first.

Three forms, as in the reference:

* ``day_parts_df``   - dedupe, filter, lexicographic ``HHmm`` ranges;
* ``day_parts_sql``  - filter in each UNION branch, integer-hour CASE;
* ``day_parts_rows`` - the row-API form re-aimed at DataFrames: filter,
  distinct, hour rule, count, sort (a NULL time is ``Unknown`` instead of
  an error).

The premise filter is pushed below the distinct into every scan branch, so
only street rows are shuffled; the count is a partial + final aggregate on
five labels (each task sends at most five rows).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dayparts as D
from ..operators.rows import q
from ..sources.csv import union_parts
from .incidents import distinct_incidents
from .top_months import distinct_sql, register_parts

STREET = "STREET"


def day_parts_df(parts: Sequence[DataFrame], premise: str = STREET,
                 labels=D.GREEKLISH, pad: bool = False,
                 dedup_keys: Sequence[str] | None = None) -> DataFrame:
    street = distinct_incidents(parts, ["TIME OCC"], q("Premis Desc") == premise, dedup_keys)
    labelled = street.select(D.by_text(q("TIME OCC"), labels, pad).alias("TIME_OF_THE_DAY"))
    counts = labelled.groupBy("TIME_OF_THE_DAY").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.col("count").desc(), F.col("TIME_OF_THE_DAY"))


def day_parts_sql(spark: SparkSession, parts: Sequence[DataFrame], premise: str = STREET,
                  labels=D.GREEK, dedup_keys: Sequence[str] | None = None) -> DataFrame:
    """``dedup_keys``: as in the DataFrame form."""
    union = distinct_sql(register_parts(parts, "cp_w2"), ["TIME OCC"], "`Premis Desc` = :premise", dedup_keys)
    texts = dict(zip(("morning", "afternoon", "evening", "night", "unknown"), labels), premise=premise)
    hour = "try_cast(substring(`TIME OCC`, 1, 2) AS INT)"
    return spark.sql(f"""
    WITH combined AS (
        {union}
    ), street AS (
        SELECT CASE
            WHEN {hour} >= {D.MORNING_HOURS[0]} AND {hour} <= {D.MORNING_HOURS[1]} THEN :morning
            WHEN {hour} >= {D.AFTERNOON_HOURS[0]} AND {hour} <= {D.AFTERNOON_HOURS[1]} THEN :afternoon
            WHEN {hour} >= {D.EVENING_HOURS[0]} AND {hour} <= {D.EVENING_HOURS[1]} THEN :evening
            WHEN {hour} >= {D.NIGHT_FROM} OR {hour} <= {D.NIGHT_TO} THEN :night
            ELSE :unknown
        END AS time_periods
        FROM combined
    ), counted AS (
        SELECT time_periods, count(*) AS countPeriods FROM street GROUP BY time_periods
    )
    SELECT * FROM counted ORDER BY countPeriods DESC, time_periods
    """, args=texts)


def day_parts_rows(parts: Sequence[DataFrame], premise: str = STREET,
                   labels=D.GREEK, dedup_keys: Sequence[str] | None = None) -> DataFrame:
    street = distinct_incidents(parts, ["TIME OCC"], q("Premis Desc") == premise, dedup_keys)
    labelled = street.select(D.by_hour(q("TIME OCC"), labels).alias("time_period"))
    counts = labelled.groupBy("time_period").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.col("count").desc(), F.col("time_period"))


def street_rows_by_time(parts: Sequence[DataFrame], premise: str = STREET,
                        labels=D.GREEK) -> DataFrame:
    """Distinct street rows with their label, latest time code first
    (the reference's ordering of rows by integer ``TIME OCC``)."""
    street = union_parts(parts).filter(q("Premis Desc") == premise).distinct()
    labelled = street.withColumn("time_period", D.by_hour(q("TIME OCC"), labels))
    return labelled.orderBy(q("TIME OCC").try_cast("int").desc_nulls_last(), q("DR_NO"))
