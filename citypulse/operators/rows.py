"""Row-set operators: dedupe, projection, rename, ordered limits, top-k.

All are thin DataFrame compositions chosen for the physical plan they give:
``dropDuplicates`` plans a partial (map-side) + final aggregate, so a row
repeated many times crosses the shuffle at most once per map task;
``orderBy().limit(k)`` plans ``TakeOrderedAndProject`` (per-task top-k, no
global sort); a filter on ``row_number() <= n`` plans a partial + final
``WindowGroupLimit``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def q(name: str) -> Column:
    """Column by exact name, spaces and odd characters allowed."""
    return F.col(f"`{name}`")


def dedup_rows(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Full-row dedupe (default) or dedupe on a key subset.

    A key subset (e.g. a record number) lets column pruning reach the scan
    and narrows the shuffle; it keeps an arbitrary row per key, so use it
    only where rows sharing the key are equal.
    """
    return df.dropDuplicates(list(keys)) if keys else df.dropDuplicates()


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[q(c) for c in columns])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns; odd target names (``#``, ``Total Crimes``) are fine."""
    return df.withColumnsRenamed(mapping)


def ordered_limit(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows under a total order (the ``show(n)`` of the reference,
    made deterministic by an order that ends in a unique key)."""
    return df.orderBy(*order).limit(n)


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                    n: int, rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..n inside each group by ``row_number``."""
    w = Window.partitionBy(*[q(g) for g in group]).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def top_bottom_k(df: DataFrame, value: Column, tie: Sequence[Column], k: int) -> DataFrame:
    """``k`` highest plus ``k`` lowest rows (UNION ALL, so a row can appear twice
    when the input holds fewer than ``2k`` rows).

    Spark null order: NULL is last in the descending pick and first in the
    ascending one.  ``tie`` columns make both picks deterministic.
    """
    top = df.orderBy(value.desc_nulls_last(), *tie).limit(k)
    bottom = df.orderBy(value.asc_nulls_first(), *tie).limit(k)
    return top.unionAll(bottom)
