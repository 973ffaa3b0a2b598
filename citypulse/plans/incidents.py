"""W0: one typed, de-duplicated incident table from several text parts."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lenient as L
from ..operators.dedupe import distinct_moving_copies
from ..operators.rows import dedup_rows, project, q
from ..sources.csv import union_parts

DATE_COLUMNS = ("Date Rptd", "DATE OCC")
INT_COLUMNS = ("Vict Age",)
DOUBLE_COLUMNS = ("LAT", "LON")


def combined(parts: Sequence[DataFrame], dedup_keys: Sequence[str] | None = None, moving_copies: bool = False) -> DataFrame:
    """Positional union of the parts, then dedupe (full row by default). With ``moving_copies`` the full-row
    dedupe shuffles only rows that may have a copy: the same rows, by a job that is run at once."""
    rows = union_parts(parts)
    return distinct_moving_copies(rows) if moving_copies and not dedup_keys else dedup_rows(rows, dedup_keys)


def distinct_incidents(parts: Sequence[DataFrame], used: Sequence[str], where: Column | None = None,
                       dedup_keys: Sequence[str] | None = None) -> DataFrame:
    """The distinct incidents of a report: filter, then dedupe.

    Rows are compared whole, or with ``dedup_keys`` (e.g. ``["DR_NO"]``) by
    those keys and the ``used`` columns. The latter is the same where rows with
    one key are copies; scan and shuffle then carry only those columns. Copies
    that differ in a used column count separately, so no arbitrary one is kept.
    """
    rows = union_parts(parts)
    if where is not None:
        rows = rows.filter(where)
    if dedup_keys:
        rows = project(rows, list(dict.fromkeys([*dedup_keys, *used])))
    return rows.distinct()


def typed(df: DataFrame) -> DataFrame:
    """Lenient types: dates -> timestamp, age -> int, coordinates -> double.

    Column names resolve case-insensitively, so ``Date OCC`` and
    ``DATE OCC`` are the same column; only columns present are typed.
    """
    present = {c.lower(): c for c in df.columns}
    conv = {}
    for name in DATE_COLUMNS:
        if name.lower() in present:
            c = present[name.lower()]
            conv[c] = L.parse_timestamp(q(c))
    for name in INT_COLUMNS:
        if name.lower() in present:
            c = present[name.lower()]
            conv[c] = L.to_int(q(c))
    for name in DOUBLE_COLUMNS:
        if name.lower() in present:
            c = present[name.lower()]
            conv[c] = L.to_double(q(c))
    return df.withColumns(conv)


def typed_ingest(parts: Sequence[DataFrame], dedup_keys: Sequence[str] | None = None) -> DataFrame:
    return typed(combined(parts, dedup_keys))


def row_count(df: DataFrame) -> DataFrame:
    """Whole-table count as a one-row DataFrame (partial counts per task)."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))
