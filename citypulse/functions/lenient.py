"""Lenient typing of text columns.

Spark 4 runs with ANSI mode on, where ``cast`` and ``to_timestamp`` raise
on bad text.  The reference's data model (all-string CSV, typed per query,
``WHERE Year IS NOT NULL``) needs bad values to become NULL, so every
conversion here is a ``try_`` form.  All are plain Column expressions and
stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the timestamp layout of the incident date columns.
INCIDENT_TS_FORMAT = "MM/dd/yyyy hh:mm:ss a"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c: str | Column) -> Column:
    """Text -> int, NULL when not a number."""
    return _col(c).try_cast("int")


def to_double(c: str | Column) -> Column:
    """Text -> double, NULL when not a number."""
    return _col(c).try_cast("double")


def to_float(c: str | Column) -> Column:
    """Text -> float, NULL when not a number."""
    return _col(c).try_cast("float")


def parse_timestamp(c: str | Column, fmt: str = INCIDENT_TS_FORMAT) -> Column:
    """Text -> timestamp with a 12-hour pattern; NULL when it does not parse."""
    return F.try_to_timestamp(_col(c), F.lit(fmt))


def year_of(c: str | Column) -> Column:
    return F.year(_col(c))


def month_of(c: str | Column) -> Column:
    return F.month(_col(c))


def text_prefix(c: str | Column, n: int) -> Column:
    """First ``n`` characters (ZIP5 from ZIP+4, hour from HHmm)."""
    return F.substring(_col(c), 1, n)


def zip_prefix(c: str | Column) -> Column:
    return text_prefix(c, 5)


def parse_money(c: str | Column) -> Column:
    """``'$33,887'`` -> 33887.0 as float.

    Same steps as the reference: drop every comma, drop the first character
    (the currency sign), cast to float.  A leading blank or other junk gives
    NULL instead of an error.
    """
    return to_float(F.substr(F.regexp_replace(_col(c), ",", ""), F.lit(2)))


def number_key(c: str | Column, kind: str = "double") -> Column:
    """Join key that makes equal numbers equal whatever their spelling
    (``'34.10'`` = ``'34.1'``, ``'01'`` = ``'1'``); non-numeric text is kept
    as is.  The reference joins on raw text; this is the opt-in alternative."""
    x = _col(c)
    return F.coalesce(x.try_cast(kind).cast("string"), x)
