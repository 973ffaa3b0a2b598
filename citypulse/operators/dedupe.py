"""Full-row dedupe that moves only rows which may have a copy.

``distinct()`` sends every row through the shuffle, though most tables hold few
copies. Here a row sends an 8-byte hash first; hashes met more than once are set as
bits of a Bloom filter with one hash function, kept as bitmap rows of 4 KB. Rows outside
the filter have no copy and stay where they are; the others, the copies and
a few false alarms, are compared whole by ``distinct()``. Hashes choose what is
moved, never what is equal.

The input is read three times (hashes, rows outside, rows inside), which pays where
rows are wide and copies few; it must give the same rows each time, as a
table does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scoped import FREED, adopted, planned_with

#: bits of one bitmap row: what ``bitmap_construct_agg`` fills
BITMAP_BITS = 8 * 4096
#: types whose equality under ``distinct()`` implies equal hashes
HASHED = (T.StringType, T.BinaryType, T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of the whole row; nulls count by place."""
    cols = _columns(df)
    return F.xxhash64(*cols, *[c.isNull() for c in cols])


def hashable(df: DataFrame) -> bool:
    """Whether rows that are equal hash alike, by the columns' types and names."""
    plain = all(isinstance(f.dataType, HASHED) and not (isinstance(f.dataType, T.StringType) and f.dataType != T.StringType())
                for f in df.schema)
    return plain and len({c.lower() for c in df.columns}) == len(df.columns) > 0


def repeated_hashes(df: DataFrame) -> DataFrame:
    """The hashes (``h``) that several rows have: 8 bytes a row and task cross the shuffle,
    a hot row once a task."""
    return (df.select(row_hash(df).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("rows"))
            .where("rows > 1").select("h"))


def distinct_moving_copies(df: DataFrame, most_filter_bytes: int = 64 << 20, bits_each: int = 16) -> DataFrame:
    """The rows of ``df.distinct()``.

    The filter takes ``bits_each`` bits a repeated hash (16: one unique row in 16 is
    moved too) and is broadcast, so its size is checked: with more repeated
    hashes than ``most_filter_bytes`` hold, or columns that hash differently while
    equal (nested types, collations, names that differ in case only), the
    result is plain ``distinct()``. One job counts hashes and keeps the repeated ones
    by ``checkpoint()``. Nulls are equal to each other, as are 0.0 and -0.0; an empty table stays empty.
    """
    if not hashable(df):
        return df.distinct()
    repeated = adopted(df.sparkSession, planned_with(repeated_hashes(df), FREED).checkpoint())
    many = repeated.count()
    if not many:
        return df
    if many * bits_each > 8 * most_filter_bytes:
        return df.distinct()
    maps = -(-many * bits_each // BITMAP_BITS)
    place = lambda h: F.pmod(h, F.lit(maps * BITMAP_BITS))
    bitmaps = (repeated.groupBy(F.floor(place(F.col("h")) / BITMAP_BITS).alias("number"))
               .agg(F.bitmap_construct_agg(place(F.col("h")) % BITMAP_BITS).alias("bits")))
    number, bits = (_free(df, n) for n in ("number", "bits"))
    bitmaps = bitmaps.withColumnsRenamed({"number": number, "bits": bits})  # maps * 4 KB: under the bound
    at = place(row_hash(df))
    bit = at % BITMAP_BITS
    byte = F.conv(F.hex(F.substring(F.col(bits), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    inside = F.coalesce(F.getbit(byte, (bit % 8).cast("int")), F.lit(0)) == 1  # lowest bit first
    marked = df.join(F.broadcast(bitmaps), F.floor(at / BITMAP_BITS) == F.col(number), "left")
    return (marked.where(~inside).select(*_columns(df))
            .unionAll(marked.where(inside).select(*_columns(df)).distinct()))


def _columns(df: DataFrame) -> list[Column]:
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def _free(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name
