"""Header-CSV and typed-CSV readers and the multi-part union.

The reference keeps raw files as header CSV where every column is text and
types are added per query; ``read_header_csv`` reproduces that (no schema
inference, so no extra pass over the data).  ``read_typed_csv`` declares a
full schema up front; PERMISSIVE mode turns unparsable fields into NULL.

Paths may be any Hadoop URI (``hdfs://``, ``s3a://``, ``file:``) or a list
of them; Spark splits large files into ``spark.sql.files.maxPartitionBytes``
chunks, so one big part is still read in parallel.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lenient import INCIDENT_TS_FORMAT


def trim_names(df: DataFrame) -> DataFrame:
    """Strip blanks around column names (``'AREA '`` -> ``'AREA'``)."""
    names = [c.strip() for c in df.columns]
    if names == df.columns:
        return df
    return df.toDF(*names)


def read_header_csv(spark: SparkSession, path: str | Sequence[str],
                    trim: bool = True) -> DataFrame:
    """Header CSV, every column as string."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return trim_names(df) if trim else df


def read_typed_csv(spark: SparkSession, path: str | Sequence[str],
                   schema: T.StructType,
                   timestamp_format: str = INCIDENT_TS_FORMAT) -> DataFrame:
    """Header CSV with a declared schema; bad fields become NULL.

    The schema must list every column of the file: CSV fields bind to the
    schema by position.
    """
    return (spark.read.option("header", True)
            .option("mode", "PERMISSIVE")
            .option("timestampFormat", timestamp_format)
            .option("timestampNTZFormat", timestamp_format)
            .schema(schema).csv(path))


def union_parts(parts: Iterable[DataFrame], trim: bool = True) -> DataFrame:
    """One logical table from several parts with one column layout.

    Positional union (names come from the first part, so a part that spells
    a header differently still lines up); duplicates are kept.
    """
    parts = list(parts)
    if not parts:
        raise ValueError("union_parts needs at least one part")
    df = reduce(DataFrame.union, parts)
    return trim_names(df) if trim else df


def union_distinct(parts: Iterable[DataFrame]) -> DataFrame:
    """SQL ``UNION`` of the parts: positional union, then full-row distinct.

    Planned as one n-ary union feeding one partial + final aggregate, so the
    shuffle carries each distinct row once per map task.
    """
    return union_parts(parts).distinct()


def write_header_csv(df: DataFrame, path: str) -> str:
    """Write a DataFrame as header CSV (one file per task) and return the path."""
    df.write.mode("error").option("header", True).csv(path)
    return path
