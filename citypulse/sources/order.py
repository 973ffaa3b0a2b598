"""The order in which a table's rows stand in its files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reading_order(df: DataFrame) -> Column:
    """A sortable value that follows the rows as they stand: by file, by block of the
    file, and within the block.

    Tasks read several small files or parts of a large one, packed by size, so an id by
    task (``monotonically_increasing_id``) alone does not follow the files; within
    one block it does. The value is the same for a table whether its rows lie in one file or in
    several named in order. A frame that is not a plain read of files (a join, rows made in
    memory) has no file order; its rows are ordered by task."""
    own = F.monotonically_increasing_id()
    try:
        df.select("_metadata.file_path", "_metadata.file_block_start")
    except AnalysisException:
        return F.struct(F.lit("").alias("file"), F.lit(0).cast("bigint").alias("block"), own.alias("row"))
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), own.alias("row"))
