"""Helpers shared by the operators: Arrow functions on partitions, tables
written to the shared folder, and byte-level views of text columns."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from citypulse.operators.joins import scoped_conf
from citypulse.session import scratch_path

U64 = np.uint64
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workers_see_package(spark: SparkSession) -> None:
    """Python workers import this package from where the driver found it
    (a cluster has it installed; there the extra path is harmless)."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)


def map_arrow(df: DataFrame, fn: Callable, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` with the package visible to the workers, which hand
    freed memory back at the end of each task: they outlive it."""
    workers_see_package(df.sparkSession)

    def run(batches_in):
        yield from fn(batches_in)
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return this process's freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


#: Spark deletes the shuffle files of a statement when it ends, not when the driver's
#: garbage collector comes by
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: computed once, and
    read again after the loss of any executor. The shuffles it took are deleted with
    the end of the write."""
    path = scratch_path(df.sparkSession, name)
    with scoped_conf(df.sparkSession, FREE_SHUFFLES):  # the write runs inside the block
        df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def dropped(df: DataFrame) -> None:
    """Delete a table made by ``written`` that nothing reads any more."""
    path = getattr(df, "_written_path", None)
    if path:
        spark = df.sparkSession
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now: it does so
    when the driver's objects for them are collected."""
    gc.collect()
    spark._jvm.System.gc()


def own_column(df: DataFrame, name: str) -> str:
    """A column name that does not clash with those of ``df`` (which Spark
    compares without regard to case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def batches(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """A record batch of the given rows."""
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=f.type) for c, f in zip(cols, schema)], schema=schema)


def by_bytes(batch: pa.RecordBatch, text: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most about ``limit`` bytes of text each (one
    row at least), so that working memory does not follow the batch size."""
    n = batch.num_rows
    if not n:
        return
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size, dtype=np.int64)
    at = 0
    while at < n:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all rows, row offsets); a null row has no bytes."""
    col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    kind = np.int64 if wide else np.int32
    n = len(col)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, kind, count=col.offset + n + 1)[col.offset:].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z only


def words_of(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Maximal runs of word bytes that do not cross rows.

    Returns (start, end) byte positions of each word and the index of the
    first word of each row (one more entry than rows)."""
    w = is_word[data]
    before = np.empty_like(w)
    after = np.empty_like(w)
    if len(w):
        before[1:] = w[:-1]
        before[0] = False
        after[:-1] = w[1:]
        after[-1] = False
        inner = offsets[(offsets > 0) & (offsets < len(w))]
        before[inner] = False
        after[inner - 1] = False
    start = np.flatnonzero(w & ~before)
    end = np.flatnonzero(w & ~after) + 1
    return start, end, np.searchsorted(start, offsets)


#: words separated by ASCII white space: space and \x09-\x0D
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) applied to each element."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mixed(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_STEP = U64(0xD1342543DE82EF95)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same in every process."""
    if not len(start):
        return np.empty(0, U64)
    size = end - start
    total = int(size.sum())
    first = np.cumsum(size) - size
    place = np.arange(total, dtype=np.int64) - np.repeat(first, size)
    power = np.concatenate(([U64(1)], np.cumprod(np.full(int(size.max()), _STEP, U64), dtype=U64)))
    value = _BYTE[data[np.repeat(start, size) + place]] * power[place]
    return mixed(np.add.reduceat(value, first) + size.astype(U64))


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words (entry i: words i..i+k-1)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    h = np.zeros(n, U64)
    for i in range(k):
        h = h * U64(0x9E3779B97F4A7C15) + words[i:i + n]
    return mixed(h + U64(k))


def text_of(name: str):
    """The text column as UTF-8 text; null counts as empty, and bytes that are not valid
    UTF-8 (which Spark's strings may hold) as U+FFFD, as ``make_valid_utf8`` puts it."""
    return F.make_valid_utf8(F.coalesce(F.col(name).cast("string"), F.lit("")))
