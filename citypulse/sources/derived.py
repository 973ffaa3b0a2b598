"""Tables derived once per application, and deleted with it.

A derived table is written to the shared checkpoint folder the first time it is asked for
and read from there afterwards, by every session of the application and after the loss of any
executor. It is known by its name and a fingerprint of the files it came from (path, length and
time of change), so changed files give a new table. Uses are counted: a table nobody
uses any more can be deleted at once; whatever is left goes when the owner is closed,
at the latest when the application's process ends.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    at = _path(spark, path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """A digest of path, length and time of change of all files at or below ``paths``."""
    seen = []
    for path in paths:
        at, fs = _files(spark, path)
        listed = fs.listFiles(at, True)
        while listed.hasNext():
            f = listed.next()
            seen.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()


@dataclass
class _Entry:
    path: str
    uses: int = 0


class DerivedTables:
    """The owner of an application's derived tables (``DerivedTables.of(spark)``), or of
    those made inside a ``with`` block."""

    _by_application: dict[str, "DerivedTables"] = {}

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = scratch_path(spark, "derived")
        self.entries: dict[tuple[str, str], _Entry] = {}
        at, fs = _files(spark, self.folder)
        fs.mkdirs(at)   # only a folder that is there is noted
        fs.deleteOnExit(at)

    @classmethod
    def of(cls, spark: SparkSession) -> "DerivedTables":
        name = spark.sparkContext.applicationId
        if name not in cls._by_application:
            cls._by_application = {name: cls(spark)}   # a former application has ended
        return cls._by_application[name]

    def path(self, name: str, sources: Sequence[str], write: Callable[[str], object]) -> str:
        """The folder of the derived table; ``write`` is called with it the first time. Counts a use."""
        key = (name, fingerprint(self.spark, sources))
        entry = self.entries.get(key)
        if entry is None:
            entry = _Entry(f"{self.folder}/{name}-{uuid.uuid4().hex}")
            write(entry.path)
            self.entries[key] = entry
        entry.uses += 1
        return entry.path

    def table(self, spark: SparkSession, name: str, sources: Sequence[str], build: Callable[[], DataFrame],
              partition_by: Sequence[str] = ()) -> DataFrame:
        """The derived table as a frame of ``spark``. Counts a use."""
        schemas = []

        def write(path):
            df = build()
            schemas.append(df.schema)
            df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)

        path = self.path(name, sources, write)
        if schemas:
            self._schemas()[path] = schemas[0]
        return spark.read.schema(self._schemas()[path]).parquet(path)

    def _schemas(self) -> dict:
        return self.__dict__.setdefault("_known_schemas", {})

    def release(self, path: str) -> None:
        """End one use of a folder; the last one deletes it."""
        for key, entry in list(self.entries.items()):
            if entry.path == path:
                entry.uses -= 1
                if entry.uses <= 0:
                    self._delete(path)
                    del self.entries[key]

    def _delete(self, path: str) -> None:
        at, fs = _files(self.spark, path)
        fs.delete(at, True)

    def close(self) -> None:
        """Delete all tables; frames over them can no longer run."""
        self._delete(self.folder)
        self.entries.clear()
        self._by_application.pop(self.spark.sparkContext.applicationId, None)

    def __enter__(self) -> "DerivedTables":
        return self

    def __exit__(self, *_) -> None:
        self.close()
