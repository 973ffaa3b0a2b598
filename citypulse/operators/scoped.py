"""Session settings that stay with a frame.

A query is planned when it runs, under the settings its session has then; settings put
back at the end of a block (``joins.scoped_conf``) do not reach a frame that runs
later. Here a frame moves to a session of its own that keeps the settings: the
scoped form of the reference's session-wide thresholds. The caller's session, its settings
and its views stay as they are. Sessions share one application, its executors
and its cached tables.
"""

from __future__ import annotations

import uuid
from typing import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

#: for a frame that runs once: its shuffles are deleted when it has run, not at some garbage collection of the driver
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def session_with(spark: SparkSession, settings: Mapping[str, str], views: Iterable[str] = ()) -> SparkSession:
    """A new session with the settings of ``spark`` as they are now, ``settings`` over
    them, and the named temp views of ``spark``."""
    child = spark.newSession()
    for key, value in {**spark.conf.getAll, **settings}.items():
        if child.conf.isModifiable(key):
            child.conf.set(key, str(value))
        elif key in settings:
            raise ValueError(f"{key} cannot be set in a session")
    for name in views:
        adopted(child, spark.table(name)).createOrReplaceTempView(name)
    return child


def adopted(session: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` as a frame of ``session``: planned and run under its settings. Nothing is computed."""
    name = f"cp_moved_{uuid.uuid4().hex}"
    df.createGlobalTempView(name)
    try:
        space = session.conf.get("spark.sql.globalTempDatabase", "global_temp")
        return session.table(f"{space}.{name}")
    finally:
        session.catalog.dropGlobalTempView(name)  # the frame keeps what the view stood for


def planned_with(df: DataFrame, settings: Mapping[str, str]) -> DataFrame:
    """``df`` planned under ``settings`` whenever it runs."""
    return adopted(session_with(df.sparkSession, settings), df)


def built_with(spark: SparkSession, settings: Mapping[str, str],
               build: Callable[..., DataFrame], *frames: DataFrame | list[DataFrame]) -> DataFrame:
    """``build(session, *frames)`` in a session with ``settings``, the frames moved
    there: for builders that run SQL texts or jobs of their own."""
    child = session_with(spark, settings)
    moved = [[adopted(child, x) for x in f] if isinstance(f, list) else adopted(child, f) for f in frames]
    return build(child, *moved)
