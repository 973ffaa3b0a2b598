"""Join with a selectable physical strategy.

The reference compares Catalyst's own choice with four join hints:
BROADCAST, MERGE (sort-merge), SHUFFLE_HASH and SHUFFLE_REPLICATE_NL.  Here
the strategy is an argument.  Two of them replicate one side and are only
granted where the plan bounds that side, without running a job: broadcast by
the optimizer's size in bytes, the nested loop by the most rows the plan can
give (a LIMIT).  Beyond that the hint is left out, with a warning, and Catalyst
and AQE choose the join as for ``auto`` (size statistics, runtime re-planning,
skew splitting; sort-merge spills where a side does not fit).

``scoped_conf`` sets session options for the span of a block and restores
them, the scoped form of the reference's session-wide threshold setting.
"""

from __future__ import annotations

import contextlib
import logging
from typing import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

log = logging.getLogger(__name__)

STRATEGIES = ("auto", "broadcast", "merge", "shuffle_hash", "shuffle_replicate_nl")
# Spark hint names; SQL text may also spell MERGE as MERGEJOIN or SHUFFLE_MERGE
HINT_NAMES = {
    "broadcast": "broadcast",
    "merge": "merge",
    "shuffle_hash": "shuffle_hash",
    "shuffle_replicate_nl": "shuffle_replicate_nl",
}
# A broadcast side is copied to every executor once; a nested-loop side meets
# every row of the other side, so only a lookup-sized one (a top/bottom-k set)
# qualifies.
BROADCAST_MAX_BYTES = 64 << 20
NL_MAX_ROWS = 64


def check_strategy(strategy: str) -> str:
    s = strategy.lower()
    if s in ("mergejoin", "shuffle_merge"):
        s = "merge"
    if s not in STRATEGIES:
        raise ValueError(f"unknown join strategy {strategy!r}; expected one of {STRATEGIES}")
    return s


def granted(side: DataFrame, strategy: str, max_bytes: int = BROADCAST_MAX_BYTES,
            max_rows: int = NL_MAX_ROWS) -> str:
    """The strategy itself, or ``auto`` where it would replicate ``side`` and
    the plan does not bound it.  Reads the optimized plan's statistics only."""
    s = check_strategy(strategy)
    if s not in ("broadcast", "shuffle_replicate_nl"):
        return s
    plan = side._jdf.queryExecution().optimizedPlan()
    if s == "broadcast":
        size = int(str(plan.stats().sizeInBytes()))
        if size <= max_bytes:
            return s
        log.warning("broadcast left out: the side has %d bytes by the optimizer, over %d", size, max_bytes)
    else:
        most = plan.maxRows()
        if most.isDefined() and most.get() <= max_rows:
            return s
        log.warning("nested loop left out: the plan does not hold the side to %d rows", max_rows)
    return "auto"


def hinted(df: DataFrame, strategy: str) -> DataFrame:
    s = check_strategy(strategy)
    return df if s == "auto" else df.hint(HINT_NAMES[s])


def strategy_join(left: DataFrame, right: DataFrame, on: Sequence[str] | Column,
                  how: str = "inner", strategy: str = "auto", hint_side: str = "right",
                  max_bytes: int = BROADCAST_MAX_BYTES, max_rows: int = NL_MAX_ROWS) -> DataFrame:
    """Join ``left`` and ``right`` with the named physical strategy.

    ``hint_side`` is the side the hint names (the build / replicated side
    for broadcast, hash and nested-loop joins); see ``granted`` for the bounds
    on a replicated side.
    """
    side = right if hint_side == "right" else left
    s = granted(side, strategy, max_bytes, max_rows)
    side = hinted(side, s)
    if hint_side == "right":
        right = side
    else:
        left = side
    return left.join(right, on=on, how=how)


@contextlib.contextmanager
def scoped_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set session options inside the block, restore them after."""
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, str(v))
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# Session options of the reference's hinted runs: no size-based broadcast,
# at plan time or at AQE re-planning time.
NO_AUTO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
