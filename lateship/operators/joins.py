"""Join helpers: size-checked broadcast and null-safe multi-key joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

# Largest dimension we are willing to ship to every executor.
BROADCAST_MAX_BYTES = 64 << 20


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's size of ``df``: file sizes scaled to the columns read,
    and an upper estimate above joins. No job is run."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only if its planned size is within ``max_bytes``.

    Beyond the bound the frame is returned unchanged; AQE may still broadcast
    it once its real size has been measured, else the join is a shuffle join.
    """
    return F.broadcast(df) if planned_bytes(df) <= max_bytes else df


def null_safe_condition(left: DataFrame, right: DataFrame, left_keys, right_keys):
    return reduce(lambda a, b: a & b,
                  [left[lk].eqNullSafe(right[rk]) for lk, rk in zip(left_keys, right_keys)])
