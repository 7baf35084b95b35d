"""Latest row per key.

``latest_per_key`` is a ranking window with ``row_number() == 1``. Catalyst turns it
into a partial ``WindowGroupLimit`` before the shuffle and a final one after it, so
each map task ships at most one row per key: a key holding a third of all events
still arrives at its reducer as one row per map task, not as a third of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changelake.functions.ordering import newest_first
from changelake.schemas import EVENT_ORDER, OP_DELETE, TableSpec


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def latest_per_key(df: DataFrame, key: str | Sequence[str],
                   order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """The newest row of every key; ties resolved by the columns of ``order`` in turn."""
    w = Window.partitionBy(*_keys(key)).orderBy(*newest_first(order))
    return (df.withColumn("_rank", F.row_number().over(w))
              .filter(F.col("_rank") == 1)
              .drop("_rank"))


def applicable(changes: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keyless and operation-less rows never reach the ranking window (no NULL hot key)."""
    cond = F.col("operation").isNotNull()
    for k in _keys(key):
        cond = cond & F.col(k).isNotNull()
    return changes.filter(cond)


def state_with_tombstones(changes: DataFrame, spec: TableSpec,
                          order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """Newest event per key, deletes included: the mergeable form of state."""
    return latest_per_key(applicable(changes, spec.key), spec.key, order)


def current_state(changes: DataFrame, spec: TableSpec,
                  order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """Keys whose newest event is not a delete. The delete filter stays above the window."""
    return state_with_tombstones(changes, spec, order).filter(F.col("operation") != OP_DELETE)
