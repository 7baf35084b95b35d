"""Ordering of change events for one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from changelake.schemas import EVENT_ORDER


def newest_first(order: Sequence[str] = EVENT_ORDER) -> list[Column]:
    """Descending on each column, NULLs last: the newest event of a key sorts first."""
    return [F.col(c).desc_nulls_last() for c in order]
