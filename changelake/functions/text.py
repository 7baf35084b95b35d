"""Small null-safe expressions used by the raw-document transforms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def first_non_empty(a: Column | str, b: Column | str) -> Column:
    """``a`` unless it is NULL or the empty string, else ``b``."""
    return F.coalesce(F.nullif(_c(a), F.lit("")), _c(b))


def field_of_each(arr: Column | str, name: str) -> Column:
    """``[x.name for x in arr]``, with a missing array giving ``[]``."""
    return F.coalesce(F.transform(_c(arr), lambda x: x[name]), F.array().cast("array<string>"))


def string_array_or_empty(arr: Column | str) -> Column:
    """A missing array of strings becomes ``[]``."""
    return F.coalesce(_c(arr), F.array().cast("array<string>"))


def to_timestamp_any(x: Column | str) -> Column:
    """ISO-8601 text, epoch milliseconds or epoch microseconds to a timestamp; else NULL."""
    s = _c(x).cast("string")
    n = s.try_cast("bigint")
    iso = F.try_to_timestamp(s)
    from_number = F.when(F.abs(n) >= F.lit(10**14), F.timestamp_micros(n)).otherwise(F.timestamp_millis(n))
    return F.when(n.isNotNull(), from_number).otherwise(iso)


def leading_int(x: Column | str) -> Column:
    """Leading digits of a text as an int (``'3-MEDIUM'`` -> 3); NULL when none."""
    return F.regexp_extract(_c(x), r"^(\d+)", 1).try_cast("int")
