"""Snapshot diff by range digests (I1): only ranges of keys that changed are read.

A snapshot is stored with its rows dealt into ranges of the key's hash, a folder for each, and
with one digest for each range: the number of rows, the sum of one row hash and the exclusive or
of another (together 128 bits). The digest does not depend on the order of the rows, so two
snapshots of equal rows have equal digests however they were written. ``changes`` compares the
digests and runs ``diff_snapshots`` over the ranges that differ; the scans of both snapshots are
pruned to those folders.

Defined cases: an empty snapshot has no ranges; rows whose key is null have a range of their own
and, as in ``diff_snapshots``, all count as changed where that range differs; repeated rows count
as often as they stand. A range that differs has an equal digest with a probability of about 2**-128.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from changelake.operators.capture import diff_snapshots
from changelake.operators.state import _keys
from changelake.sources import fs

#: Most ranges of a snapshot, and so the most digests that reach the driver.
MAX_RANGES = 1 << 16
RANGE = "_range"
DIGEST = ("rows", "total", "parity")


def _hash(cols: Sequence[str], salt: int) -> Column:
    """Hash of a row. Null columns leave xxhash64 unchanged, so which ones are null goes in too."""
    parts = [p for c in cols for p in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(F.lit(salt), *parts)


def range_of(key: str | Sequence[str], ranges: int) -> Column:
    """Number of a row's range; -1 where the key is null."""
    keys = _keys(key)
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    return F.when(null, -1).otherwise(F.pmod(F.xxhash64(*keys), F.lit(ranges))).cast("int")


def digests(ranged: DataFrame) -> DataFrame:
    """``_range, rows, total, parity`` of rows that carry ``_range``. Combined map-side."""
    cols = sorted(c for c in ranged.columns if c != RANGE)
    return ranged.groupBy(RANGE).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(_hash(cols, 1).cast("decimal(20,0)")).alias("total"),
        F.bit_xor(_hash(cols, 2)).alias("parity"))


def store(snapshot: DataFrame, key: str | Sequence[str], path: str, ranges: int = 1024) -> None:
    """Write ``snapshot`` below ``path`` with its digests, which are written last: a snapshot
    without them is not finished. Ranges are even, as keys are unique; AQE splits large ones."""
    if not 0 < ranges <= MAX_RANGES:
        raise ValueError(f"ranges must be from 1 to {MAX_RANGES}")
    spark = snapshot.sparkSession
    rows = os.path.join(path, f"rows-{ranges}")
    fs.delete(spark, os.path.join(path, "digests"))
    (snapshot.withColumn(RANGE, range_of(key, ranges)).hint("rebalance", RANGE)
     .write.mode("overwrite").partitionBy(RANGE).parquet(rows))
    ranged = spark.read.schema(snapshot.withColumn(RANGE, F.lit(0)).schema).parquet(rows)
    digests(ranged).withColumn("ranges", F.lit(ranges)).coalesce(1).write.parquet(os.path.join(path, "digests"))


def _ranges(spark: SparkSession, path: str) -> tuple[int | None, DataFrame]:
    found = spark.read.parquet(os.path.join(path, "digests"))
    first = found.select("ranges").first()
    return (first[0] if first else None), found


def changed_ranges(spark: SparkSession, old: str, new: str) -> list[int]:
    """Numbers of the ranges whose digests differ, at most ``MAX_RANGES`` + 1 integers."""
    (n_old, a), (n_new, b) = _ranges(spark, old), _ranges(spark, new)
    if n_old and n_new and n_old != n_new:
        raise ValueError("the snapshots have different numbers of ranges")
    a, b = (d.select(RANGE, F.struct(*DIGEST).alias(name)) for d, name in ((a, "a"), (b, "b")))
    return sorted(r[0] for r in a.join(b, RANGE, "full").where(~F.col("a").eqNullSafe(F.col("b"))).select(RANGE).collect())


def _read(spark: SparkSession, path: str, schema: StructType, wanted: list[int]) -> DataFrame:
    """The rows of the wanted ranges, by a filter on the folder column: no other file is read."""
    folder = next((c for c in fs.children(spark, path) if c.startswith("rows-")), None)
    if folder is None:
        raise ValueError(f"no snapshot at {path}")
    df = spark.read.schema(StructType([*schema.fields, StructField(RANGE, IntegerType())])).parquet(os.path.join(path, folder))
    return df.where(F.col(RANGE).isin(wanted)).drop(RANGE)


def changes(spark: SparkSession, old: str, new: str, schema: StructType, key: str | Sequence[str]) -> DataFrame:
    """``diff_snapshots`` of two stored snapshots with the columns ``schema``."""
    wanted = changed_ranges(spark, old, new)
    a, b = (_read(spark, p, schema, wanted) for p in (old, new))
    return diff_snapshots(a, b, key)
