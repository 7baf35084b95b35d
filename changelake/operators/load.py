"""Loading flat records into tables as set operations.

* ``resolve_parent`` (L1, L2): natural key -> surrogate key with one left join; the
  accepted and the rejected rows are the two halves of that join.
* ``upsert`` (L3-L6): insert new keys, refresh only the spec's mutable columns of
  existing ones.
* ``dedupe_batch`` (L8): the last of several rows for one key wins, by explicit order.
* ``commit_version`` (L7): write a new version folder, then add a commit marker.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.operators.state import latest_per_key
from changelake.schemas import TableSpec
from changelake.sources import fs


def resolve_parent(batch: DataFrame, parents: DataFrame, name_col: str, parent_name: str,
                   parent_key: str) -> tuple[DataFrame, DataFrame]:
    """L1/L2: add ``parent_key`` to ``batch`` by matching ``name_col`` to ``parent_name``.

    The lookup keeps one key per name (the largest), as a name -> id map does. Spark picks
    the join by measured bytes; AQE splits a hot parent name. Returns ``(accepted,
    rejected)``; rejected rows keep their columns and lack the key.
    """
    lookup = (parents.groupBy(parent_name).agg(F.max(parent_key).alias(parent_key))
              .withColumnRenamed(parent_name, "_parent_name"))
    joined = batch.join(lookup, batch[name_col] == lookup["_parent_name"], "left").drop("_parent_name")
    accepted = joined.filter(F.col(parent_key).isNotNull())
    rejected = joined.filter(F.col(parent_key).isNull()).drop(parent_key)
    return accepted, rejected


def dedupe_batch(batch: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``order`` (newest first wins); rows without a key
    have no place in a table and are left to the caller's rejects."""
    return latest_per_key(batch.filter(F.col(key).isNotNull()), key, order)


def upsert(target: DataFrame, batch: DataFrame, spec: TableSpec) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO UPDATE SET <mutable> = batch.<mutable>``.

    ``batch`` must be unique on the key (see ``dedupe_batch``); its rows without a key are
    ignored. One plan at every size: existing rows are merged by a left join with the batch
    (which Spark broadcasts if it measures small, so the target need not move), and rows of
    new keys follow from an anti join against the target's keys.
    """
    cols, key = target.columns, spec.key
    mutable = set(spec.mutable_columns()) - {key}
    batch = batch.filter(F.col(key).isNotNull())
    fresh = batch.select(F.col(key).alias("_key"), F.lit(True).alias("_in"),
                         *[F.col(c).alias(f"_new_{c}") for c in cols if c in mutable])
    merged = target.join(fresh, target[key] == fresh["_key"], "left").select(*[
        (F.when(F.col("_in"), F.col(f"_new_{c}")).otherwise(target[c]) if c in mutable else target[c]).alias(c)
        for c in cols])
    return merged.unionByName(batch.join(target.select(key), key, "left_anti").select(*cols))


def _newest_commit(spark, table_root: str):
    """(seq, version, path) of the newest complete commit marker, or None."""
    folder = os.path.join(table_root, "_commits")
    if not fs.exists(spark, folder):
        return None
    markers = spark.read.schema("value string").option("recursiveFileLookup", "true").text(folder)
    part = F.split("value", "\t")
    newest = markers.select(part[0].cast("long").alias("seq"), part[1].cast("long").alias("version"), part[2].alias("path")) \
        .agg(F.max(F.struct("seq", "version", "path")).alias("m")).first()
    return newest["m"]


def commit_version(df: DataFrame, table_root: str, version: int) -> str:
    """Write ``df`` to a folder of its own, then add a commit marker (all or nothing).

    Neither folders nor markers are ever rewritten, so ``df`` may read the table it
    replaces, a version may be committed again (a repeated load), and a failure at any
    point leaves readers on the previous complete commit. A version below the newest one
    is refused.
    """
    spark = df.sparkSession
    newest = _newest_commit(spark, table_root)
    if newest is not None and version < newest["version"]:
        raise ValueError(f"version {version} is below the committed version {newest['version']} of {table_root}")
    seq = 1 if newest is None else newest["seq"] + 1
    path = os.path.join(table_root, f"v{version:010d}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    marker = os.path.join(table_root, "_commits", f"{seq:010d}-{uuid.uuid4().hex[:12]}")
    spark.createDataFrame([(f"{seq}\t{version}\t{path}",)], "value string").coalesce(1).write.text(marker)
    return path


def has_version(spark, table_root: str) -> bool:
    """Whether any version of the table has been committed."""
    return _newest_commit(spark, table_root) is not None


def read_current(spark, table_root: str) -> DataFrame:
    """The newest committed version."""
    newest = _newest_commit(spark, table_root)
    if newest is None:
        raise FileNotFoundError(f"no committed version under {table_root}")
    return spark.read.parquet(newest["path"])
