"""Path checks through the session's Hadoop filesystem (works for any cluster store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in the folder ``path``; none if it does not exist."""
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes below ``path``; 0 if it does not exist."""
    p, fs = _path(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, such as a commit marker."""
    p, fs = _path(spark, path)
    fs.create(p, True).close()


def mkdirs(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.mkdirs(p)


def publish(spark: SparkSession, staging: str, path: str) -> None:
    """Move a finished folder to where readers look, in one rename. A folder that is already
    there stays: the same work was published before."""
    src, fs = _path(spark, staging)
    dst, _ = _path(spark, path)
    if fs.exists(dst):
        fs.delete(src, True)
        return
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"cannot move {staging} to {path}")


def delete(spark: SparkSession, path: str) -> None:
    """Remove ``path`` recursively if it exists."""
    p, fs = _path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)
