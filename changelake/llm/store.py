"""Reading the given tables, and intermediate tables in the session's shared folder."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.session import scratch_dir
from changelake.sources import fs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back. Later stages start from
    these files, so a lost executor costs a re-read and no recomputation."""
    spark = df.sparkSession
    path = scratch_dir(spark, "llm", name, fresh=True)
    df.write.partitionBy(*partition_by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def release(*frames: DataFrame) -> None:
    """Remove stored tables that no later stage reads, and let Spark drop the shuffle files
    of finished stages (it does so once their plans are garbage)."""
    spark = None
    for df in frames:
        spark = df.sparkSession
        fs.delete(spark, df.stored_at)
    if spark is not None:
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Names a text among those of its id: equal rows share a key and, in every operator that
    uses it, their result. Null id and null text have keys too. It has 64 bits, too few to name
    a row among all rows of a large corpus, so rows are joined by id and key together."""
    return F.xxhash64(F.col(id_col).cast("string"), F.col(id_col).isNull(), F.col(text_col), F.col(text_col).isNull())
