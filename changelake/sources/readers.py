"""Readers (S1-S9). Every reader takes an explicit schema; none infers.

Directories are read as directories, never through a ``*.json`` glob, so the commit log
of a file sink (such as ``start_archive``) decides which of its files count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changelake.schemas import KAFKA_SCHEMA, TableSpec


def _kafka_columns(df: DataFrame) -> DataFrame:
    """Record projection; ``key`` and ``value`` bytes to text."""
    return df.select(
        "topic", "partition", "offset", "timestamp",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def kafka_stream(spark: SparkSession, bootstrap: str, topics: Sequence[str],
                 starting_offsets: str = "earliest", **options: str) -> DataFrame:
    """One subscription to every topic (needs the Kafka connector on the classpath)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap)
              .option("subscribe", ",".join(topics))
              .option("startingOffsets", starting_offsets))
    for k, v in options.items():
        reader = reader.option(k, v)
    return _kafka_columns(reader.load())


def landing_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                   max_files_per_trigger: int | None = None, **options: str) -> DataFrame:
    """S1 stand-in: Kafka-shaped records from a landing folder, as a stream. ``options``: of the source."""
    reader = spark.readStream.schema(KAFKA_SCHEMA).format(fmt).options(recursiveFileLookup="true", **options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def change_log(spark: SparkSession, path: str, spec: TableSpec, fmt: str = "parquet") -> DataFrame:
    """S3: a table's normalised change log, with its explicit schema."""
    return spark.read.schema(spec.normalised_schema()).format(fmt).load(path)


def parquet(spark: SparkSession, path: str) -> DataFrame:
    """S4."""
    return spark.read.parquet(path)


def _page_files(spark: SparkSession, path: str, max_files_per_trigger: int | None, stream: bool) -> DataFrame:
    reader = (spark.readStream if stream else spark.read).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.text(path, wholetext=True)  # as an argument: its default overrides the option


def raw_files(spark: SparkSession, path: str, stream: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw JSON files, plain or packed -> ``source_file, file_id, value``, a row for each
    with its whole text.

    A page of a parent is a file ``owner_name.json`` or lies in a folder
    ``repository=owner_name``; ``source_file`` is ``owner_name.json`` either way.
    As a stream, each file is read once, however often the query is restarted.
    """
    meta = F.col("_metadata")
    folder = F.regexp_extract(meta["file_path"], "/repository=([^/]+)/[^/]*$", 1)
    return (_page_files(spark, path, max_files_per_trigger, stream)
            .select(F.when(folder != "", F.concat(folder, F.lit(".json"))).otherwise(meta["file_name"]).alias("source_file"),
                    F.xxhash64(meta["file_path"], meta["file_modification_time"]).alias("file_id"), F.trim("value", F.lit(" \t\r\n")).alias("value")))


def pages_of(files: DataFrame, *carried: str) -> DataFrame:
    """``source_file, position, doc, reject_reason, file_id`` of ``raw_files``, and the short
    columns ``carried`` beside each document.

    A file holds either one object or an array of objects. Each file is one fetched
    page (a bounded size), read whole; arrays are exploded into their elements, each
    kept as its own JSON text so that key *presence* can still be tested. A page that
    does not parse is one row with its whole text and a reason, never silently lost.
    """
    # with Jackson's leniency a cut-off array can still yield its first elements
    whole = F.when(F.col("value").startswith("["), F.col("value").endswith("]")) \
             .otherwise(F.col("value").startswith("{") & F.col("value").endswith("}"))
    docs = F.when(F.col("value").startswith("["), F.from_json("value", "array<string>")).otherwise(F.array("value"))
    good = F.when(whole, docs)
    # a page is parsed and judged before it is exploded: only its documents leave the generator,
    # since a page's text or verdict beside each of them would cost the square of its length
    pages = files.select("source_file", "file_id", *carried, F.when(good.isNull(), F.lit("malformed_page")).alias("reject_reason"),
                         F.coalesce(good, F.array("value")).alias("_docs"))
    rows = pages.select("source_file", "file_id", *carried, "reject_reason", F.posexplode("_docs").alias("position", "doc"))
    return rows.select("source_file", "position", "doc", "reject_reason", "file_id", *carried)


def raw_pages(spark: SparkSession, path: str, stream: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """The ``pages_of`` the ``raw_files``."""
    return pages_of(raw_files(spark, path, stream, max_files_per_trigger))


def raw_documents(spark: SparkSession, path: str) -> DataFrame:
    """The parsed documents of ``raw_pages``: ``source_file, doc``."""
    return raw_pages(spark, path).filter("reject_reason is null").select("source_file", "doc")


def parent_of_file(source_file: str = "source_file") -> F.Column:
    """``owner_name.json`` -> the file stem, to join on ``replace(full_name, '/', '_')``."""
    return F.regexp_replace(F.col(source_file), r"\.json$", "")


def file_stem_of(full_name: F.Column) -> F.Column:
    """Naming rule of the landing files: ``owner/name`` -> ``owner_name``."""
    return F.replace(full_name, F.lit("/"), F.lit("_"))


def flat_records(spark: SparkSession, path: str, schema: StructType, lines: bool = False) -> DataFrame:
    """Processed flat records. A file is one object or an array of them, over any lines;
    with ``lines`` it holds one object for each line, and Spark splits it."""
    return spark.read.schema(schema).option("multiLine", str(not lines).lower()).option("recursiveFileLookup", "true").json(path)


def flat_table(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Flat records as the raw job writes them, also a folder for each parent or batch of pages."""
    return spark.read.schema(spec.row_schema).parquet(path).select(*spec.columns)
