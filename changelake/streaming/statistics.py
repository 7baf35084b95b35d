"""Event analytics kept up to date on a stream (A2-A6): one pass over the records feeds every
statistic, as one running aggregate whose key says which statistic a row belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changelake.functions.rows import emit
from changelake.operators.envelope import parse_images
from changelake.schemas import OP_DELETE, TABLES
from changelake.streaming.running import Running

_KEYS = ("statistic", "table_name", "operation", "language", "repository_id")
_COUNTS = ("events", "opened", "closed", "value_sum", "value_count")
_SCHEMA = "statistic string, table_name string, operation string, language string, repository_id long, " + ", ".join(
    f"{c} long" for c in _COUNTS)


def contributions(records: DataFrame) -> DataFrame:
    """Per record one row for its change statistic and, unless it is set aside or a delete, one
    for the statistic of its table."""
    rows = parse_images(records, TABLES.values(), ("repository_id", "language", "stars", "state", "comments"))
    after, table = F.col("after"), F.col("table_name")
    counted = F.col("reject_reason").isNull() & (F.col("operation") != OP_DELETE)
    is_repository = table == "repositories"
    value = F.when(is_repository, after["stars"]).when(table == "issues", after["comments"])
    one = lambda c: F.when(c, 1).otherwise(0).cast("bigint")
    zero = F.lit(0).cast("bigint")
    none = F.lit(None)
    change = [F.lit("change").alias("statistic"), table.alias("table_name"), F.col("operation"), none.cast("string").alias("language"),
              none.cast("bigint").alias("repository_id"), F.lit(1).cast("bigint").alias("events"),
              *[zero.alias(c) for c in _COUNTS[1:]]]
    own = [F.when(is_repository, "language").otherwise(table).alias("statistic"), none.cast("string").alias("table_name"),
           none.cast("string").alias("operation"), F.when(is_repository, after["language"]).alias("language"),
           F.when(~is_repository, after["repository_id"]).alias("repository_id"), F.lit(1).cast("bigint").alias("events"),
           one(after["state"] == "open").alias("opened"), one(after["state"] == "closed").alias("closed"),
           F.coalesce(value, F.lit(0)).cast("bigint").alias("value_sum"), one(value.isNotNull()).alias("value_count")]
    has_language = ~is_repository | after["language"].isNotNull()
    return emit(rows, [(F.lit(True), change), (counted & has_language, own)])


class EventStatistics:
    """The statistics of the records that a stream has delivered so far, under the column names
    of the batch analytics; unordered."""

    def __init__(self, spark: SparkSession, checkpoint: str, partitions: int | None = None):
        schema = spark.createDataFrame([], _SCHEMA).schema
        self.running = Running(spark, checkpoint, schema, _KEYS, {c: F.sum(c) for c in _COUNTS}, partitions)

    def start(self, records: DataFrame, **options) -> StreamingQuery:
        return self.running.start(contributions(records), **options)

    def _of(self, statistic: str) -> DataFrame:
        return self.running.rows().filter(F.col("statistic") == statistic)

    def change_statistics(self) -> DataFrame:
        """A6; ``table_name`` is NULL exactly where ``operation`` is."""
        return self._of("change").select(F.when(F.col("operation").isNotNull(), F.col("table_name")).alias("table_name"),
                                         "operation", F.col("events").alias("event_count"))

    def language_distribution(self) -> DataFrame:
        """A2."""
        return self._of("language").select(
            "language", F.col("events").alias("repository_count"),
            (F.col("value_sum") / F.nullif(F.col("value_count"), F.lit(0))).alias("average_stars"),
            F.when(F.col("value_count") > 0, F.col("value_sum")).alias("total_stars"))

    def commit_activity(self) -> DataFrame:
        """A3."""
        return self._of("commits").select("repository_id", F.col("events").alias("commit_count"))

    def issue_analytics(self) -> DataFrame:
        """A4."""
        return self._of("issues").select(
            "repository_id", F.col("events").alias("issue_count"), F.col("opened").alias("open_issues"), F.col("closed").alias("closed_issues"),
            (F.col("value_sum") / F.nullif(F.col("value_count"), F.lit(0))).alias("average_comments"))

    def pull_request_analytics(self) -> DataFrame:
        """A5."""
        return self._of("pull_requests").select(
            "repository_id", F.col("events").alias("pull_request_count"), F.col("opened").alias("open_pull_requests"),
            F.col("closed").alias("closed_pull_requests"))
