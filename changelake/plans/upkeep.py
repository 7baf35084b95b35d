"""Queries that keep a change log right: fields the schema lacks, dead letters that come back,
and a snapshot diff that reads changed ranges only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.operators import analytics, digest, drift, envelope, redrive, state
from changelake.plans import landing, stages
from changelake.plans import testdata as td
from changelake.plans.catalog import STATE_COLUMNS
from changelake.schemas import REPOSITORIES, TABLES
from changelake.session import scratch_dir, tidy
from changelake.sources import fs
from changelake.streaming.jobs import start_normalise

TRUNCATED, BAD_KEY, NO_OPERATION = 13, 17, 19


def _k() -> Column:
    """The event's k: the stars of the image after a change, null for a delete."""
    return F.coalesce(F.get_json_object("value", "$.after.stars"), F.get_json_object("value", "$.payload.after.stars")).cast("int")


def _edited(recs: DataFrame, edits: list[tuple[Column, Column]]) -> DataFrame:
    """The records, their values edited by each edit in turn whose condition holds for ``_k``."""
    recs = recs.withColumn("_k", _k())
    for condition, value in edits:
        recs = recs.withColumn("value", F.when(F.coalesce(condition, F.lit(False)), value).otherwise(F.col("value")))
    return recs.drop("_k")


def damaged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repository log with faults in place of records: truncated text, a key that is no
    number, and no operation."""
    k = F.col("_k")
    return _edited(td.repository_change_records(spark, sf_dir), [
        (k == TRUNCATED, F.substring("value", 1, 20)),
        (k == BAD_KEY, F.regexp_replace("value", r'"repository_id":(\d+)', '"repository_id":"x$1"')),
        (k == NO_OPERATION, F.regexp_replace("value", r'"op":"[a-z]"', '"op":null'))])


def drifted_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repository log after its producer changed: new fields, stars as text, watchers beyond
    their type, and truncated text."""
    k = F.col("_k")
    add = lambda field: F.regexp_replace("value", F.lit('"archived":'), F.concat(field, F.lit(',"archived":')))
    text = k.cast("string")
    return _edited(td.repository_change_records(spark, sf_dir), [
        (k % 4 == 1, add(F.lit('"visibility":"public"'))),
        (k % 4 == 2, add(F.concat(F.lit('"size":{"kb":'), text, F.lit("}")))),
        (k % 8 == 3, add(F.lit('"rate":1.5'))),
        (k % 8 == 7, add(F.concat(F.lit('"note":'), F.when(k > 50, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(text)))),
        (k % 5 == 0, F.regexp_replace("value", r'"stars":(\d+)', '"stars":"$1"')),
        (k.isNotNull(), F.regexp_replace("value", r'"watchers":7([,}])', '"watchers":3000000007$1')),
        (k == TRUNCATED, F.substring("value", 1, 20))])


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drift.schema_drift(drifted_records(spark, sf_dir), [REPOSITORIES])
    return found.select("table_name", "status", "field", "type", "records", F.unix_millis("first_seen").alias("first_seen_ms"))


def dead_letter_redrive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state after the damaged log was normalised and its dead letters re-driven: keys
    from the records' own keys, all else from the producer's records."""
    root = scratch_dir(spark, "redrive", fresh=True)
    path, (records,) = landing.drops(spark, damaged_records(spark, sf_dir), "damaged", 1)
    landing.drop(records, path)
    for query in stages.stream_job(spark, landing.stream(spark, path, in_pieces=False), root, [REPOSITORIES],
                                   incremental_state=False, archive=False, available_now=True):
        query.awaitTermination()
    upstream = td.repository_change_records(spark, sf_dir).where(_k().isin(TRUNCATED, NO_OPERATION))
    stages.redrive_job(spark, root, {envelope.REJECT_NO_KEY: redrive.key_from_record(REPOSITORIES)},
                       upstream.select(*redrive.POSITION, "value"), [REPOSITORIES])
    return state.current_state(stages.read_log(spark, root, REPOSITORIES), REPOSITORIES).select(*STATE_COLUMNS)


def snapshot_diff_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = td.part_snapshots(spark, sf_dir)
    root = scratch_dir(spark, "snapshots", fresh=True)
    for name, df in (("old", old), ("new", new)):
        digest.store(df, "p_partkey", f"{root}/{name}", ranges=64)
    d = digest.changes(spark, f"{root}/old", f"{root}/new", old.schema, "p_partkey")
    return d.select("p_partkey", "operation", F.col("before.p_retailprice").alias("before_price"),
                    F.col("after.p_retailprice").alias("after_price"), F.col("before.p_name").alias("before_name"),
                    F.col("after.p_name").alias("after_name"))


@tidy
def cdc_statistics_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 from logs that were compacted twice, between drops of a stream that lost its checkpoint
    before the third."""
    path, _ = landing.drops(spark, td.activity_records(spark, sf_dir), "compacted", 3)
    waiting = [landing.waiting(path, k) for k in range(3)]
    root = scratch_dir(spark, "compacted", fresh=True)
    for k in range(3):
        if k == 2:
            path, root_of_stream = scratch_dir(spark, "landing", "compacted-anew", fresh=True), "_anew"
        else:
            root_of_stream = "_checkpoints"
        dropped = landing.move(spark, path, waiting[k])
        start_normalise(landing.stream(spark, path), TABLES.values(), f"{root}/log", f"{root}/{root_of_stream}",
                        available_now=True).awaitTermination()
        fs.delete(spark, dropped)
        if k < 2:
            stages.compact_job(spark, root)
    logs = {n: stages.read_log(spark, root, s).select("operation") for n, s in TABLES.items()}
    dead = stages.read_dead_letters(spark, root)
    return analytics.change_statistics({n: df.unionByName(dead.where(F.col("table_name") == n).select("operation")) for n, df in logs.items()})


UPKEEP_QUERIES = {
    "cdc_statistics_compacted": cdc_statistics_compacted,
    "schema_drift": schema_drift,
    "dead_letter_redrive": dead_letter_redrive,
    "snapshot_diff_digest": snapshot_diff_digest,
}
