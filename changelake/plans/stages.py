"""The reference's entry points as Spark jobs, runnable with spark-submit.

    spark-submit -m changelake.plans.stages <job> [options]

    stream   records (Kafka, or a landing folder) -> per-table logs, dead letters,
             incremental state and the raw archive              (S1, S2, C*, K1, K3, D6)
    compact  small files of the per-table logs -> few large ones (K1)
    state    per-table logs -> current state Parquet            (S3, D1-D5, K2)
    events   per-table logs -> event-level analytics Parquet     (A1-A6, K2)
    final    current state -> repository analytics Parquet      (S4, F1-F8, K2)
    quality  current state (+ expectations) -> check rows       (Q1-Q5)
    raw      raw JSON documents -> flat records per table       (S5, S6, T1-T11, K4);
             with --incremental only the pages that landed since
    load     flat records -> versioned tables by keyed upsert   (S9, L1-L8)

Folders (``--root``): ``log/<table>``, ``state/<table>``, ``analytics/<name>``,
``analytics_final``, ``archive``, ``flat/<table>``, ``tables/<table>``, ``pending/<table>``,
``rejects/<stage>/<table>``
and ``_checkpoints`` (of the stream).
"""

from __future__ import annotations

import argparse
import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changelake.operators import analytics, entity, load, quality, redrive, state, transform
from changelake.schemas import (
    EVENT_ORDER, EXPECTATIONS_SCHEMA, TABLES, UPSERT_SPECS, TableSpec,
)
from changelake.session import build_session, cluster_conf, session_like, settings
from changelake.sources import fs, readers
from changelake.sources.writers import materialize, run_concurrently, write_all, write_parquet
from changelake.streaming.change_log import TARGET, ChangeLog
from changelake.streaming.jobs import start_normalise
from changelake.streaming.state_stream import IncrementalState


def _p(root: str, *parts: str) -> str:
    return os.path.join(root, *parts)


# ------------------------------------------------------------------------------- stream
def stream_job(spark: SparkSession, records: DataFrame, root: str,
               specs: Sequence[TableSpec] = tuple(TABLES.values()), incremental_state: bool = True,
               archive: bool = True, available_now: bool = False,
               processing_time: str = "5 seconds", compact_every: int | None = 64) -> list[StreamingQuery]:
    """Normalise, archive and fold into state with one streaming query (each record is
    read once); returns the started queries."""
    chk = _p(root, "_checkpoints")  # under the root itself: no two roots share one
    states = None
    if incremental_state:
        states = {s.name: IncrementalState(spark, s, _p(root, "live_state", s.name), compact_every=compact_every)
                  for s in specs}
    return [start_normalise(records, specs, _p(root, "log"), _p(chk, "normalise"), states,
                            processing_time, available_now,
                            archive_root=_p(root, "archive") if archive else None)]


# -------------------------------------------------------------------------------- batch
def read_log(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """A table's log as written by ``stream_job``: its committed batches, compacted or not."""
    schema = spec.normalised_schema()
    return ChangeLog(spark, _p(root, "log")).read(spec.name, schema).select(*schema.fieldNames())


def compact_job(spark: SparkSession, root: str, specs: Sequence[TableSpec] = tuple(TABLES.values()),
                target_bytes: int = TARGET) -> dict[str, int]:
    """K1: rewrite the small files of each table's log; the batches of each that were."""
    log = ChangeLog(spark, _p(root, "log"))
    return run_concurrently({s.name: (lambda s=s: log.compact(s.name, s.normalised_schema(), target_bytes)) for s in specs})


def state_job(spark: SparkSession, root: str, specs: Sequence[TableSpec] = tuple(TABLES.values()),
              orders: Mapping[str, Sequence[str]] | None = None) -> dict[str, str]:
    """Current state of every table from its whole log, written as Parquet (the tables'
    jobs are independent and run concurrently)."""
    frames = {}
    for spec in specs:
        order = (orders or {}).get(spec.name, EVENT_ORDER)
        frames[_p(root, "state", spec.name)] = state.current_state(read_log(spark, root, spec), spec, order)
    write_all(frames)
    return {spec.name: _p(root, "state", spec.name) for spec in specs}


def read_state(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {n: readers.parquet(spark, _p(root, "state", n)) for n in TABLES}


def read_dead_letters(spark: SparkSession, root: str) -> DataFrame | None:
    """Dead letters that no re-drive has repaired; None if there is no folder of them."""
    path, done = _p(root, "log", "_dead_letters"), _p(root, "log", "_redriven")
    if not fs.exists(spark, path):
        return None
    dead = readers.parquet(spark, path)
    return redrive.still_open(dead, readers.parquet(spark, done)) if fs.children(spark, done) else dead


def redrive_job(spark: SparkSession, root: str, rules: Mapping[str, redrive.Rule], corrections: DataFrame | None = None,
                specs: Sequence[TableSpec] = tuple(TABLES.values())) -> int:
    """Append repaired dead letters to the logs, as batch -n of re-drive n, and return n.

    The names of the repaired ones are published last and commit the re-drive: one that stopped
    before is done again under the same number and replaces its folders. Dead letters that are
    named there are neither counted nor re-driven again. ``state_job`` then reads them in order.
    """
    n = len(fs.children(spark, _p(root, "log", "_redriven"))) + 1
    dead = read_dead_letters(spark, root)
    if dead is None:
        return n - 1
    # the repairs are made once: every table and the commit read them from files
    records = materialize(redrive.repaired(dead, rules, corrections), "repaired")
    rows, entered = redrive.redrive(records, specs)
    write_all({_p(root, "log", name, f"batch_id=-{n}"): df for name, df in rows.items()
               if fs.exists(spark, _p(root, "log", name))})
    staging = _p(root, "log", f"_staged-{uuid.uuid4().hex}")
    write_parquet(entered, staging)
    fs.publish(spark, staging, _p(root, "log", "_redriven", f"attempt={n}"))
    return n


def event_analytics(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    logs = {n: read_log(spark, root, s) for n, s in TABLES.items()}
    # Change statistics count every record, the set-aside ones included (a tombstone is
    # an event with a NULL operation), as the reference's statistics do.
    dead = read_dead_letters(spark, root)
    every = {n: df.select("operation") for n, df in logs.items()}
    if dead is not None:
        every = {n: df.unionByName(dead.filter(F.col("table_name") == n).select("operation"))
                 for n, df in every.items()}
    return {
        "repository_popularity": analytics.event_popularity(logs["repositories"]),
        "language_distribution": analytics.language_distribution(logs["repositories"]),
        "commit_activity": analytics.commit_activity(logs["commits"]),
        "issue_analytics": analytics.issue_analytics(logs["issues"]),
        "pull_request_analytics": analytics.pull_request_analytics(logs["pull_requests"]),
        "cdc_statistics": analytics.change_statistics(every),
    }


def event_analytics_job(spark: SparkSession, root: str) -> dict[str, str]:
    frames = event_analytics(spark, root)
    write_all({_p(root, "analytics", n): df for n, df in frames.items()})
    return {n: _p(root, "analytics", n) for n in frames}


def final_analytics(spark: SparkSession, root: str) -> DataFrame:
    s = read_state(spark, root)
    return entity.repository_analytics(s["repositories"], s["commits"], s["issues"], s["pull_requests"])


def final_analytics_job(spark: SparkSession, root: str) -> str:
    path = _p(root, "analytics_final")
    write_parquet(final_analytics(spark, root), path)
    return path


def quality_job(spark: SparkSession, root: str, expectations: DataFrame | None = None,
                raise_on_failure: bool = False) -> DataFrame:
    s = read_state(spark, root)
    report = quality.quality_report(
        {n: (s[n], TABLES[n].key) for n in TABLES}, expectations,
        parent=("repositories", "repository_id"),
        references={"commits": "repository_id", "issues": "repository_id",
                    "pull_requests": "repository_id"})
    if raise_on_failure:
        quality.raise_on_failure(report)
    return report


# ---------------------------------------------------------------------- raw and load
RAW_TRANSFORMS = {
    "repositories": transform.repositories,
    "commits": transform.commits,
    "issues": transform.issues,
    "pull_requests": transform.pull_requests,
}


def parent_names(spark: SparkSession, root: str) -> DataFrame | None:
    """File stems of the repository list with the full name that each stands for, and how many
    it could stand for; None before the first list."""
    path = _p(root, "flat", "repositories")
    if not fs.exists(spark, path):
        return None
    return (readers.flat_table(spark, path, UPSERT_SPECS["repositories"])
            .groupBy(readers.file_stem_of(F.col("full_name")).alias("repository"))
            .agg(F.min("full_name").alias("_full_name"), F.count_distinct("full_name").alias("_names")))


def transform_files(files: DataFrame, name: str, names: DataFrame | None) -> DataFrame:
    """Raw files of one table -> flat rows, ``_file`` and ``_reject`` in one pass, which parses a
    page once. ``_reject``: null, or ``source_file, doc, reject_reason`` of a row set aside.

    A child carries its parent's real ``owner/name``, found in the repository list by the
    file's name (a name that fits none stays as it is, for the load to resolve or hold). Pages
    that do not parse, rows without a key, and children whose file name fits several
    repositories are rejects.
    """
    reason, repository = F.col("reject_reason"), readers.parent_of_file()
    if name != "repositories" and names is not None:
        # a page is named before it is parsed: it is one row then, not one for each document
        files = files.withColumn("repository", repository).join(names, "repository", "left").drop("repository")
        pages = readers.pages_of(files, *names.columns[1:])
        reason = F.coalesce(reason, F.when(F.col("_names") > 1, F.lit("ambiguous_parent")))
        repository = F.coalesce("_full_name", repository)
    else:
        pages = readers.pages_of(files)
    docs = pages.select("source_file", F.col("doc").alias("_doc"), F.col("file_id").alias("_file"), reason.alias("_reason"),
                        F.when(reason.isNull(), F.col("doc")).alias("doc"), repository.alias("repository"))
    carried = ("source_file", "_doc", "_reason", "_file")
    if name == "issues":  # what is set aside is no pull request: it has not been judged
        docs = docs.filter(~transform.is_pull_request())
        rows = transform.issues(docs, *carried, keep_pull_requests=True)
    else:
        rows = RAW_TRANSFORMS[name](docs, *carried)
    flat = [c for c in rows.columns if c not in carried]
    keyless = (F.col("repository") if "repository" in flat else F.lit(None).cast("string")).alias("source_file")
    reject = (F.when(F.col("_reason").isNotNull(), F.struct("source_file", F.col("_doc").alias("doc"), F.col("_reason").alias("reject_reason")))
              .when(F.col(UPSERT_SPECS[name].key).isNull(),
                    F.struct(keyless, F.to_json(F.struct(*flat)).alias("doc"), F.lit("no_key").alias("reject_reason"))))
    return rows.select(*flat, "_file", reject.alias("_reject"))


def _flat_and_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return rows.filter("_reject is null").drop("_file", "_reject"), rows.filter("_reject is not null").select("_reject.*")


def raw_job(spark: SparkSession, root: str, by_parent: bool = False) -> dict[str, str]:
    """``raw/repositories`` (one object per file) and ``raw/<child>`` (one array per
    parent, see ``readers.raw_pages``) -> ``flat/<table>`` and ``rejects/raw/<table>``, all
    pages at once. ``by_parent``: children lie in a folder for each parent (K4), so a
    load of one parent reads that folder only."""
    out = {}
    for name in RAW_TRANSFORMS:
        src = _p(root, "raw", name)
        if not fs.exists(spark, src):
            continue
        rows = transform_files(readers.raw_files(spark, src), name, parent_names(spark, root))
        flat, bad = _flat_and_rejects(materialize(rows, f"judged-{name}", compression="zstd"))
        out[name] = _p(root, "flat", name)
        write_parquet(flat, out[name], ("repository",) if by_parent and "repository" in flat.columns else ())
        write_parquet(bad, _p(root, "rejects", "raw", name))
    return out


#: Opening a page costs about as much as reading so many bytes of one.
OPEN_COST = 1 << 16


def raw_stream(spark: SparkSession, root: str, name: str, max_files_per_trigger: int | None = None,
               available_now: bool = False, processing_time: str = "60 seconds") -> StreamingQuery:
    """S5/S6/T*: the pages of one table as they land. Each page is transformed once, across
    restarts; a micro-batch adds one folder of flat rows and one of rejects, each renamed into
    place whole. The folders are named after their files, so a repeated micro-batch adds nothing.

    Nothing is cached: a micro-batch may be far larger than memory. Its pages are parsed once, to
    a staging folder of rows that are packed and far smaller than the pages."""

    def land(batch: DataFrame, batch_id: int) -> None:
        judged = _p(root, "_staging", f"{name}-{uuid.uuid4().hex}")
        transform_files(batch, name, parent_names(spark, root)).write.option("compression", "zstd").parquet(judged)
        rows = spark.read.parquet(judged)
        files = rows.select("_file").distinct().agg(F.bit_xor("_file"), F.count("*")).first()
        if files[1]:
            folder = f"pages={files[1]}-{files[0] & (1 << 64) - 1:016x}"
            flat, bad = _flat_and_rejects(rows)
            for part, path in ((bad, _p(root, "rejects", "raw", name)), (flat, _p(root, "flat", name))):
                staging = _p(path, f"_staging-{uuid.uuid4().hex}")
                part.write.option("compression", "zstd").parquet(staging)
                fs.publish(spark, staging, _p(path, folder))
        fs.delete(spark, judged)

    pages = readers.raw_files(session_like(spark, {
        # a file source asks the session that made it: folders are listed by a few tasks for each
        # core, not by one task for each folder, and a task reads many small pages
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism),
        "spark.sql.files.openCostInBytes": str(OPEN_COST),
    }), _p(root, "raw", name), True, max_files_per_trigger)
    w = pages.writeStream.foreachBatch(land).option("checkpointLocation", _p(root, "_checkpoints", "raw", name))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)).start()


def _flat(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """Flat records to load: of the raw job, else processed JSON files (S9); None without any."""
    spec = UPSERT_SPECS[name]
    if fs.exists(spark, _p(root, "flat", name)):
        return readers.flat_table(spark, _p(root, "flat", name), spec)
    if fs.exists(spark, _p(root, "processed", name)):
        return readers.flat_records(spark, _p(root, "processed", name), spec.row_schema)
    return None


#: A broadcast passes through the driver, and a load joins with its parents and keys a dozen times:
#: sides that grow with the tables are merged at every size.
NO_BROADCASTS = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def load_job(spark: SparkSession, root: str, version: int) -> dict[str, DataFrame]:
    """Flat records -> tables: resolve the parent, upsert by key with the table's mutable
    columns, and commit a new version. May be repeated with one version.

    A child whose parent is not there yet waits in ``pending/<table>`` and is resolved again by
    each later load, until it arrives or a newer row of its key replaces it. What a load leaves
    pending, and rows without a key, are written to ``rejects/load/<table>`` with a reason and
    returned."""
    with settings(spark, NO_BROADCASTS):
        return _load(spark, root, version)


def _load(spark: SparkSession, root: str, version: int) -> dict[str, DataFrame]:
    rejects = {}
    tables = _p(root, "tables")

    def current(folder: str, name: str, like: DataFrame) -> DataFrame:
        if load.has_version(spark, _p(root, folder, name)):
            return load.read_current(spark, _p(root, folder, name))
        return spark.createDataFrame([], like.schema)   # first load: empty target

    def newest(batch: DataFrame, key: str, time: str) -> DataFrame:
        # equal times: the row's content decides, so the winner never depends on file order
        rows = batch.withColumn("_tie", F.xxhash64(*batch.columns))
        return load.dedupe_batch(rows, key, [time, "_tie"]).drop("_tie")

    repos = newest(_flat(spark, root, "repositories"), "repository_id", "updated_at")
    target = current("tables", "repositories", repos)
    merged = load.upsert(target, repos.select(*target.columns), UPSERT_SPECS["repositories"])
    load.commit_version(merged, _p(tables, "repositories"), version)
    parents = load.read_current(spark, _p(tables, "repositories")).select("repository_id", "full_name")
    for name in ("commits", "issues", "pull_requests"):
        flat = _flat(spark, root, name)
        if flat is None:
            continue
        spec = UPSERT_SPECS[name]
        waiting = current("pending", name, flat)
        rows = newest(flat.unionByName(waiting), spec.key, "updated_at" if "updated_at" in flat.columns else "commit_date")
        acc, rej = load.resolve_parent(rows, parents, "repository", "full_name", "repository_id")
        # a name taken from a file stands for the one repository whose full name gives it
        stems = (parents.groupBy(readers.file_stem_of(F.col("full_name")).alias("stem"))
                 .agg(F.max("repository_id").alias("repository_id"), F.count_distinct("full_name").alias("n")).filter("n = 1"))
        by_stem, rej = load.resolve_parent(rej, stems, "repository", "stem", "repository_id")
        batch = acc.unionByName(by_stem).drop("repository")
        key_spec = TableSpec(name, spec.key, batch.schema, tuple(c for c in spec.mutable_columns()
                                                                if c in batch.columns) + ("repository_id",))
        target = current("tables", name, batch)
        merged = load.upsert(target, batch.select(*target.columns), key_spec)
        load.commit_version(merged, _p(tables, name), version)
        load.commit_version(rej, _p(root, "pending", name), version)
        held = load.read_current(spark, _p(root, "pending", name)).withColumn("reject_reason", F.lit("no_parent"))
        keyless = flat.filter(F.col(spec.key).isNull()).withColumn("reject_reason", F.lit("no_key"))
        write_parquet(held.unionByName(keyless), _p(root, "rejects", "load", name))
        rejects[name] = readers.parquet(spark, _p(root, "rejects", "load", name))
    return rejects


# --------------------------------------------------------------------------------- CLI
def main(argv: Sequence[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="changelake.plans.stages")
    ap.add_argument("job", choices=["stream", "compact", "state", "events", "final", "quality", "raw", "load"])
    ap.add_argument("--root", required=True)
    ap.add_argument("--kafka", help="bootstrap servers; otherwise --landing is read")
    ap.add_argument("--topics", default=",".join(s.topic() for s in TABLES.values()))
    ap.add_argument("--landing", help="folder of Kafka-shaped Parquet records")
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--expectations", help="CSV with table,expected")
    ap.add_argument("--version", type=int, default=1)
    ap.add_argument("--incremental", action="store_true", help="raw: transform new pages only")
    ap.add_argument("--input-bytes", type=int, help="size of the largest input; sizes shuffles")
    ap.add_argument("--cores", type=int, help="total executor cores of the cluster")
    a = ap.parse_args(argv)
    conf = cluster_conf(a.input_bytes, a.cores) if a.input_bytes and a.cores else None
    spark = build_session(app=f"changelake-{a.job}", conf=conf)
    if a.job == "stream":
        if a.kafka:
            records = readers.kafka_stream(spark, a.kafka, a.topics.split(","))
        else:
            records = readers.landing_stream(spark, a.landing)
        queries = stream_job(spark, records, a.root, available_now=a.available_now)
        if a.available_now:
            for q in queries:
                q.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()
    elif a.job == "compact":
        for name, batches in compact_job(spark, a.root).items():
            print(f"{name}: {batches} batches compacted")
    elif a.job == "state":
        state_job(spark, a.root)
    elif a.job == "events":
        event_analytics_job(spark, a.root)
    elif a.job == "final":
        final_analytics_job(spark, a.root)
    elif a.job == "quality":
        exp = (spark.read.schema(EXPECTATIONS_SCHEMA).option("header", "true").csv(a.expectations)
               if a.expectations else None)
        report = quality_job(spark, a.root, exp)
        write_parquet(report, _p(a.root, "quality"))
        quality.raise_on_failure(readers.parquet(spark, _p(a.root, "quality")))
    elif a.job == "raw" and a.incremental:
        for name in RAW_TRANSFORMS:  # the repository list first: children look their parent up in it
            if fs.exists(spark, _p(a.root, "raw", name)):
                raw_stream(spark, a.root, name, available_now=True).awaitTermination()
    elif a.job == "raw":
        raw_job(spark, a.root)
    elif a.job == "load":
        for name, rows in load_job(spark, a.root, a.version).items():
            print(f"{name}: {rows.count()} rows rejected")


if __name__ == "__main__":
    main()
