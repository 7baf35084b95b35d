"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver's tables (whole) and derives from them; the oracle SQL
for each lives in ``plans.oracles`` under the same name.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.operators import analytics, capture, entity, envelope, load, quality, state
from changelake.operators import transform
from changelake.plans import landing
from changelake.plans import testdata as td
from changelake.schemas import PULL_REQUESTS, REPOSITORIES, TABLES, TableSpec
from changelake.session import scratch_dir, tidy
from changelake.sources.readers import landing_stream
from changelake.sources.writers import materialize_all
from changelake.streaming.jobs import start_archive, start_normalise
from changelake.streaming.running import KeyedState

Query = Callable[[SparkSession, str], DataFrame]

REPO_LOG_COLUMNS = ("offset", "operation", "event_timestamp", "partition", "repository_id", "name",
                    "full_name", "owner", "description", "language", "stars", "forks",
                    "open_issues", "watchers", "archived")
STATE_COLUMNS = tuple(c for c in REPO_LOG_COLUMNS if c != "partition")


# ------------------------------------------------------------------ flagship (F1-F8)
def repository_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity.repository_analytics(
        td.repositories(spark, sf_dir), td.commits(spark, sf_dir),
        td.issues(spark, sf_dir), td.pull_requests(spark, sf_dir))


def top_repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity.top_repositories(td.repositories(spark, sf_dir), 20)


# ------------------------------------------------------------------ parse and state (C*, D*)
def repository_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.normalise(td.repository_change_records(spark, sf_dir), REPOSITORIES)


def envelope_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repository_log(spark, sf_dir).select(*REPO_LOG_COLUMNS)


def current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = repository_log(spark, sf_dir)
    return state.current_state(log, REPOSITORIES).select(*STATE_COLUMNS)


def current_state_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = td.late_and_repeated(td.repository_change_records(spark, sf_dir))
    log = envelope.normalise(recs, REPOSITORIES)
    return state.current_state(log, REPOSITORIES).select(*STATE_COLUMNS)


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = td.faulty_records(td.repository_change_records(spark, sf_dir))
    return envelope.dead_letter_counts(recs, [REPOSITORIES])


def current_state_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults are set aside, so state equals the clean log's state."""
    recs = td.faulty_records(td.repository_change_records(spark, sf_dir))
    log = envelope.normalise(recs, REPOSITORIES)
    return state.current_state(log, REPOSITORIES).select(*STATE_COLUMNS)


# ------------------------------------------------------------------ four-topic stream
#: Row columns that the entity analytics read.
ENTITY_COLUMNS = {
    "repositories": ("full_name", "owner", "language", "stars", "forks", "watchers", "open_issues"),
    "commits": ("repository_id",),
    "issues": ("repository_id", "state", "comments"),
    "pull_requests": ("repository_id", "state"),
}


def _activity_parsed(spark: SparkSession, sf_dir: str, names=tuple(TABLES), columns=None) -> dict[str, DataFrame]:
    """``columns``: wanted row columns by table (beside the key); None: all."""
    recs = td.activity_records(spark, sf_dir, names)
    return {name: envelope.parse_changes(recs, TABLES[name], columns=None if columns is None else columns.get(name, ()))
            for name in names}


def topic_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _activity_parsed(spark, sf_dir, columns={})
    parts = [envelope.accepted(p).select("table_name", "operation") for p in parsed.values()]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.groupBy("table_name", "operation").agg(F.count(F.lit(1)).alias("records"))


def cdc_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.change_statistics(_activity_parsed(spark, sf_dir, columns={}))


def _activity_logs(spark: SparkSession, sf_dir: str, names=tuple(TABLES), columns=None) -> dict[str, DataFrame]:
    return {n: envelope.accepted(p) for n, p in _activity_parsed(spark, sf_dir, names, columns).items()}


def _activity_state(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    logs = _activity_logs(spark, sf_dir, columns=ENTITY_COLUMNS)
    out = {}
    for name, spec in TABLES.items():
        order = td.PR_ORDER if spec is PULL_REQUESTS else state.EVENT_ORDER
        out[name] = state.current_state(logs[name], spec, order)
    return out


def commit_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.commit_activity(_activity_logs(spark, sf_dir, ("commits",), ENTITY_COLUMNS)["commits"])


def event_issue_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.issue_analytics(_activity_logs(spark, sf_dir, ("issues",), ENTITY_COLUMNS)["issues"])


def pull_request_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.pull_request_analytics(
        _activity_logs(spark, sf_dir, ("pull_requests",), ENTITY_COLUMNS)["pull_requests"])


def event_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.event_popularity(repository_log(spark, sf_dir))


def language_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.language_distribution(repository_log(spark, sf_dir))


def cdc_repository_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End to end: four topics -> parse -> current state -> entity analytics."""
    s = _activity_state(spark, sf_dir)
    return entity.repository_analytics(s["repositories"], s["commits"], s["issues"],
                                       s["pull_requests"])


# ------------------------------------------------------------------ quality (Q*)
def quality_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw_log = envelope.parse_changes(
        td.faulty_records(td.repository_change_records(spark, sf_dir)), REPOSITORIES)
    parts = [
        quality.table_profile(td.repositories(spark, sf_dir), "repository_id", "repositories"),
        quality.table_profile(td.commits(spark, sf_dir), "commit_sha", "commits"),
        quality.table_profile(td.issues(spark, sf_dir), "issue_id", "issues"),
        quality.table_profile(td.pull_requests(spark, sf_dir), "pull_request_id", "pull_requests"),
        quality.table_profile(raw_log, "repository_id", "repository_changes"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quality_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children against the *current* repositories of the change log (deleted ones orphan)."""
    parent = state.current_state(repository_log(spark, sf_dir), REPOSITORIES)
    parts = [
        quality.orphan_check(td.commits(spark, sf_dir), parent, "repository_id", "commits"),
        quality.orphan_check(td.issues(spark, sf_dir), parent, "repository_id", "issues"),
        quality.orphan_check(td.pull_requests(spark, sf_dir), parent, "repository_id", "pull_requests"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected state sizes, from the source tables: every customer, every event, the
    orders not deleted (status other than P) and the distinct pull-request ids."""
    def n(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("expected")).select(F.lit(name).alias("table"), "expected")
    li = td.table(spark, sf_dir, "lineitem")
    return (n(td.table(spark, sf_dir, "customer"), "repositories")
            .unionByName(n(td.table(spark, sf_dir, "events"), "commits"))
            .unionByName(n(td.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P"), "issues"))
            .unionByName(n(li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k")).distinct(),
                           "pull_requests")))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    # State is written once and every check reads the files (as the reference's checks
    # read the written state), instead of re-deriving it per check.
    s = materialize_all(_activity_state(spark, sf_dir), "state_")
    tables = {n: (s[n], TABLES[n].key) for n in TABLES}
    return quality.quality_report(
        tables, _expectations(spark, sf_dir), parent=("repositories", "repository_id"),
        references={"commits": "repository_id", "issues": "repository_id",
                    "pull_requests": "repository_id"})


def quality_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdict(quality_report(spark, sf_dir))


def quality_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q4 over tables that fail: repositories without the deleted ones, commits with null
    and repeated keys and with null parents, a wrong count, and an expected table that is absent."""
    e = td.table(spark, sf_dir, "events")
    kind = F.col("event_type")
    sha = (F.when(kind == "error", F.lit(None).cast("string"))
           .when(kind == "purchase", F.concat(F.lit("u"), F.col("user_id").cast("string")))
           .otherwise(F.concat(F.lit("e"), F.col("event_id").cast("string"))))
    commits = e.select(sha.alias("commit_sha"), F.when(kind != "signup", F.col("user_id")).alias("repository_id"))
    repositories = state.current_state(repository_log(spark, sf_dir), REPOSITORIES).select("repository_id")
    expected = [(td.table(spark, sf_dir, "customer"), "repositories"), (e, "commits"), (e.filter(F.lit(False)), "releases")]
    counts = [df.agg(F.count(F.lit(1)).alias("expected")).select(F.lit(name).alias("table"), "expected") for df, name in expected]
    return quality.quality_report(
        {"repositories": (repositories, "repository_id"), "commits": (commits, "commit_sha")},
        counts[0].unionByName(counts[1]).unionByName(counts[2]),
        parent=("repositories", "repository_id"), references={"commits": "repository_id"})


def quality_verdict_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdict(quality_failures(spark, sf_dir))


# ------------------------------------------------------------------ raw transforms (T*)
def raw_repository_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = transform.repositories(td.raw_repository_docs(spark, sf_dir))
    return flat.select("repository_id", "name", "full_name", "owner", "language", "stars", "forks",
                       "open_issues", "watchers", "size", "archived",
                       F.array_join("topics", "|").alias("topics"), "license")


def raw_commit_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform.commits(td.raw_commit_docs(spark, sf_dir))


def raw_issue_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = transform.issues(td.raw_issue_docs(spark, sf_dir))
    return flat.select("issue_id", "issue_number", "repository", "title", "state", "author",
                       "created_at", "closed_at", "comments",
                       F.array_join("labels", "|").alias("labels"), "url")


def raw_pull_request_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = transform.pull_requests(td.raw_pull_request_docs(spark, sf_dir))
    return flat.groupBy("repository").agg(
        F.count(F.lit(1)).alias("pull_requests"),
        F.count_if(F.col("merged_at").isNotNull()).alias("merged"),
        F.count_if(F.col("closed_at").isNotNull()).alias("closed"),
        F.sum("additions").alias("additions"),
        F.sum("review_comments").alias("review_comments"))


def transform_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform.issue_feed_totals(td.raw_issue_docs(spark, sf_dir))


# ------------------------------------------------------------------ load (L*)
def _commit_batch_and_parents(spark: SparkSession, sf_dir: str):
    e = td.table(spark, sf_dir, "events")
    uid = F.col("user_id").cast("string")
    batch = e.select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("commit_sha"),
                     F.concat(F.lit("owner_"), (F.col("user_id") % 7).cast("string"),
                              F.lit("/repo_"), uid).alias("repository"),
                     F.col("event_type").alias("message"))
    parents = state.current_state(repository_log(spark, sf_dir), REPOSITORIES) \
        .select("repository_id", "full_name")
    return load.resolve_parent(batch, parents, "repository", "full_name", "repository_id")


def resolve_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted, _ = _commit_batch_and_parents(spark, sf_dir)
    return accepted.select("commit_sha", "repository_id", "message")


def resolve_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = _commit_batch_and_parents(spark, sf_dir)
    return rejected.select("commit_sha", "repository")


def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target = old parts, batch = new parts; only price and size may change on conflict."""
    old, new = td.part_snapshots(spark, sf_dir)
    spec = TableSpec("part", "p_partkey", old.schema, mutable=("p_retailprice", "p_size"))
    return load.upsert(old, new, spec)


def upsert_all_mutable(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = td.part_snapshots(spark, sf_dir)
    spec = TableSpec("part", "p_partkey", old.schema, mutable=None)
    return load.upsert(old, new, spec)


# ------------------------------------------------------------------ capture (I*, J1)
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = td.part_snapshots(spark, sf_dir)
    d = capture.diff_snapshots(old, new, "p_partkey")
    return d.select("p_partkey", "operation",
                    F.col("before.p_retailprice").alias("before_price"),
                    F.col("after.p_retailprice").alias("after_price"),
                    F.col("before.p_name").alias("before_name"),
                    F.col("after.p_name").alias("after_name"))


def apply_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = td.part_snapshots(spark, sf_dir)
    return capture.apply_changes(old, capture.diff_snapshots(old, new, "p_partkey"), "p_partkey")


def diff_envelope_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1-I4 through the wire: the old snapshot as read events, the diff as c/u/d events,
    both encoded as JSON envelopes on one topic, parsed and folded into state; the
    result must be the new snapshot."""
    old, new = td.part_snapshots(spark, sf_dir)
    spec = TableSpec("part", "p_partkey", old.schema)
    snap = capture.envelope_records(capture.snapshot_changes(old, "p_partkey"), spec.topic(),
                                    "p_partkey", F.lit(1).cast("bigint"), partitions=4)
    diff = capture.envelope_records(capture.diff_snapshots(old, new, "p_partkey"), spec.topic(),
                                    "p_partkey", F.lit(2).cast("bigint"), partitions=4, wrapped=True)
    log = envelope.normalise(snap.unionByName(diff), spec)
    return state.current_state(log, spec).select(*spec.columns)


def upsert_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L8 + L3: the batch holds an older and a newer version of keys; the newer wins
    before the merge, so the result equals the plain upsert of the new snapshot."""
    old, new = td.part_snapshots(spark, sf_dir)
    batch = (new.withColumn("seq", F.lit(2))
             .unionByName(old.withColumn("seq", F.lit(1))))
    latest = load.dedupe_batch(batch, "p_partkey", ["seq"]).drop("seq")
    spec = TableSpec("part", "p_partkey", old.schema, mutable=("p_retailprice", "p_size"))
    return load.upsert(old, latest, spec)


def load_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load a table, repeat the same version, then load a change; each commit reads the
    table it replaces."""
    old, new = td.part_snapshots(spark, sf_dir)
    spec = TableSpec("part", "p_partkey", old.schema, mutable=("p_retailprice", "p_size"))
    root = scratch_dir(spark, "versions", fresh=True)
    load.commit_version(load.upsert(spark.createDataFrame([], old.schema), old, spec), root, 1)
    load.commit_version(load.upsert(load.read_current(spark, root), old, spec), root, 1)
    load.commit_version(load.upsert(load.read_current(spark, root), new, spec), root, 2)
    return load.read_current(spark, root).select(*old.columns)


def newest_per_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 100 most recently updated pull requests of each repository (one listing page)."""
    li = td.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("repository_id"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pull_request_id"),
        td.epoch_millis("l_shipdate").alias("updated_ms"), "l_orderkey", "l_linenumber")
    top = capture.newest_per_parent(
        li, "repository_id",
        [F.col("updated_ms").desc(), F.col("l_orderkey").desc(), F.col("l_linenumber").desc()], 100)
    return top.select("repository_id", "pull_request_id", "updated_ms")


# ------------------------------------------------------------------ streaming
def _land(spark: SparkSession, recs: DataFrame, name: str) -> str:
    """Write records to a fresh landing folder, two files for each core."""
    path = scratch_dir(spark, "landing", name, fresh=True)
    recs.repartition(2 * spark.sparkContext.defaultParallelism).write.parquet(path)
    return path


def _landed(spark: SparkSession, recs: DataFrame, name: str) -> DataFrame:
    """The records as a stream that a handful of micro-batches reads, each by half of the cores."""
    return landing_stream(spark, _land(spark, recs, name),
                          max_files_per_trigger=max(1, spark.sparkContext.defaultParallelism // 2))


def _landed_once(spark: SparkSession, recs: DataFrame, name: str) -> DataFrame:
    """``_landed`` for records that are each named once: encoded to files, then dealt from these."""
    path, _ = landing.drops(spark, recs, name, 1)
    landing.move(spark, path, landing.waiting(path, 0))
    return landing.stream(spark, path)


def stream_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repository log, each record twice plus stale updates, in shuffled
    micro-batches, folded into the state store; must equal the batch current state."""
    recs = td.late_and_repeated(td.repository_change_records(spark, sf_dir))
    st = KeyedState(spark, REPOSITORIES, scratch_dir(spark, "stream", fresh=True), partitions=spark.sparkContext.defaultParallelism)
    st.start(envelope.normalise(_landed(spark, recs, "repositories"), REPOSITORIES), available_now=True).awaitTermination()
    return st.current().select(*STATE_COLUMNS)


def stream_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: the per-table log written by the streaming fan-out equals the batch parse."""
    stream = _landed(spark, td.repository_change_records(spark, sf_dir), "repositories")
    root = scratch_dir(spark, "stream", fresh=True)
    q = start_normalise(stream, TABLES.values(),
                        os.path.join(root, "log"), os.path.join(root, "checkpoint"),
                        available_now=True)
    q.awaitTermination()
    return spark.read.parquet(os.path.join(root, "log", "repositories")).select(*REPO_LOG_COLUMNS)


def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 on the stream: faulty records are set aside per micro-batch with their reason."""
    stream = _landed(spark, td.faulty_records(td.repository_change_records(spark, sf_dir)), "faulty")
    root = scratch_dir(spark, "stream", fresh=True)
    q = start_normalise(stream, [REPOSITORIES],
                        os.path.join(root, "log"), os.path.join(root, "checkpoint"),
                        available_now=True)
    q.awaitTermination()
    dead = spark.read.parquet(os.path.join(root, "log", "_dead_letters"))
    return dead.groupBy("table_name", "reject_reason").agg(F.count(F.lit(1)).alias("records"))


@tidy
def staged_repository_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job sequence: stream (normalise four topics) -> state job -> final analytics."""
    from changelake.plans import stages

    stream = _landed_once(spark, td.activity_records(spark, sf_dir), "activity")
    root = scratch_dir(spark, "stages", fresh=True)
    for q in stages.stream_job(spark, stream, root,
                                 incremental_state=False, archive=False, available_now=True):
        q.awaitTermination()
    stages.state_job(spark, root, orders={"pull_requests": td.PR_ORDER})
    return stages.final_analytics(spark, root)


ARCHIVE_SCHEMA = ("received_at timestamp, topic string, partition int, offset bigint, key string, "
                  "event string, table_name string, received_date date")


@tidy
def stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: every record of the four topics archived once, tombstones included."""
    stream = _landed_once(spark, td.activity_records(spark, sf_dir), "activity")
    root = scratch_dir(spark, "archive", fresh=True)
    out = os.path.join(root, "out")
    q = start_archive(stream, out,
                      os.path.join(root, "checkpoint"), available_now=True)
    q.awaitTermination()
    return (spark.read.schema(ARCHIVE_SCHEMA).json(out)
            .groupBy("table_name")
            .agg(F.count(F.lit(1)).alias("records"),
                 F.count_if(F.col("event").isNull()).alias("tombstones")))


QUERIES: dict[str, Query] = {
    "repository_analytics": repository_analytics,
    "top_repositories": top_repositories,
    "envelope_parse": envelope_parse,
    "current_state": current_state,
    "current_state_late": current_state_late,
    "current_state_faulty": current_state_faulty,
    "dead_letters": dead_letters,
    "topic_routing": topic_routing,
    "cdc_statistics": cdc_statistics,
    "event_popularity": event_popularity,
    "language_distribution": language_distribution,
    "commit_activity": commit_activity,
    "event_issue_analytics": event_issue_analytics,
    "pull_request_analytics": pull_request_analytics,
    "cdc_repository_analytics": cdc_repository_analytics,
    "quality_profile": quality_profile,
    "quality_orphans": quality_orphans,
    "quality_report": quality_report,
    "quality_verdict": quality_verdict,
    "quality_failures": quality_failures,
    "quality_verdict_failures": quality_verdict_failures,
    "raw_repository_transform": raw_repository_transform,
    "raw_commit_transform": raw_commit_transform,
    "raw_issue_transform": raw_issue_transform,
    "raw_pull_request_transform": raw_pull_request_transform,
    "transform_totals": transform_totals,
    "resolve_keys": resolve_keys,
    "resolve_rejects": resolve_rejects,
    "upsert": upsert,
    "upsert_all_mutable": upsert_all_mutable,
    "load_versions": load_versions,
    "snapshot_diff": snapshot_diff,
    "apply_diff": apply_diff,
    "newest_per_parent": newest_per_parent,
    "diff_envelope_state": diff_envelope_state,
    "upsert_deduplicated": upsert_deduplicated,
    "stream_current_state": stream_current_state,
    "stream_normalise": stream_normalise,
    "stream_archive": stream_archive,
    "stream_dead_letters": stream_dead_letters,
    "staged_repository_analytics": staged_repository_analytics,
}
