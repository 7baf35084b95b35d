"""Streaming equals batch (D6, K1, K3) and the driver contract, on small inputs."""

import os

from pyspark.sql import functions as F

import pytest

from changelake.operators import envelope, state
from changelake.schemas import REPOSITORIES
from changelake.session import scratch_dir
from changelake.sources.readers import landing_stream
from changelake.streaming.jobs import start_normalise
from changelake.streaming.state_stream import IncrementalState
from tests.fixtures import BASE, FAULTS, LATE, rec, records_df

SMOKE = "/root/testdata/sf0.001"


def test_incremental_state_equals_batch_over_micro_batches(spark):
    rows = BASE + FAULTS + [rec(9, LATE, seconds=60)] + BASE
    landing = scratch_dir(spark, "landing", fresh=True)
    df = records_df(spark, rows)
    df.repartition(4).write.parquet(landing)
    root = scratch_dir(spark, "stream", fresh=True)
    st = IncrementalState(spark, REPOSITORIES, os.path.join(root, "state"))
    q = start_normalise(landing_stream(spark, landing, max_files_per_trigger=1), [REPOSITORIES],
                        os.path.join(root, "log"), os.path.join(root, "chk"),
                        states={"repositories": st}, available_now=True)
    q.awaitTermination()
    got = {r["repository_id"]: r["stars"] for r in st.current().collect()}
    batch = state.current_state(envelope.normalise(df, REPOSITORIES), REPOSITORIES)
    assert got == {r["repository_id"]: r["stars"] for r in batch.collect()} == {2: 9}
    # the delete is kept as a tombstone so later-arriving older events keep losing
    assert {r["repository_id"] for r in st.with_tombstones().collect()} == {1, 2}
    dead = spark.read.parquet(os.path.join(root, "log", "_dead_letters"))
    assert dead.count() == len(FAULTS)


def test_merge_does_not_depend_on_order(spark):
    import random

    rows = BASE + FAULTS + [rec(9, LATE, seconds=60)] + BASE
    results = []
    for seed in (7, 8):
        root = scratch_dir(spark, "merge", fresh=True)
        st = IncrementalState(spark, REPOSITORIES, os.path.join(root, "state"))
        shuffled = list(rows)
        random.Random(seed).shuffle(shuffled)
        for i in range(0, len(shuffled), 3):
            st.merge(envelope.normalise(records_df(spark, shuffled[i:i + 3]), REPOSITORIES), i)
        results.append(sorted((r["repository_id"], r["operation"], r["stars"])
                              for r in st.with_tombstones().collect()))
    assert results[0] == results[1] == [(1, "d", None), (2, "u", 9)]


def test_tombstones_purged_after_retention(spark):
    root = scratch_dir(spark, "retention", fresh=True)
    st = IncrementalState(spark, REPOSITORIES, os.path.join(root, "state"), tombstone_retention_ms=10)
    later = '{"op":"u","ts_ms":100,"after":{"repository_id":2,"stars":10}}'
    st.merge(envelope.normalise(records_df(spark, BASE + [rec(9, later)]), REPOSITORIES), 0)
    st.compact()
    # the delete (ts 4) is older than newest (100) minus retention (10): purged
    assert sorted(r["repository_id"] for r in st.with_tombstones().collect()) == [2]


def test_deletes_without_a_time_survive_retention(spark):
    root = scratch_dir(spark, "retention", fresh=True)
    st = IncrementalState(spark, REPOSITORIES, os.path.join(root, "state"), tombstone_retention_ms=10)
    gone = '{"op":"d","before":{"repository_id":5}}'
    st.merge(envelope.normalise(records_df(spark, [rec(9, gone)]), REPOSITORIES), 0)
    st.compact()
    assert [r["operation"] for r in st.with_tombstones().collect()] == ["d"]


def test_archive_replay_on_a_later_day_replaces_the_batch(spark):
    from unittest import mock

    from changelake.streaming import jobs

    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    root = scratch_dir(spark, "replay", fresh=True)
    batch = records_df(spark, BASE)
    plain = jobs.archive_rows
    older = lambda r: plain(r).withColumn("received_date", F.date_sub("received_date", 1))
    try:
        for rows in (older, plain):
            with mock.patch.object(jobs, "archive_rows", rows):
                jobs.normalise_batch(batch, 0, [REPOSITORIES], os.path.join(root, "log"), archive_root=os.path.join(root, "archive"))
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert spark.read.json(os.path.join(root, "archive")).count() == len(BASE)


def test_the_archive_is_packed_and_whole(spark):
    from changelake.streaming.jobs import start_archive

    landing, root = scratch_dir(spark, "landing", fresh=True), scratch_dir(spark, "packed", fresh=True)
    df = records_df(spark, [rec(k, BASE[0][5], seconds=k) for k in range(3000)] + FAULTS)
    df.coalesce(1).write.parquet(landing)
    out = os.path.join(root, "out")
    start_archive(landing_stream(spark, landing), out, os.path.join(root, "chk"), available_now=True).awaitTermination()
    files = [os.path.join(d, f) for d, _, names in os.walk(out) for f in names if f.startswith("part-")]
    text = df.agg(F.sum(F.length("value"))).first()[0]
    assert sum(map(os.path.getsize, files)) < text / 4
    want = sorted((r.offset, r.value or "") for r in df.collect())
    assert sorted((r.offset, r.event or "") for r in spark.read.json(out).collect()) == want


def test_unknown_topics_are_dead_letters(spark):
    from changelake.streaming.jobs import normalise_batch

    root = scratch_dir(spark, "topics", fresh=True)
    foreign = records_df(spark, BASE).withColumn("topic", F.lit("other.x.repositories"))
    normalise_batch(foreign, 0, [REPOSITORIES], os.path.join(root, "log"))
    assert spark.read.parquet(os.path.join(root, "log", "repositories")).count() == 0
    dead = spark.read.parquet(os.path.join(root, "log", "_dead_letters"))
    assert [tuple(r) for r in dead.select("table_name", "reject_reason").distinct().collect()] == [("_unknown", "unknown_topic")]
    assert dead.count() == len(BASE)


def test_the_filter_of_unknown_topics_reaches_the_files(spark):
    path = scratch_dir(spark, "unrouted", fresh=True)
    nameless = records_df(spark, BASE[:1]).withColumn("topic", F.lit(None).cast("string"))
    records_df(spark, BASE).unionByName(nameless).write.parquet(path)
    dead = envelope.unrouted(spark.read.parquet(path), [REPOSITORIES])
    assert dead.count() == 1
    assert "Or(IsNull(topic),Not(" in dead._jdf.queryExecution().executedPlan().toString().replace(" ", "")


def test_purge_sweep_drops_old_tombstones_only(spark):
    root = scratch_dir(spark, "sweep", fresh=True)
    st = IncrementalState(spark, REPOSITORIES, os.path.join(root, "state"))
    st.merge(envelope.normalise(records_df(spark, BASE), REPOSITORIES), 0)
    st.purge_tombstones(older_than_ms=4)      # the delete has ts 4: kept
    assert sorted(r["repository_id"] for r in st.with_tombstones().collect()) == [1, 2]
    st.purge_tombstones(older_than_ms=5)      # now older: purged, repository 2 untouched
    assert [(r["repository_id"], r["stars"]) for r in st.with_tombstones().collect()] == [(2, 9)]


def test_replayed_batch_is_idempotent(spark):
    root = scratch_dir(spark, "replay", fresh=True)
    st = IncrementalState(spark, REPOSITORIES, os.path.join(root, "state"))
    log = envelope.normalise(records_df(spark, BASE), REPOSITORIES)
    st.merge(log, 0)
    st.merge(log, 0)
    assert {r["repository_id"]: r["stars"] for r in st.current().collect()} == {2: 9}


def test_batches_only_add_and_compaction_changes_nothing(spark):
    """Batch numbers that start again, a compaction after three deltas, and what it leaves."""
    root = scratch_dir(spark, "generations", fresh=True)
    st = IncrementalState(spark, REPOSITORIES, os.path.join(root, "state"), compact_every=2)
    rows = BASE + FAULTS + [rec(9, LATE, seconds=60)] + BASE
    kept = set()
    for i in range(0, len(rows), 2):
        st.merge(envelope.normalise(records_df(spark, rows[i:i + 2]), REPOSITORIES), i % 4)
        now = {os.path.join(d, f) for d, _, files in os.walk(root) for f in files if f.endswith(".parquet") and "delta" in d}
        assert len(now - kept) <= 8  # the files of this batch alone
        kept |= now
    assert sorted((r["repository_id"], r["operation"], r["stars"]) for r in st.with_tombstones().collect()) == [(1, "d", None), (2, "u", 9)]
    generations = [d for d in os.listdir(os.path.join(root, "state")) if d.startswith("gen-")]
    assert 1 < len(generations) <= 2 and "gen-0" not in generations


def test_half_written_folders_do_not_count(spark):
    root = scratch_dir(spark, "crash", fresh=True)
    st = IncrementalState(spark, REPOSITORIES, os.path.join(root, "state"))
    os.makedirs(os.path.join(root, "state", "gen-0", "delta-0-dead"))  # died before its first file
    assert st.current().count() == 0
    st.merge(envelope.normalise(records_df(spark, BASE), REPOSITORIES), 0)
    newer = envelope.normalise(records_df(spark, [rec(9, LATE, seconds=60)]), REPOSITORIES).withColumn("stars", F.lit(99)).withColumn("event_timestamp", F.lit(1 << 50))
    for dead in ("gen-0/delta-1-dead", "gen-1/base"):  # died before the marker
        newer.write.mode("overwrite").parquet(os.path.join(root, "state", dead))
    expected = {2: 9}
    assert {r["repository_id"]: r["stars"] for r in st.current().collect()} == expected
    st.compact()  # over the dead base
    assert {r["repository_id"]: r["stars"] for r in st.current().collect()} == expected


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="test tables not present")
def test_entry_and_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 16
    qs, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 30


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="test tables not present")
def test_all_queries_match_oracle_at_smoke_scale(spark):
    import __spark_entry__ as e
    from tests.oracle_compare import compare, duck

    con = duck(SMOKE)
    bad = []
    for name, q in e.queries().items():
        r = compare(spark, SMOKE, name, q, e.oracle_sql().get(name), con)
        if r.get("match") is False:
            bad.append(r)
    assert not bad, bad


def test_processing_time_trigger(spark):
    """The production trigger (a fixed interval) on the same fan-out."""
    landing = scratch_dir(spark, "landing", fresh=True)
    records_df(spark, BASE + FAULTS).repartition(2).write.parquet(landing)
    root = scratch_dir(spark, "interval", fresh=True)
    st = IncrementalState(spark, REPOSITORIES, os.path.join(root, "state"))
    q = start_normalise(landing_stream(spark, landing), [REPOSITORIES], os.path.join(root, "log"),
                        os.path.join(root, "chk"), states={"repositories": st},
                        processing_time="1 second", archive_root=os.path.join(root, "archive"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert {r["repository_id"]: r["stars"] for r in st.current().collect()} == {2: 9}
    assert spark.read.json(os.path.join(root, "archive")).count() == len(BASE + FAULTS)
