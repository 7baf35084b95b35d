"""Running aggregates, retraction and redelivery: streams stopped and started again equal the batch."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from changelake.operators import entity, envelope, state, totals
from changelake.plans import live, moving
from changelake.schemas import REPOSITORIES, TABLES
from changelake.session import scratch_dir, settings
from changelake.sources.readers import landing_stream
from changelake.streaming import redelivery
from changelake.streaming.redelivery import ConsumedOffsets, deliver_once, intervals_of, start_once
from changelake.streaming.running import KeyedState, Running
from changelake.streaming.statistics import EventStatistics
from tests.fixtures import BASE, FAULTS, LATE, rec, records_df

SMOKE = "/root/testdata/sf0.001"


def run(query):
    query.awaitTermination()
    return query


def test_keyed_state_survives_restarts_and_reads_changed_keys_only(spark):
    root = scratch_dir(spark, "keyed", fresh=True)
    landing = os.path.join(root, "landing")
    many = [rec(100 + k, f'{{"op":"c","ts_ms":1,"after":{{"repository_id":{1000 + k},"stars":{k}}}}}') for k in range(50)]
    drops = [many + BASE[:2], BASE[2:] + FAULTS, [rec(9, LATE, seconds=60)] + BASE]
    for rows in drops:
        records_df(spark, rows).coalesce(1).write.mode("append").parquet(landing)
        st = KeyedState(spark, REPOSITORIES, os.path.join(root, "checkpoint"), partitions=4)
        query = run(st.start(envelope.normalise(landing_stream(spark, landing), REPOSITORIES), available_now=True))
    # the last batch touches two keys of 52: no other state was rewritten
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 52
    assert query.lastProgress["stateOperators"][0]["numRowsUpdated"] == 2
    now = {r.repository_id: r.stars for r in st.current().collect()}
    assert now == {2: 9} | {1000 + k: k for k in range(50)}
    assert {r.repository_id for r in st.with_tombstones().collect() if r.operation == "d"} == {1}
    batch = state.current_state(envelope.normalise(records_df(spark, sum(drops, [])), REPOSITORIES), REPOSITORIES)
    assert sorted(map(tuple, batch.select(*st.current().columns).collect())) == sorted(map(tuple, st.current().collect()))


def test_empty_running_aggregate_and_unfit_measure(spark):
    schema = spark.createDataFrame([], "k long, v long").schema
    path = scratch_dir(spark, "running", fresh=True)
    assert Running(spark, path, schema, ["k"], {"n": F.count("v")}).rows().count() == 0
    landing = scratch_dir(spark, "landing", fresh=True)
    spark.range(6).select((F.col("id") % 2).alias("k"), F.col("id").alias("v")).write.parquet(landing)
    r = Running(spark, path, schema, ["k"], {"a": F.avg("v")}, partitions=2)
    run(r.start(spark.readStream.schema(schema).parquet(landing), available_now=True))
    with pytest.raises(ValueError):
        r.rows()


def change(offset, table, op, ts, before=None, after=None):
    import json

    return rec(offset, json.dumps({"op": op, "ts_ms": ts, "before": before, "after": after}), topic=TABLES[table].topic())


def test_retraction_does_not_depend_on_order(spark):
    rows = [
        change(0, "repositories", "r", 1, None, {"repository_id": 1, "full_name": "a/x", "stars": 5}),
        change(1, "repositories", "c", 1, None, {"repository_id": 2, "full_name": "a/y", "stars": 6}),
        change(2, "repositories", "u", 2, {"repository_id": 2}, {"repository_id": 2, "full_name": "a/z", "stars": 7}),
        change(3, "repositories", "c", 1, None, {"repository_id": 3}),
        change(4, "repositories", "d", 9, {"repository_id": 3}, None),
        change(0, "issues", "c", 1, None, {"issue_id": 1, "repository_id": 1, "state": "open", "comments": 4}),
        change(1, "issues", "u", 2, {"issue_id": 1, "repository_id": 1, "state": "open", "comments": 4},
               {"issue_id": 1, "repository_id": 2, "state": "closed", "comments": 6}),
        change(2, "issues", "c", 1, None, {"issue_id": 2, "repository_id": 2, "state": "open"}),
        change(3, "issues", "c", 1, None, {"issue_id": 3, "repository_id": 1, "state": "open", "comments": 1}),
        change(4, "issues", "d", 2, {"issue_id": 3, "repository_id": 1, "state": "open", "comments": 1}, None),
        change(5, "issues", "d", 2, {"issue_id": 9}, None),
        change(0, "commits", "c", 1, None, {"commit_sha": "s", "repository_id": 3}),
        change(0, "pull_requests", "c", 1, None, {"pull_request_id": 1, "repository_id": 1, "state": "open"}),
        change(1, "pull_requests", "u", 2, {"pull_request_id": 1, "repository_id": 1, "state": "open"},
               {"pull_request_id": 1, "repository_id": 1, "state": "closed"}),
    ]
    parsed = {n: envelope.normalise(records_df(spark, rows), s) for n, s in TABLES.items()}
    current = {n: state.current_state(parsed[n], s) for n, s in TABLES.items()}
    want = sorted(map(tuple, entity.repository_analytics(*[current[n] for n in ("repositories", "commits", "issues", "pull_requests")]).collect()))
    assert [r[0] for r in want] == [1, 2]
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        running = live.repository_totals(spark, scratch_dir(spark, "totals", fresh=True), 2)
        signed = totals.contributions(live._images(records_df(spark, rows)))
        got = running.aggregate(signed)
        assert sorted(map(tuple, totals.repository_analytics(got).collect())) == want
        assert totals.unretractable(got).first()[0] == 1


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="test tables not present")
def test_retraction_equals_state_on_the_moving_stream(spark):
    records = moving.moving_records(spark, SMOKE)
    current = {n: state.current_state(envelope.normalise(records, s), s) for n, s in TABLES.items()}
    want = entity.repository_analytics(*[current[n] for n in ("repositories", "commits", "issues", "pull_requests")], sort=False)
    running = live.repository_totals(spark, scratch_dir(spark, "totals", fresh=True))
    got = totals.repository_analytics(running.aggregate(totals.contributions(live._images(records))))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_statistics_count_set_aside_records(spark):
    landing = scratch_dir(spark, "landing", fresh=True)
    records_df(spark, BASE + FAULTS).write.parquet(landing)
    s = EventStatistics(spark, scratch_dir(spark, "statistics", fresh=True), 2)
    run(s.start(landing_stream(spark, landing), available_now=True))
    counts = {(r.table_name, r.operation): r.event_count for r in s.change_statistics().collect()}
    assert counts == {("repositories", "r"): 1, ("repositories", "c"): 1, ("repositories", "u"): 3, ("repositories", "d"): 1, (None, None): 3}


# ---- redelivery


def named(spark, offsets, partition=0, topic="t"):
    return records_df(spark, [rec(o, f"v{o}", partition=partition, topic=topic) for o in offsets])


def spans(df):
    return sorted((r.topic, r.partition, r.start, r.end) for r in df.collect())


def test_intervals(spark, monkeypatch):
    rows = named(spark, [0, 1, 2, 4, 7, 8]).unionByName(named(spark, [5, 6], partition=1)).unionByName(named(spark, [3], topic="u"))
    want = [("t", 0, 0, 2), ("t", 0, 4, 4), ("t", 0, 7, 8), ("t", 1, 5, 6), ("u", 0, 3, 3)]
    assert spans(intervals_of(rows)) == want
    monkeypatch.setattr(redelivery, "BUCKET", 3)  # pieces of several buckets join again
    assert spans(intervals_of(rows)) == want


def test_scattered_offsets_of_one_partition_are_many_groups(spark):
    offsets = spark.range(0, 16 * redelivery.BUCKET, 16).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    largest = lambda df: df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        once = intervals_of(offsets)
        assert once.count() == redelivery.BUCKET and largest(once) < redelivery.BUCKET // 2
        consumed = ConsumedOffsets(spark, os.path.join(scratch_dir(spark, "scattered", fresh=True), "consumed"))
        consumed.add(once)
        consumed.add(intervals_of(offsets.withColumn("offset", F.col("offset") + 1)))
        rows = consumed.intervals().withColumn("part", F.input_file_name())
        assert rows.where("end = start + 1").count() == redelivery.BUCKET == rows.count()
        assert rows.groupBy("part").count().agg(F.max("count")).first()[0] < redelivery.BUCKET // 2


def test_long_intervals_meet_repeated_and_very_large_offsets(spark, monkeypatch):
    monkeypatch.setattr(redelivery, "BUCKET", 4)
    consumed = ConsumedOffsets(spark, os.path.join(scratch_dir(spark, "repeated", fresh=True), "consumed"))
    high = (1 << 60) + 3
    for offsets in ([*range(2, 23), 40], [5, 6, 13, 24, high], [*range(21, 26), 41, 42], [high, high + 1]):
        consumed.add(intervals_of(named(spark, offsets)))
    assert spans(consumed.intervals()) == [("t", 0, 2, 25), ("t", 0, 40, 42), ("t", 0, high, high + 1)]
    assert [r.offset for r in consumed.fresh(named(spark, [1, 9, 25, 26, high, high + 2])).orderBy("offset").collect()] == [1, 26, high + 2]


def test_only_new_records_are_delivered(spark, monkeypatch):
    monkeypatch.setattr(redelivery, "BUCKET", 4)
    root = scratch_dir(spark, "once", fresh=True)
    out, consumed = os.path.join(root, "out"), ConsumedOffsets(spark, os.path.join(root, "consumed"))
    rnd = random.Random(2)
    sent = []
    for batch_id in range(5):
        new = rnd.sample(range(40), 12)
        batch = named(spark, new + new[:3]).unionByName(records_df(spark, [("t", None, None, None, None, f"nameless {batch_id}")]))
        deliver_once(batch, batch_id, consumed, out)
        sent += new
    got = [r.value for r in spark.read.option("recursiveFileLookup", "true").schema(named(spark, [0]).schema).parquet(out).collect()]
    assert sorted(got) == sorted([f"v{o}" for o in set(sent)] + [f"nameless {k}" for k in range(5)])
    covered = [o for _, _, a, b in spans(consumed.intervals()) for o in range(a, b + 1)]
    assert covered == sorted(set(sent))


def test_crash_between_the_commits_and_a_lost_checkpoint(spark, monkeypatch):
    root = scratch_dir(spark, "crash", fresh=True)
    landing, out = os.path.join(root, "landing"), os.path.join(root, "out")
    consumed = ConsumedOffsets(spark, os.path.join(root, "consumed"))
    named(spark, range(20)).repartition(2).write.parquet(landing)
    with monkeypatch.context() as m:
        m.setattr(ConsumedOffsets, "add", lambda self, new: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception):
            run(start_once(landing_stream(spark, landing), out, consumed, os.path.join(root, "checkpoint"), available_now=True))
    assert len(os.listdir(out)) == 1  # published, its offsets not committed
    count = lambda: spark.read.option("recursiveFileLookup", "true").parquet(out).count()
    run(start_once(landing_stream(spark, landing), out, consumed, os.path.join(root, "checkpoint"), available_now=True))
    assert count() == 20 and spans(consumed.intervals()) == [("t", 0, 0, 19)]
    named(spark, range(15, 30)).write.mode("append").parquet(landing)
    run(start_once(landing_stream(spark, landing), out, consumed, os.path.join(root, "another-checkpoint"), available_now=True))
    assert count() == 30 and spans(consumed.intervals()) == [("t", 0, 0, 29)]


def test_a_drop_lands_every_record_without_a_shuffle(spark):
    from changelake.plans import landing

    path, parts = landing.drops(spark, named(spark, range(1000)).repartition(3), "whole", 2)
    tracker, group = spark.sparkContext.statusTracker(), "landing-drop"
    with pytest.MonkeyPatch.context() as m:  # in one thread, whose jobs are then found by their group
        m.setattr(landing, "run_concurrently", lambda tasks: [t() for t in tasks.values()])
        spark.sparkContext.setJobGroup(group, group)
        for part in parts:
            landing.drop(part, path)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(group)]
    assert stages and set(stages) == {1}
    landed = spark.read.option("recursiveFileLookup", "true").parquet(path)
    assert sorted(r.offset for r in landed.collect()) == list(range(1000))
    files = landed.select(F.input_file_name().alias("file"), "offset").groupBy("file").agg(F.min("offset").alias("low"), F.max("offset").alias("high"))
    assert all(r.high - r.low > 100 for r in files.collect())  # no file holds a stretch of the log


def test_a_landed_file_is_read_by_several_tasks_and_its_piece_alone(spark, monkeypatch):
    from changelake.plans import landing

    monkeypatch.setattr(landing, "ROW_GROUP", 1 << 12)
    one = named(spark, [0])
    many = one.drop("offset", "value").crossJoin(spark.range(40_000).select(F.col("id").alias("offset"), F.sha2(F.col("id").cast("string"), 256).alias("value")))
    path, (records,) = landing.drops(spark, many.select(*one.columns), "groups", 1)
    piece = records.where(F.col("_piece") == 1)  # read from folders of its own
    assert re.search(r"PartitionFilters: \[[^\]]*_piece#\d+L? = 1", piece._jdf.queryExecution().executedPlan().toString())
    landing.drop(records, path)
    landed = landing.landing_stream(spark, path).schema
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "0"}):
        read = spark.read.schema(landed).option("recursiveFileLookup", "true").parquet(path)
        parts = read.groupBy(F.input_file_name().alias("file"), F.spark_partition_id().alias("task")).count()
        assert all(r["count"] > 1 for r in parts.groupBy("file").count().collect())
    assert read.count() == 40_000
    path, (nothing,) = landing.drops(spark, named(spark, []), "nothing", 1)
    landing.drop(nothing, path)
    assert spark.read.schema(landed).option("recursiveFileLookup", "true").parquet(path).count() == 0


def test_no_batch_is_cached(spark, monkeypatch):
    from changelake.streaming.jobs import normalise_batch

    root = scratch_dir(spark, "uncached", fresh=True)
    batch = records_df(spark, BASE + FAULTS + BASE)

    def refuse(*_):
        raise AssertionError("a batch may be larger than the executors' memory")

    monkeypatch.setattr(type(batch), "persist", refuse)
    monkeypatch.setattr(type(batch), "cache", refuse)
    consumed = ConsumedOffsets(spark, os.path.join(root, "consumed"))
    deliver_once(batch, 0, consumed, os.path.join(root, "once"))
    once = spark.read.option("recursiveFileLookup", "true").schema(batch.schema).parquet(os.path.join(root, "once"))
    assert once.count() == len(BASE + FAULTS)
    normalise_batch(once, 0, [REPOSITORIES], os.path.join(root, "log"))
    assert spark.read.parquet(os.path.join(root, "log", "repositories")).count() == len(BASE)
    assert spark.read.parquet(os.path.join(root, "log", "_dead_letters")).count() == len(FAULTS)


def test_long_and_short_intervals_are_consumed(spark, monkeypatch):
    monkeypatch.setattr(redelivery, "BUCKET", 4)
    consumed = ConsumedOffsets(spark, os.path.join(scratch_dir(spark, "mixed", fresh=True), "consumed"))
    consumed.add(intervals_of(named(spark, [*range(3, 18), 20, 22, 29])))  # one over five buckets, three inside one
    rows = named(spark, [*range(32), *range(16, 24), 40]).unionByName(named(spark, [5], partition=1))
    got = sorted((r.partition, r.offset) for r in consumed.fresh(rows).collect())
    assert got == [(0, o) for o in [0, 1, 2, 18, 19, 21, *range(23, 29), 30, 31, 40]] + [(1, 5)]
