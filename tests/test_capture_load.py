"""Snapshot diff (I1-I4), newest-per-parent (J1) and loading."""

import os

import pytest

from pyspark.sql import functions as F

from changelake.operators import capture, envelope, load
from changelake.schemas import FLAT_REPOSITORIES, UPSERT_SPECS, TableSpec
from changelake.session import scratch_dir

SCHEMA = "id bigint, name string, size int"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_diff_and_apply_roundtrip(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", None)], SCHEMA)
    new = spark.createDataFrame([(2, "b", 20), (3, "c", None), (4, "d", 4)], SCHEMA)
    d = capture.diff_snapshots(old, new, "id")
    ops = {r["id"]: r["operation"] for r in d.collect()}
    assert ops == {1: "d", 2: "u", 4: "c"}      # 3 unchanged (NULL-safe comparison)
    assert _rows(capture.apply_changes(old, d, "id")) == _rows(new)


def test_diff_to_envelopes_to_state(spark):
    from changelake.operators import state

    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA)
    new = spark.createDataFrame([(2, "b", 3), (5, "e", 5)], SCHEMA)
    spec = TableSpec("things", "id", old.schema)
    snap = capture.envelope_records(capture.snapshot_changes(old, "id"), spec.topic(), "id",
                                    F.lit(1).cast("bigint"), partitions=2)
    diff = capture.envelope_records(capture.diff_snapshots(old, new, "id"), spec.topic(), "id",
                                    F.lit(2).cast("bigint"), partitions=2, wrapped=True)
    log = envelope.normalise(snap.unionByName(diff), spec)
    cur = state.current_state(log, spec).select(*spec.columns)
    assert _rows(cur) == _rows(new)


def test_newest_per_parent(spark):
    df = spark.createDataFrame([(p, i) for p in range(3) for i in range(10)], "p int, i int")
    top = capture.newest_per_parent(df, "p", [F.col("i").desc()], 3)
    assert _rows(top) == sorted((p, i) for p in range(3) for i in (9, 8, 7))
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_newest_per_parent_two_stage_for_large_n(spark):
    df = spark.createDataFrame([(p, i) for p in range(2) for i in range(3000)], "p int, i int")
    top = capture.newest_per_parent(df, "p", [F.col("i").desc()], 1500, salts=8)
    assert _rows(top) == sorted((p, i) for p in range(2) for i in range(1500, 3000))


def test_upsert_respects_mutable_columns(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA)
    batch = spark.createDataFrame([(2, "B", 20), (3, "C", 30)], SCHEMA)
    spec = TableSpec("t", "id", target.schema, mutable=("size",))
    small = load.upsert(target, batch, spec)
    expected = [(1, "a", 1), (2, "b", 20), (3, "C", 30)]
    assert _rows(small) == expected
    assert "FullOuter" not in small._jdf.queryExecution().executedPlan().toString()
    # idempotent: applying the same batch twice equals once
    assert _rows(load.upsert(small, batch, spec)) == expected


def test_upsert_specs_follow_reference_rules():
    assert UPSERT_SPECS["repositories"].mutable_columns() == [
        "stars", "forks", "open_issues", "watchers", "updated_at", "pushed_at"]
    assert "created_at" not in UPSERT_SPECS["issues"].mutable_columns()
    assert "created_at" not in UPSERT_SPECS["pull_requests"].mutable_columns()
    assert "message" in UPSERT_SPECS["commits"].mutable_columns()
    assert FLAT_REPOSITORIES.key == "repository_id"


def test_dedupe_batch_last_wins(spark):
    batch = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "x", 1)], "id bigint, v string, seq int")
    got = _rows(load.dedupe_batch(batch, "id", ["seq"]))
    assert got == [(1, "new", 2), (2, "x", 1)]


def test_resolve_parent_accepts_and_rejects(spark):
    parents = spark.createDataFrame([(10, "o/a"), (11, "o/b")], "repository_id bigint, full_name string")
    batch = spark.createDataFrame([("s1", "o/a"), ("s2", "o/zz"), ("s3", "o/b")], "sha string, repository string")
    acc, rej = load.resolve_parent(batch, parents, "repository", "full_name", "repository_id")
    assert _rows(acc) == [("s1", "o/a", 10), ("s3", "o/b", 11)]
    assert _rows(rej) == [("s2", "o/zz")]


def test_commit_version_pointer(spark):
    root = scratch_dir(spark, "versions", fresh=True)
    df1 = spark.createDataFrame([(1,)], "x int")
    df2 = spark.createDataFrame([(2,)], "x int")
    load.commit_version(df1, root, 1)
    assert _rows(load.read_current(spark, root)) == [(1,)]
    load.commit_version(df2, root, 2)
    assert _rows(load.read_current(spark, root)) == [(2,)]
    # a repeated version reads the table it replaces; an older one is refused
    again = load.upsert(load.read_current(spark, root).withColumn("y", F.lit(1)), df2.withColumn("y", F.lit(5)),
                        TableSpec("t", "x", load.read_current(spark, root).withColumn("y", F.lit(1)).schema))
    load.commit_version(again.select("x"), root, 2)
    assert _rows(load.read_current(spark, root)) == [(2,)]
    with pytest.raises(ValueError):
        load.commit_version(df1, root, 1)


def test_crash_before_the_first_marker(spark):
    root = scratch_dir(spark, "versions", fresh=True)
    os.makedirs(os.path.join(root, "_commits", "0000000001-dead", "_temporary"))
    assert not load.has_version(spark, root)
    load.commit_version(spark.createDataFrame([(1,)], "x int"), root, 1)
    assert _rows(load.read_current(spark, root)) == [(1,)]


def test_rows_without_a_key_do_not_enter(spark):
    target = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    batch = spark.createDataFrame([(None, "n", 9), (2, "b", 2)], SCHEMA)
    spec = TableSpec("t", "id", target.schema, mutable=("size",))
    assert _rows(load.upsert(target, batch, spec)) == [(1, "a", 1), (2, "b", 2)]
