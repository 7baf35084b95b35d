"""The job sequence of the reference, end to end, on the smallest test tables."""

import json
import os

import pytest

from changelake.plans import catalog, stages
from changelake.plans import testdata as td
from changelake.schemas import ISSUES
from changelake.session import scratch_dir
from changelake.sources.readers import landing_stream
from changelake.streaming.state_stream import IncrementalState

SMOKE = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="test tables not present")
def test_stream_state_final_quality(spark):
    landing = scratch_dir(spark, "landing", fresh=True)
    td.activity_records(spark, SMOKE).write.parquet(landing)
    root = scratch_dir(spark, "stages", fresh=True)
    for q in stages.stream_job(spark, landing_stream(spark, landing, max_files_per_trigger=3), root,
                                 available_now=True):
        q.awaitTermination()
    stages.state_job(spark, root, orders={"pull_requests": td.PR_ORDER})
    final = stages.final_analytics(spark, root)
    assert _rows(final) == _rows(catalog.cdc_repository_analytics(spark, SMOKE))

    # incremental state kept by the stream equals the batch state
    live = IncrementalState(spark, ISSUES, os.path.join(root, "live_state", "issues")).current()
    batch = spark.read.parquet(os.path.join(root, "state", "issues"))
    assert _rows(live.select("issue_id", "state")) == _rows(batch.select("issue_id", "state"))

    paths = stages.event_analytics_job(spark, root)
    stats = spark.read.parquet(paths["cdc_statistics"])
    assert _rows(stats) == _rows(catalog.cdc_statistics(spark, SMOKE))

    report = stages.quality_job(spark, root, catalog._expectations(spark, SMOKE))
    assert report.count() == 15 and report.filter("NOT passed").count() == 0

    archived = spark.read.json(os.path.join(root, "archive"))
    assert archived.count() == spark.read.parquet(landing).count()

    # the command-line entry writes the report and stops on a failed check
    stages.main(["quality", "--root", root])
    assert spark.read.parquet(os.path.join(root, "quality")).count() == 11


def test_raw_then_load(spark):
    root = scratch_dir(spark, "rawload", fresh=True)

    def put(rel, obj):
        path = os.path.join(root, "raw", rel)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as fh:
            json.dump(obj, fh)

    put("repositories/a.json", {"id": 1, "name": "a", "full_name": "o/a", "stargazers_count": 1,
                                "updated_at": "2024-01-01T00:00:00Z", "created_at": "2020"})
    put("repositories/b.json", {"id": 2, "name": "b", "full_name": "o/b", "stargazers_count": 2,
                                "updated_at": "2024-01-01T00:00:00Z"})
    put("commits/o_a.json", [{"sha": "s1", "author": {"login": "x"},
                              "commit": {"author": {"name": "X", "date": "2024-01-02"}, "message": "m"}}])
    put("commits/o_zz.json", [{"sha": "s2", "commit": {"author": {"name": "Y", "date": "2024-01-03"}}}])
    put("issues/o_b.json", [{"id": 7, "number": 1, "state": "open", "created_at": "2024-01-01",
                             "updated_at": "2024-01-01"},
                            {"id": 8, "number": 2, "pull_request": None}])
    stages.raw_job(spark, root)
    rejects = stages.load_job(spark, root, version=1)
    assert _rows(rejects["commits"].select("commit_sha")) == [("s2",)]
    from changelake.operators.load import read_current

    commits = read_current(spark, os.path.join(root, "tables", "commits"))
    assert _rows(commits.select("commit_sha", "repository_id")) == [("s1", 1)]
    issues = read_current(spark, os.path.join(root, "tables", "issues"))
    assert _rows(issues.select("issue_id", "repository_id", "state")) == [(7, 2, "open")]

    # second load: a repository's stars change (mutable), its name does not (immutable)
    put("repositories/a.json", {"id": 1, "name": "renamed", "full_name": "o/a", "stargazers_count": 9,
                                "updated_at": "2024-02-01T00:00:00Z"})
    stages.raw_job(spark, root)
    stages.load_job(spark, root, version=2)
    repos = read_current(spark, os.path.join(root, "tables", "repositories"))
    assert _rows(repos.select("repository_id", "name", "stars")) == [(1, "a", 9), (2, "b", 2)]


def test_raw_rejects_and_real_parent_names(spark):
    root = "file:" + scratch_dir(spark, "rawrejects", fresh=True)

    def put(rel, text):
        path = os.path.join(root[len("file:"):], "raw", rel)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as fh:
            fh.write(text)

    for k, full in enumerate(("a_b/c", "a/b_c", "o/a")):
        put(f"repositories/r{k}.json", json.dumps({"id": k + 1, "name": "n", "full_name": full}))
    put("commits/o_a.json", json.dumps([{"sha": "s1", "commit": {"author": {"date": "2024"}}}, {"commit": {}}]))
    put("commits/a_b_c.json", json.dumps([{"sha": "s2"}]))
    put("issues/o_a.json", '[{"id": 1, "number": 1}, {"id": 2, "num')
    out = stages.raw_job(spark, root)
    assert set(out) == {"repositories", "commits", "issues"}
    flat = spark.read.parquet(out["commits"])
    assert _rows(flat.select("commit_sha", "repository")) == [("s1", "o/a")]
    rejects = {n: [r["reject_reason"] for r in spark.read.parquet(os.path.join(root, "rejects", "raw", n)).collect()] for n in ("commits", "issues")}
    assert sorted(rejects["commits"]) == ["ambiguous_parent", "no_key"] and rejects["issues"] == ["malformed_page"]
    for _ in range(2):  # the same version twice
        stages.load_job(spark, root, version=1)
    from changelake.operators.load import read_current

    assert _rows(read_current(spark, os.path.join(root, "tables", "commits")).select("commit_sha", "repository_id")) == [("s1", 3)]
    assert read_current(spark, os.path.join(root, "tables", "repositories")).count() == 3


def test_roots_of_one_base_name_keep_their_own_checkpoint(spark):
    landing = scratch_dir(spark, "landing", fresh=True)
    td.repository_change_records(spark, SMOKE).write.parquet(landing)
    base = scratch_dir(spark, "roots", fresh=True)
    counts = []
    for parent in ("a", "b"):
        root = os.path.join(base, parent, "prod")
        for q in stages.stream_job(spark, landing_stream(spark, landing), root, incremental_state=False, archive=False, available_now=True):
            q.awaitTermination()
        counts.append(spark.read.parquet(os.path.join(root, "log", "repositories")).count())
    assert counts[0] == counts[1] > 0


def _page(root, rel, text):
    path = os.path.join(root, "raw", rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text if isinstance(text, str) else json.dumps(text))


def test_raw_stream_reads_each_page_once(spark):
    root = scratch_dir(spark, "rawstream", fresh=True)
    _page(root, "repositories/r.json", {"id": 1, "full_name": "o/a"})
    _page(root, "issues/o_a.json", [{"id": 1, "number": 1}, {"id": 2, "pull_request": None}])
    _page(root, "issues/repository=o_b/page.json", '[{"id": 3, "number": 3}, {"id')
    flat, bad = os.path.join(root, "flat", "issues"), os.path.join(root, "rejects", "raw", "issues")
    for name in ("repositories", "issues"):
        stages.raw_stream(spark, root, name, available_now=True).awaitTermination()
    assert _rows(spark.read.parquet(flat).select("issue_id", "repository")) == [(1, "o/a")]
    assert _rows(spark.read.parquet(bad).select("source_file", "reject_reason")) == [("o_b.json", "malformed_page")]
    first = sorted(os.listdir(flat))
    _page(root, "issues/repository=o_b/again.json", [{"id": 3, "number": 3}])
    stages.raw_stream(spark, root, "issues", available_now=True).awaitTermination()
    assert _rows(spark.read.parquet(flat).select("issue_id", "repository")) == [(1, "o/a"), (3, "o_b")]
    assert set(first) < set(os.listdir(flat))  # nothing was written again
    assert spark.read.parquet(bad).count() == 1


def test_children_wait_for_their_parent(spark):
    from changelake.operators.load import read_current

    root = scratch_dir(spark, "pending", fresh=True)
    _page(root, "repositories/a.json", {"id": 1, "full_name": "o/a"})
    _page(root, "issues/o_a.json", [{"id": 1, "title": "a"}])
    _page(root, "issues/o_b.json", [{"id": 2, "title": "b", "updated_at": "1"}, {"id": 3, "title": "c"}])
    stages.raw_job(spark, root, by_parent=True)
    assert _rows(stages.load_job(spark, root, 1)["issues"].select("issue_id", "reject_reason")) == [(2, "no_parent"), (3, "no_parent")]
    # the next load brings the parent and a newer row of one child, but not the other child
    _page(root, "repositories/b.json", {"id": 2, "full_name": "o/b"})
    _page(root, "issues/o_b.json", [{"id": 2, "title": "newer", "updated_at": "2"}])
    stages.raw_job(spark, root)
    for _ in range(2):  # the same version twice
        assert stages.load_job(spark, root, 2)["issues"].count() == 0
        issues = read_current(spark, os.path.join(root, "tables", "issues"))
        assert _rows(issues.select("issue_id", "repository_id", "title")) == [(1, 1, "a"), (2, 2, "newer"), (3, 2, "c")]
    assert read_current(spark, os.path.join(root, "pending", "issues")).count() == 0


def test_a_load_broadcasts_no_side_that_grows(spark, monkeypatch):
    """Parents and keys were sent through the driver by every join of a load."""
    limits = []
    commit = stages.load.commit_version
    monkeypatch.setattr(stages.load, "commit_version", lambda df, path, version: limits.append(
        [int(spark.conf.get(k)) for k in stages.NO_BROADCASTS]) or commit(df, path, version))
    root = scratch_dir(spark, "load", fresh=True)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.createDataFrame([(1, "o/r", "2024-01-01T00:00:00Z")], "repository_id long, full_name string, updated_at string").write.parquet(
        os.path.join(root, "flat", "repositories"))
    stages.load_job(spark, root, 1)
    assert limits and all(x < 0 for pair in limits for x in pair)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before
