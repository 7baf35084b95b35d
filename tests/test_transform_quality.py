"""Raw transforms from landing files (S5, S6, T1-T11) and quality checks (Q1-Q6)."""

import json
import os

from pyspark.sql import functions as F

from changelake.operators import quality, transform
from changelake.session import scratch_dir
from changelake.sources import readers


def _land(spark, files: dict[str, object]) -> str:
    root = scratch_dir(spark, "raw", fresh=True)
    os.makedirs(root, exist_ok=True)
    for name, obj in files.items():
        with open(os.path.join(root, name), "w") as fh:
            json.dump(obj, fh, indent=2)
    return root


def test_repository_documents_one_object_per_file(spark):
    root = _land(spark, {
        "a.json": {"id": 1, "name": "r", "full_name": "o/r", "owner": {"login": "o"},
                   "stargazers_count": 5, "license": {"spdx_id": "MIT"}, "topics": ["x"]},
        "b.json": {"id": 2, "name": "s", "full_name": "o/s", "owner": None, "license": None},
    })
    flat = transform.repositories(readers.raw_documents(spark, root))
    got = {r["repository_id"]: (r["owner"], r["stars"], r["license"], r["topics"]) for r in flat.collect()}
    assert got == {1: ("o", 5, "MIT", ["x"]), 2: (None, None, None, [])}
    assert len(flat.columns) == 21


def test_issue_feed_arrays_with_parent_from_file_name(spark):
    root = _land(spark, {
        "o_r.json": [
            {"id": 1, "number": 1, "title": "t", "state": "open", "user": {"login": "u"},
             "labels": [{"name": "bug"}], "comments": 2},
            {"id": 2, "number": 2, "pull_request": {"url": "x"}},
            {"id": 3, "number": 3, "pull_request": None},
            {"id": 4, "number": 4, "user": None},
        ],
        "o_empty.json": [],
    })
    docs = readers.raw_documents(spark, root).withColumn("repository", readers.parent_of_file())
    flat = transform.issues(docs)
    got = {r["issue_id"]: (r["repository"], r["author"], r["labels"]) for r in flat.collect()}
    assert got == {1: ("o_r", "u", ["bug"]), 4: ("o_r", None, [])}
    totals = {r["repository"]: (r["issues"], r["pull_requests_skipped"])
              for r in transform.issue_feed_totals(docs).collect()}
    assert totals == {"o_r": (2, 2)}


def test_commit_author_falls_back_when_login_empty_or_missing(spark):
    docs = spark.createDataFrame([
        ("r", json.dumps({"sha": "a", "author": {"login": "x"}, "commit": {"author": {"name": "N"}}})),
        ("r", json.dumps({"sha": "b", "author": {"login": ""}, "commit": {"author": {"name": "N"}}})),
        ("r", json.dumps({"sha": "c", "author": None, "commit": {"author": {"name": "N"}}})),
    ], "repository string, doc string")
    got = {r["commit_sha"]: r["author"] for r in transform.commits(docs).collect()}
    assert got == {"a": "x", "b": "N", "c": "N"}


def test_pull_request_transform_columns(spark):
    docs = spark.createDataFrame([("r", json.dumps({"id": 9, "user": {"login": "u"}, "additions": 3}))],
                                 "repository string, doc string")
    row = transform.pull_requests(docs).first()
    assert row["pull_request_id"] == 9 and row["author"] == "u" and row["additions"] == 3
    assert len(transform.pull_requests(docs).columns) == 17


def test_profile_counts_duplicate_keys_and_null_group(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k bigint")
    row = quality.table_profile(df, "k", "t").first()
    assert (row["row_count"], row["duplicate_keys"], row["null_keys"]) == (5, 2, 2)


def test_orphans_count_null_key(spark):
    parent = spark.createDataFrame([(1,), (2,)], "repository_id bigint")
    child = spark.createDataFrame([(1,), (3,), (3,), (None,)], "repository_id bigint")
    row = quality.orphan_check(child, parent, "repository_id", "c").first()
    assert row["observed"] == 2 and not row["passed"]


def test_report_and_verdict(spark):
    a = spark.createDataFrame([(1,), (2,)], "repository_id bigint")
    b = spark.createDataFrame([("x", 1), ("y", 9)], "sha string, repository_id bigint")
    exp = spark.createDataFrame([("a", 2), ("b", 2)], "table string, expected bigint")
    rep = quality.quality_report({"a": (a, "repository_id"), "b": (b, "sha")}, exp,
                                 parent=("a", "repository_id"), references={"b": "repository_id"})
    assert rep.count() == 2 + 4 + 1
    v = quality.verdict(rep).first()
    assert v["checks"] == 7 and v["failed"] == 1 and v["all_passed"] is False
    failed = rep.filter(~F.col("passed")).first()
    assert (failed["table_name"], failed["check_name"]) == ("b", "orphan_keys")


def test_time_text_in_any_encoding(spark):
    from changelake.functions.text import to_timestamp_any

    df = spark.createDataFrame([("2024-01-02T03:04:05Z",), ("1704164645000",), ("1704164645000000",),
                                ("not a time",), (None,)], "t string")
    got = [r[0] for r in df.select(F.unix_millis(to_timestamp_any("t"))).collect()]
    assert got == [1704164645000, 1704164645000, 1704164645000, None, None]


def test_row_count_without_expectation_fails(spark):
    a = spark.createDataFrame([(1,)], "k bigint")
    exp = spark.createDataFrame([("other", 1), ("absent", 0)], "table string, expected bigint")
    rows = {r["table_name"]: (r["observed"], r["passed"]) for r in quality.row_count_check({"a": a}, exp).collect()}
    assert rows == {"a": (1, False), "other": (None, False), "absent": (None, False)}
