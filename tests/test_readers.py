"""Readers keep explicit types: an all-NULL column survives, ints stay ints."""

import json
import os

from changelake.schemas import FLAT_COMMITS, PULL_REQUESTS
from changelake.session import scratch_dir
from changelake.sources import readers


def test_change_log_json_keeps_all_null_column_and_types(spark):
    root = scratch_dir(spark, "jsonlog", fresh=True)
    os.makedirs(root)
    rows = [{"table_name": "pull_requests", "operation": "c", "event_timestamp": 1, "partition": 0,
             "offset": i, "pull_request_id": i, "number": 1, "repository_id": 7, "state": "open"}
            for i in range(3)]                      # additions, deletions, ... never present
    with open(os.path.join(root, "part-0.json"), "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in rows))
    log = readers.change_log(spark, root, PULL_REQUESTS, fmt="json")
    types = dict((f.name, f.dataType.simpleString()) for f in log.schema.fields)
    assert types["additions"] == "int" and types["number"] == "int" and types["kafka_timestamp"] == "timestamp"
    assert log.filter("additions IS NULL").count() == 3
    inferred = spark.read.json(root)
    assert "additions" not in inferred.columns      # what inference would have lost


def test_flat_records_read_arrays_with_schema(spark):
    root = scratch_dir(spark, "flat", fresh=True)
    os.makedirs(root)
    with open(os.path.join(root, "o_r.json"), "w") as fh:
        json.dump([{"commit_sha": "a", "repository": "o/r", "author": "x"},
                   {"commit_sha": "b", "repository": "o/r"}], fh, indent=2)
    df = readers.flat_records(spark, root, FLAT_COMMITS.row_schema)
    assert sorted(r["commit_sha"] for r in df.collect()) == ["a", "b"]
    assert df.columns == FLAT_COMMITS.columns


def test_preview_is_a_top_k(spark):
    from pyspark.sql import functions as F

    from changelake.sources.writers import preview

    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("stars"), F.col("id"))
    top = preview(df, [F.col("stars").desc(), "id"], 5)
    assert [r["stars"] for r in top.collect()] == [999, 998, 997, 996, 995]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_flat_records_by_line(spark):
    root = scratch_dir(spark, "lines", fresh=True)
    os.makedirs(root)
    with open(os.path.join(root, "o_r.json"), "w") as fh:
        fh.write("\n".join(json.dumps({"commit_sha": str(k), "repository": "o/r"}) for k in range(5)))
    assert readers.flat_records(spark, root, FLAT_COMMITS.row_schema, lines=True).count() == 5


def test_a_page_is_parsed_before_it_is_exploded(spark):
    root = scratch_dir(spark, "pages", fresh=True)
    os.makedirs(root)
    with open(os.path.join(root, "o_r.json"), "w") as fh:
        fh.write(json.dumps([{"id": k} for k in range(50)], indent=2) + "\n")  # over many lines, and one at the end
    with open(os.path.join(root, "o_s.json"), "w") as fh:
        fh.write('[{"id": 1}, {"i')
    pages = readers.raw_pages(spark, root)
    assert pages.filter("reject_reason is null").count() == 50
    assert [(r.source_file, r.position, r.doc) for r in pages.filter("reject_reason is not null").collect()] == [("o_s.json", 0, '[{"id": 1}, {"i')]
    # nothing above the generator reads the page again: that took time with the square of its length
    above = pages._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    assert "from_json" not in above
