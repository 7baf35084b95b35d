"""Raw pages at size: bounded packed files, parsed once, listed by few tasks."""

import glob
import gzip
import json
import os

import duckdb
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.plans import raw_files, stages
from changelake.plans.oracles_live import LIVE_ORACLES
from changelake.session import scratch_dir
from changelake.sources import readers

SMOKE = "/root/testdata/sf0.001"


def _page(root, rel, docs):
    path = os.path.join(root, "raw", rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        json.dump(docs, fh)


def test_micro_batches_of_as_many_pages_are_all_kept(spark):
    """Their folders were named by all documents' files: an even number of them gave one name, and the second was dropped."""
    root = scratch_dir(spark, "evenpages", fresh=True)
    for k in range(2):
        _page(root, f"commits/o_{k}.json", [{"sha": f"{k}a"}, {"sha": f"{k}b"}])
        stages.raw_stream(spark, root, "commits", available_now=True).awaitTermination()
    flat = spark.read.parquet(os.path.join(root, "flat", "commits"))
    assert sorted(r.commit_sha for r in flat.collect()) == ["0a", "0b", "1a", "1b"]
    assert flat.drop("pages").columns == stages.UPSERT_SPECS["commits"].columns
    assert not [n for n in os.listdir(os.path.join(root, "_staging")) if not n.startswith(".")]


def test_a_micro_batch_of_pages_is_not_cached_and_lists_folders_by_few_tasks(spark, monkeypatch):
    root = scratch_dir(spark, "uncached", fresh=True)
    _page(root, "commits/repository=o_a/p.json", [{"sha": "a"}])
    sessions, files = [], readers.raw_files
    monkeypatch.setattr(readers, "raw_files", lambda s, *a: sessions.append(s) or files(s, *a))
    monkeypatch.setattr(DataFrame, "persist", lambda *a: pytest.fail("cached"))
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    stages.raw_stream(spark, root, "commits", available_now=True).awaitTermination()
    # the source asks its session when it lists, which is after the stream was started
    assert int(sessions[0].conf.get(key)) == 4 * spark.sparkContext.defaultParallelism and spark.conf.get(key) == before
    assert sessions[0].conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")


def test_landed_pages_are_bounded_and_packed(spark, monkeypatch):
    monkeypatch.setattr(raw_files, "PAGE_DOCS", 5)
    root = scratch_dir(spark, "bounded", fresh=True)
    for drop in range(2):
        raw_files.land_issues(spark, SMOKE, root, drop)
    sizes, cut = [], 0
    for path in glob.glob(f"{root}/raw/issues/repository=*/*"):
        if path.endswith(".gz"):
            text = gzip.open(path, "rt").read().strip()
            if text.endswith("]"):
                sizes.append(len(json.loads(text)))
            else:
                cut += 1
    con = duckdb.connect()
    n, = con.execute(f"SELECT count(*) FROM (SELECT DISTINCT o_custkey % 150 + 1 AS k FROM '{SMOKE}/orders.parquet' JOIN '{SMOKE}/customer.parquet' ON "
                     "c_custkey = o_custkey % 150 + 1 WHERE o_orderkey % 2 = 0 AND o_custkey % 150 + 1 IN (7, 57, 107))").fetchone()
    assert cut == n > 0  # a cut-off page is a whole fetch
    assert max(sizes) <= 4 * raw_files.PAGE_DOCS


def test_load_rejects_from_many_pages(spark, monkeypatch):
    monkeypatch.setattr(raw_files, "PAGE_DOCS", 3)
    con = duckdb.connect()
    for t in ("customer", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMOKE}/{t}.parquet'")
    got = sorted(tuple(r) for r in raw_files.load_rejects(spark, SMOKE).collect())
    assert got == sorted(con.execute(LIVE_ORACLES["load_rejects"]).fetchall())


def test_ties_of_pull_requests_go_to_the_greatest_document(spark, tmp_path):
    con = duckdb.connect()
    con.execute(f"COPY (SELECT * FROM '{SMOKE}/customer.parquet') TO '{tmp_path}/customer.parquet'")
    con.execute(f"COPY (SELECT l.* REPLACE (1 AS l_orderkey, 1 AS l_linenumber, 5 AS l_suppkey, q AS l_quantity) FROM (SELECT * FROM "
                f"'{SMOKE}/lineitem.parquet' LIMIT 1) l, (VALUES (3), (20), (9)) v(q)) TO '{tmp_path}/lineitem.parquet'")
    root = scratch_dir(spark, "ties", fresh=True)
    raw_files.land_pull_requests(spark, str(tmp_path), root, 1)
    docs = readers.raw_pages(spark, os.path.join(root, "raw", "pull_requests"))
    assert [r.n for r in docs.select(F.get_json_object("doc", "$.comments").alias("n")).collect()] == ["9"]  # as text: 9 after 20 and 3
