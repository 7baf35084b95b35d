"""Landing folders: what waits is moved, not written again, and nothing that was consumed stays."""

import glob
import os

from pyspark.sql import functions as F

from changelake.plans import landing
from changelake.session import scratch_dir, tidy
from tests.test_running import named


def _files(path):
    return {os.path.basename(f): os.path.getmtime(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def _run(spark, rows, checkpoint):
    seen = []
    rows.writeStream.foreachBatch(lambda b, _: seen.append(sorted(r.offset for r in b.collect()))).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return seen


def test_a_drop_is_moved_and_may_be_delivered_again(spark):
    path, parts = landing.drops(spark, named(spark, range(200)).repartition(3), "moved", 2)
    want = [sorted(r.offset for r in p.collect()) for p in parts]
    files = _files(landing.waiting(path, 0))
    checkpoint = scratch_dir(spark, "moved", fresh=True)
    first = landing.move(spark, path, landing.waiting(path, 0))
    assert _files(path) == files and not _files(landing.waiting(path, 0))  # nothing was written
    assert _run(spark, landing.stream(spark, path, in_pieces=False), checkpoint) == [want[0]]
    landing.move(spark, path, first)
    landing.move(spark, path, landing.waiting(path, 1))
    assert _run(spark, landing.stream(spark, path, in_pieces=False), checkpoint) == [list(range(200))]


def test_a_drop_in_pieces_is_a_handful_of_batches_and_leaves_the_last(spark):
    path, _ = landing.drops(spark, named(spark, range(400)).repartition(16), "pieces", 1)
    landing.move(spark, path, landing.waiting(path, 0))
    files = len(_files(path))
    batches = _run(spark, landing.stream(spark, path), scratch_dir(spark, "pieces", fresh=True))
    assert sorted(o for b in batches for o in b) == list(range(400))
    assert 2 <= len(batches) <= 2 * landing.PIECES and len(_files(path)) < files


def test_a_drop_without_records(spark):
    path, _ = landing.drops(spark, named(spark, []), "empty", 1)
    landing.move(spark, path, landing.waiting(path, 0))
    assert _run(spark, landing.stream(spark, path), scratch_dir(spark, "empty", fresh=True)) == []


def test_jobs_of_a_tidy_query_leave_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen = spark.conf.get(key), []

    def query(spark, path):
        spark.range(100_000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count().write.parquet(path)
        seen.append(spark.conf.get(key))

    def files():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in (blocks.apply(k).getName() for k in range(blocks.size())) if f.startswith("shuffle_")}

    had = files()
    tidy(query)(spark, scratch_dir(spark, "tidy", fresh=True))
    assert not files() - had and seen == ["true"] and spark.conf.get(key) == before
    query(spark, scratch_dir(spark, "untidy", fresh=True))
    assert files() - had
