"""Schema drift, re-driven dead letters, and the snapshot diff by range digests."""

import os

import pytest
from pyspark.sql import functions as F

from changelake.operators import analytics, capture, digest, drift, envelope, redrive, state
from changelake.plans import stages
from changelake.schemas import ISSUES, REPOSITORIES, TABLES
from changelake.session import scratch_dir
from changelake.sources import fs
from changelake.sources.readers import landing_stream
from tests.fixtures import BASE, FAULTS, MALFORMED, rec, records_df

ROW = '{"op":"u","ts_ms":%d,"after":{"repository_id":%s,"stars":%s}}'


# ---- drift


def drifted(spark, *values, spec=REPOSITORIES):
    rows = [rec(n, v, topic=spec.topic()) for n, v in enumerate(values)]
    found = drift.schema_drift(records_df(spark, rows), [spec]).collect()
    return {(r.status, r.field): (r.type, r.records) for r in found}


def test_drift_names_new_and_mistyped_fields(spark):
    got = drifted(
        spark,
        '{"op":"c","after":{"repository_id":1,"stars":5,"license":{"id":"mit"}}}',
        '{"payload":{"op":"c","after":{"repository_id":2,"stars":"5","license":null,"name":{"deep":1}}}}',
        '{"op":"d","before":{"repository_id":3,"score":1.5},"after":null}',
        '{"op":"u","after":{"repository_id":4,"forks":3000000000,"score":2}}',
        '{"op":"u","after":{"repository_id":5,"archived":null}}',
        '{"op":"u","after":[1]}', "{oops", '{"op":"u","op":"c","after":{"repository_id":1}}', None)
    assert got.pop(("unreadable", None))[1] == 2
    assert got.pop(("new", "license")) == ("OBJECT<id: STRING>", 2)
    assert got.pop(("new", "score")) == ("DECIMAL(21,1)", 2)  # holds every BIGINT and 1.5
    assert got.pop(("mistyped", "stars")) == ("STRING", 1)
    assert got.pop(("mistyped", "forks")) == ("BIGINT", 1)
    assert not got  # text columns hold objects as their text; nulls of known columns are no drift


def test_rescued_values_and_other_topics(spark):
    rows = [rec(0, '{"op":"c","after":{"repository_id":1,"a":[1,"x"],"b":null}}'), rec(1, BASE[0][5]), rec(2, None),
            rec(3, '{"op":"c","after":{"issue_id":1,"zz":1}}', topic=ISSUES.topic())]
    kept = drift.rescue(records_df(spark, rows), REPOSITORIES)
    got = {r.offset: r.m for r in kept.select("offset", F.to_json(F.col("rescued")).alias("m")).collect()}
    assert got == {0: '{"a":[1,"x"],"b":null}', 1: "{}", 2: None}
    path = scratch_dir(spark, "rescued", fresh=True)
    kept.write.parquet(path)  # the values are kept as they were
    assert spark.read.parquet(path).where(F.try_variant_get(F.col("rescued")["a"], "$[1]", "string") == "x").count() == 1
    assert drift.schema_drift(records_df(spark, []), TABLES.values()).count() == 0


# ---- dead letters


def landed_job(spark, root, rows):
    landing = os.path.join(root, "landing")
    records_df(spark, rows).write.mode("append").parquet(landing)
    for q in stages.stream_job(spark, landing_stream(spark, landing), root, [REPOSITORIES], incremental_state=False,
                               archive=False, available_now=True):
        q.awaitTermination()


def stars(spark, root):
    now = state.current_state(stages.read_log(spark, root, REPOSITORIES), REPOSITORIES)
    return {r.repository_id: r.stars for r in now.collect()}


RULES = {envelope.REJECT_NO_KEY: redrive.key_from_record(REPOSITORIES)}


def keyed(offset, value, key):
    return (*rec(offset, value)[:4], f'{{"repository_id":{key}}}', value)


def corrected(spark, *rows):
    return spark.createDataFrame([(REPOSITORIES.topic(), 0, o, v) for o, v in rows], "topic string, partition int, offset long, value string")


def test_repairs_take_their_old_place(spark):
    root = scratch_dir(spark, "redrive", fresh=True)
    landed_job(spark, root, [
        rec(0, ROW % (1, 1, 10)), keyed(1, ROW % (2, '"x1"', 20), 1), rec(2, ROW % (3, 1, 30)),  # repaired, but 30 is newer
        keyed(3, ROW % (4, "null", 40), 2), keyed(4, ROW % (5, '"y"', 50), '"z"'),           # 3: repaired; 4: no use
        rec(5, MALFORMED), rec(5, MALFORMED), rec(6, "{also"), rec(7, None)])
    assert stars(spark, root) == {1: 30}
    assert stages.read_dead_letters(spark, root).count() == 7
    fixes = corrected(spark, (5, ROW % (6, 3, 60)), (6, "{still"), (99, ROW % (9, 9, 9)))
    assert stages.redrive_job(spark, root, RULES, fixes, [REPOSITORIES]) == 1
    assert stars(spark, root) == {1: 30, 2: 40, 3: 60}
    assert sorted(r.offset for r in stages.read_dead_letters(spark, root).collect()) == [4, 6, 7]
    statistics = analytics.change_statistics({"repositories": stages.read_log(spark, root, REPOSITORIES)})
    assert [r.event_count for r in statistics.collect()] == [5]  # the twice delivered record entered once
    # a second re-drive finds only what is open, and later records still win
    landed_job(spark, root, [rec(8, ROW % (8, 3, 80)), rec(9, "{new")])
    assert stages.redrive_job(spark, root, RULES, corrected(spark, (6, ROW % (7, 3, 70)), (9, ROW % (9, 4, 90))), [REPOSITORIES]) == 2
    assert stars(spark, root) == {1: 30, 2: 40, 3: 80, 4: 90}
    assert sorted(r.offset for r in stages.read_dead_letters(spark, root).collect()) == [4, 7]


def test_redrive_that_stopped_before_its_commit_is_done_again(spark, monkeypatch):
    root = scratch_dir(spark, "redrive-crash", fresh=True)
    landed_job(spark, root, [rec(0, ROW % (1, 1, 10)), rec(1, MALFORMED)])
    fixes = corrected(spark, (1, ROW % (2, 2, 20)), (1, ""))
    with monkeypatch.context() as m:
        m.setattr(fs, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            stages.redrive_job(spark, root, {}, fixes, [REPOSITORIES])
    assert stages.redrive_job(spark, root, {}, fixes, [REPOSITORIES]) == 1
    assert stages.read_log(spark, root, REPOSITORIES).count() == 2 and stars(spark, root) == {1: 10, 2: 20}
    assert stages.redrive_job(spark, root, {}, None, [REPOSITORIES]) == 2  # nothing is open
    assert stages.read_log(spark, root, REPOSITORIES).count() == 2


def test_dead_letters_without_a_position(spark):
    dead = envelope.rejected(envelope.parse_changes(records_df(spark, FAULTS + [(REPOSITORIES.topic(), None, None, None, None, "{a")]), REPOSITORIES, keep_raw=True))
    records = redrive.repaired(dead, {"malformed": lambda: F.lit(ROW % (1, 7, 70))})
    rows, entered = redrive.redrive(records, [REPOSITORIES])
    assert entered.count() == 2 and rows["repositories"].count() == 2
    assert redrive.still_open(dead, entered).count() == dead.count() - 2
    assert redrive.repaired(dead.limit(0), RULES, corrected(spark)).count() == 0


# ---- digests

SCHEMA = "id bigint, name string, size int"


def stored(spark, root, name, rows, ranges=16):
    df = spark.createDataFrame(rows, SCHEMA)
    digest.store(df, "id", os.path.join(root, name), ranges)
    return df


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_digest_diff_reads_changed_ranges_only(spark):
    root = scratch_dir(spark, "digest", fresh=True)
    rows = [(i, f"n{i}", i % 7) for i in range(400)]
    old = stored(spark, root, "old", rows)
    new = stored(spark, root, "new", [r for r in reversed(rows) if r[0] != 5] + [(1000, None, None)])
    wanted = digest.changed_ranges(spark, f"{root}/old", f"{root}/new")
    assert 1 <= len(wanted) <= 2
    for name in ("old", "new"):  # the files of unchanged ranges are unreadable: nothing may open them
        folder = os.path.join(root, name, "rows-16")
        for part in os.listdir(folder):
            if part.startswith("_range=") and int(part.split("=")[1]) not in wanted:
                for file in os.listdir(os.path.join(folder, part)):
                    with open(os.path.join(folder, part, file), "wb") as f:
                        f.write(b"damaged")
    got = digest.changes(spark, f"{root}/old", f"{root}/new", old.schema, "id")
    assert same(got, capture.diff_snapshots(old, new, "id")) and got.count() == 2
    with pytest.raises(Exception):
        spark.read.schema(old.schema).parquet(f"{root}/old/rows-16").collect()


def test_equal_and_empty_snapshots(spark):
    root = scratch_dir(spark, "digest", fresh=True)
    rows = [(1, None, 3), (2, "3", None), (3, "", 0), (3, "", 0), (None, "a", 1)]
    old, empty = stored(spark, root, "old", rows), stored(spark, root, "empty", [])
    stored(spark, root, "turned", list(reversed(rows)))
    assert digest.changed_ranges(spark, f"{root}/old", f"{root}/turned") == []
    assert digest.changes(spark, f"{root}/old", f"{root}/turned", old.schema, "id").count() == 0
    assert same(digest.changes(spark, f"{root}/old", f"{root}/empty", old.schema, "id"), capture.diff_snapshots(old, empty, "id"))
    moved = stored(spark, root, "moved", [(1, "3", None), (2, None, 3), (3, "", 0), (None, "a", 1)])
    ranges = digest.changed_ranges(spark, f"{root}/old", f"{root}/moved")
    assert -1 not in ranges and len(ranges) >= 1  # null keys are unchanged; a repeated row counts
    assert moved.count() == 4
    with pytest.raises(ValueError):
        digest.store(old, "id", f"{root}/none", 0)
    stored(spark, root, "other", rows, ranges=8)
    with pytest.raises(ValueError):
        digest.changed_ranges(spark, f"{root}/old", f"{root}/other")
