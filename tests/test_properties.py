"""Property tests: state ignores order and repetition, diff/apply round-trips, upsert is
idempotent."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from changelake.operators import capture, envelope, load, state
from changelake.schemas import REPOSITORIES, TableSpec
from tests.fixtures import rec, records_df

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

event = st.tuples(st.integers(1, 4), st.sampled_from("rcud"), st.integers(0, 50), st.integers(0, 9))


def _value(key, op, ts, stars):
    if op == "d":
        return json.dumps({"op": "d", "ts_ms": ts, "before": {"repository_id": key}, "after": None})
    return json.dumps({"op": op, "ts_ms": ts, "before": None,
                       "after": {"repository_id": key, "stars": stars}})


def _state(spark, rows):
    log = envelope.normalise(records_df(spark, rows), REPOSITORIES)
    return sorted((r["repository_id"], r["stars"]) for r in state.current_state(log, REPOSITORIES).collect())


@SETTINGS
@given(events=st.lists(event, min_size=1, max_size=12), perm=st.randoms(use_true_random=False))
def test_state_ignores_order_and_repetition(spark, events, perm):
    rows = [rec(i, _value(*e)) for i, e in enumerate(events)]
    shuffled = list(rows) + list(rows)
    perm.shuffle(shuffled)
    assert _state(spark, rows) == _state(spark, shuffled)


snapshot = st.dictionaries(st.integers(1, 8), st.integers(0, 3), max_size=8)


@SETTINGS
@given(old=snapshot, new=snapshot)
def test_apply_of_diff_gives_new(spark, old, new):
    schema = "id bigint, v int"
    o = spark.createDataFrame(sorted(old.items()), schema)
    n = spark.createDataFrame(sorted(new.items()), schema)
    d = capture.diff_snapshots(o, n, "id")
    got = sorted(tuple(r) for r in capture.apply_changes(o, d, "id").collect())
    assert got == sorted(new.items())


@SETTINGS
@given(target=snapshot, batch=snapshot)
def test_upsert_twice_equals_once(spark, target, batch):
    schema = "id bigint, v int"
    t = spark.createDataFrame(sorted(target.items()), schema)
    b = spark.createDataFrame(sorted(batch.items()), schema)
    spec = TableSpec("t", "id", t.schema)
    once = load.upsert(t, b, spec)
    twice = load.upsert(once, b, spec)
    expected = sorted({**target, **batch}.items())
    assert sorted(tuple(r) for r in once.collect()) == expected
    assert sorted(tuple(r) for r in twice.collect()) == expected


STREAM_SETTINGS = settings(max_examples=3, deadline=None,
                           suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


@STREAM_SETTINGS
@given(events=st.lists(event, min_size=1, max_size=15), perm=st.randoms(use_true_random=False))
def test_streamed_state_equals_batch_state(spark, events, perm):
    import os

    from changelake.session import scratch_dir
    from changelake.sources.readers import landing_stream
    from changelake.streaming.jobs import start_normalise
    from changelake.streaming.state_stream import IncrementalState

    rows = [rec(i, _value(*e)) for i, e in enumerate(events)]
    delivered = list(rows) + list(rows)
    perm.shuffle(delivered)
    landing = scratch_dir(spark, "prop-landing", fresh=True)
    thirds = [delivered[i::3] for i in range(3)]
    for part in thirds:          # one file per third, appended into one folder
        if part:
            records_df(spark, part).coalesce(1).write.mode("append").parquet(landing)
    root = scratch_dir(spark, "prop-stream", fresh=True)
    stt = IncrementalState(spark, REPOSITORIES, os.path.join(root, "state"), compact_every=1)
    q = start_normalise(landing_stream(spark, landing, max_files_per_trigger=1), [REPOSITORIES],
                        os.path.join(root, "log"), os.path.join(root, "chk"),
                        states={"repositories": stt}, available_now=True)
    q.awaitTermination()
    streamed = sorted((r["repository_id"], r["stars"]) for r in stt.current().collect())
    assert streamed == _state(spark, rows)
