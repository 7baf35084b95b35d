"""Parsing (C1-C7) and current state (D1-D6) on hand-made envelopes."""

import random

from pyspark.sql import functions as F

from changelake.operators import envelope, state
from changelake.schemas import REPOSITORIES
from tests.fixtures import (
    BASE, DELETE, FAULTS, LATE, OVERFLOW, SNAPSHOT, TOPIC, UPDATE, rec, records_df,
)


def _state(spark, rows):
    log = envelope.normalise(records_df(spark, rows), REPOSITORIES)
    return {r["repository_id"]: r["stars"] for r in state.current_state(log, REPOSITORIES).collect()}


def test_both_encodings_parse(spark):
    log = envelope.normalise(records_df(spark, BASE), REPOSITORIES)
    got = {r["offset"]: (r["operation"], r["event_timestamp"], r["repository_id"]) for r in log.collect()}
    assert got == {0: ("r", 1, 1), 1: ("c", 2, 2), 2: ("u", 3, 2), 3: ("d", 4, 1)}


def test_delete_removes_key(spark):
    # The delete carries its key only in ``before``; repository 1 must disappear.
    assert _state(spark, BASE) == {2: 9}


def test_late_event_loses(spark):
    assert _state(spark, BASE + [rec(9, LATE, seconds=60)]) == {2: 9}


def test_repeated_delivery_and_order_do_not_matter(spark):
    rows = BASE + BASE + [rec(9, LATE)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        assert _state(spark, rows) == {2: 9}


def test_same_event_time_breaks_ties_on_kafka_time_partition_offset(spark):
    a = '{"op":"u","ts_ms":10,"after":{"repository_id":5,"stars":1}}'
    b = '{"op":"u","ts_ms":10,"after":{"repository_id":5,"stars":2}}'
    assert _state(spark, [rec(0, a, seconds=2), rec(1, b, seconds=1)]) == {5: 1}
    assert _state(spark, [rec(0, a, partition=1), rec(1, b, partition=0)]) == {5: 1}
    assert _state(spark, [rec(7, a), rec(3, b)]) == {5: 1}


def test_rejects_and_reasons(spark):
    parsed = envelope.parse_changes(records_df(spark, BASE + FAULTS), REPOSITORIES, keep_raw=True)
    reasons = {r["offset"]: r["reject_reason"] for r in envelope.rejected(parsed).collect()}
    assert reasons == {4: "tombstone", 5: "malformed", 6: "no_key", 7: "no_key", 8: "no_operation"}
    assert envelope.accepted(parsed).count() == 4
    # Faults never change state.
    assert _state(spark, BASE + FAULTS) == {2: 9}


def test_overflow_gives_null_field_not_failure(spark):
    log = envelope.normalise(records_df(spark, [rec(0, OVERFLOW)]), REPOSITORIES)
    row = log.first()
    assert row["repository_id"] == 3 and row["stars"] is None


def test_other_topics_are_routed_away(spark):
    rows = [rec(0, SNAPSHOT), rec(1, UPDATE, topic="cdc.public.commits")]
    assert envelope.normalise(records_df(spark, rows), REPOSITORIES).count() == 1


def test_table_name_and_types(spark):
    log = envelope.normalise(records_df(spark, BASE), REPOSITORIES)
    def shape(schema):
        return [(f.name, f.dataType.simpleString()) for f in schema.fields]

    assert shape(log.schema) == shape(REPOSITORIES.normalised_schema())
    assert {r[0] for r in log.select("table_name").distinct().collect()} == {"repositories"}


def test_plan_keeps_delete_filter_above_window_and_limits_before_shuffle(spark):
    log = envelope.normalise(records_df(spark, BASE), REPOSITORIES)
    plan = state.current_state(log, REPOSITORIES)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "PythonUDF" not in plan and "CartesianProduct" not in plan
    opt = state.current_state(log, REPOSITORIES)._jdf.queryExecution().optimizedPlan().toString()
    # the delete filter (operation != d) is applied after ranking, never below the window
    window_at = opt.find("Window")
    filter_at = opt.find("NOT (operation")
    assert filter_at != -1 and filter_at < window_at


def test_parse_runs_once_per_record(spark):
    log = envelope.normalise(records_df(spark, BASE + FAULTS), REPOSITORIES)
    plan = log._jdf.queryExecution().optimizedPlan().toString()
    # One operator holds the parse (its repeated references share one evaluation there);
    # no filter or later projection re-runs it.
    assert sum("from_json" in line for line in plan.splitlines()) == 1


def test_delete_in_before_only_state_with_tombstones(spark):
    log = envelope.normalise(records_df(spark, [rec(0, SNAPSHOT), rec(1, DELETE)]), REPOSITORIES)
    rows = state.state_with_tombstones(log, REPOSITORIES).collect()
    assert [(r["repository_id"], r["operation"]) for r in rows] == [(1, "d")]
    assert log.filter(F.col("operation") == "d").first()["repository_id"] == 1


def test_topic_literal(spark):
    assert REPOSITORIES.topic() == TOPIC
