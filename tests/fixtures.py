"""Hand-made change records (see FIXTURES.md section 2)."""

from __future__ import annotations

import datetime as dt

TOPIC = "cdc.public.repositories"
T0 = dt.datetime(2024, 1, 1)


def rec(offset: int, value: str | None, partition: int = 0, seconds: int = 0, topic: str = TOPIC):
    return (topic, partition, offset, T0 + dt.timedelta(seconds=seconds), None, value)


SNAPSHOT = '{"op":"r","ts_ms":1,"before":null,"after":{"repository_id":1,"stars":5}}'
INSERT_WRAPPED = '{"payload":{"op":"c","ts_ms":2,"before":null,"after":{"repository_id":2,"stars":7}}}'
UPDATE = '{"op":"u","ts_ms":3,"before":null,"after":{"repository_id":2,"stars":9}}'
DELETE = '{"op":"d","ts_ms":4,"before":{"repository_id":1},"after":null}'
MALFORMED = "{oops"
WRONG_TYPE = '{"op":"u","ts_ms":5,"after":{"repository_id":"x","stars":1}}'
OVERFLOW = '{"op":"u","ts_ms":6,"after":{"repository_id":3,"stars":3000000000}}'
NO_KEY = '{"op":"u","ts_ms":7,"after":{"stars":1}}'
LATE = '{"op":"u","ts_ms":2,"after":{"repository_id":1,"stars":6}}'
NO_OP = '{"ts_ms":8,"after":{"repository_id":4,"stars":1}}'

BASE = [rec(0, SNAPSHOT), rec(1, INSERT_WRAPPED), rec(2, UPDATE), rec(3, DELETE)]
FAULTS = [rec(4, None), rec(5, MALFORMED), rec(6, WRONG_TYPE), rec(7, NO_KEY), rec(8, NO_OP)]


def records_df(spark, rows):
    from changelake.schemas import KAFKA_SCHEMA

    return spark.createDataFrame(rows, KAFKA_SCHEMA)
