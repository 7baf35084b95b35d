"""Change-record parsing and normalisation.

``records`` are Kafka-shaped rows ``topic, partition, offset, timestamp, key, value``.
For one table they become typed rows ``META + row columns + reject_reason``:

* C1  one ``from_json`` per record; top-level fields win over ``payload``
* C2  route by topic (a pushed-down filter on the ``topic`` column)
* C3  table name from the topic, C4 literal table tag
* C5  typed projection of the row image (the table's explicit schema)
* C6  change key from ``after``, else ``before`` (so deletes keep their key)
* C7  records that cannot be applied carry a reason and are split off
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from changelake.functions.envelope import change_key, envelope_fields, parse_wire
from changelake.schemas import OPERATIONS, TableSpec

# Reasons a change record is set aside.
REJECT_TOMBSTONE = "tombstone"
REJECT_MALFORMED = "malformed"
REJECT_NO_OPERATION = "no_operation"
REJECT_NO_KEY = "no_key"
REJECT_UNKNOWN_TOPIC = "unknown_topic"
UNKNOWN_TABLE = "_unknown"

REJECT_COLUMNS = ("table_name", "operation", "topic", "partition", "offset", "kafka_timestamp",
                  "key", "value", "reject_reason")


def route(records: DataFrame, spec: TableSpec) -> DataFrame:
    """The records of ``spec``'s topic, by its whole name (a pushed-down filter)."""
    return records.filter(F.col("topic") == F.lit(spec.topic()))


def unrouted(records: DataFrame, specs: Iterable[TableSpec]) -> DataFrame:
    """Dead letters of records whose topic belongs to none of ``specs``."""
    # in this form the filter reaches the files: stretches of one table's records are not read
    unclaimed = F.col("topic").isNull() | ~F.col("topic").isin([s.topic() for s in specs])
    null = F.lit(None).cast("string")
    rows = records.filter(unclaimed).withColumnRenamed("timestamp", "kafka_timestamp").select(
        "*", F.lit(UNKNOWN_TABLE).alias("table_name"), null.alias("operation"),
        F.lit(REJECT_UNKNOWN_TOPIC).alias("reject_reason"))
    return rows.select(*REJECT_COLUMNS)


def _reason(env: Column, value: Column, key: Column) -> Column:
    return (
        F.when(value.isNull(), F.lit(REJECT_TOMBSTONE))
        .when(~env["parsed"], F.lit(REJECT_MALFORMED))
        .when(env["op"].isNull() | ~env["op"].isin(*OPERATIONS), F.lit(REJECT_NO_OPERATION))
        .when(key.isNull(), F.lit(REJECT_NO_KEY))
    )


def parse_changes(records: DataFrame, spec: TableSpec, routed: bool = False,
                  keep_raw: bool = False, columns: Sequence[str] | None = None) -> DataFrame:
    """Records of one table -> ``META + row columns + reject_reason`` (NULL when applicable).

    ``routed=True`` when ``records`` already hold only this table's topic.
    ``keep_raw=True`` also keeps ``topic, key, value`` for the dead-letter output.
    ``columns``: the row columns wanted beside the key, by default all. Nothing else is
    parsed, since no optimiser rule prunes the schema through the generator below.
    """
    src = records if routed else route(records, spec)
    wanted = [c for c in spec.columns if columns is None or c == spec.key or c in columns]
    row_schema = StructType([spec.row_schema[c] for c in wanted])
    # The parse leaves through a one-element explode: Catalyst never pushes a filter on
    # a generated column below the Generate, nor inlines the parse into later
    # projections, so every filter on parsed fields (rejects, keys, deletes) reuses the
    # one parse instead of re-running from_json per reference. Only the bare from_json
    # goes into the generator (which has no common-subexpression elimination).
    doc = src.select(
        "topic", "partition", "offset", F.col("timestamp").alias("kafka_timestamp"), "key",
        "value", F.explode(F.array(parse_wire("value", row_schema, spec.key))).alias("_doc"),
    )
    staged = doc.select("*", envelope_fields(F.col("_doc")).alias("_env")).drop("_doc")
    e = F.col("_env")
    key = change_key(e, spec.key)
    row_cols = [
        (key if c == spec.key else e["after"][c]).alias(c) for c in wanted
    ]
    out = staged.select(
        F.lit(spec.name).alias("table_name"),
        e["op"].alias("operation"),
        e["ts_ms"].alias("event_timestamp"),
        "kafka_timestamp",
        "partition",
        "offset",
        *row_cols,
        _reason(e, F.col("value"), key).alias("reject_reason"),
        *(["topic", "key", "value"] if keep_raw else []),
    )
    return out


def parse_images(records: DataFrame, specs: Iterable[TableSpec], columns: Sequence[str] = ()) -> DataFrame:
    """Every table's records in one pass, with both images: ``table_name, operation``, the event
    order, ``before``, ``after`` and ``reject_reason``.

    ``columns``: the row columns wanted beside the keys, of whichever table has them. The images
    share one schema, so a column that two tables have must have one type. Records of other
    topics are left out (``unrouted`` has them).
    """
    specs = list(specs)
    fields: dict[str, StructField] = {}
    for spec in specs:
        for f in spec.row_schema.fields:
            if f.name == spec.key or f.name in columns:
                if fields.setdefault(f.name, f).dataType != f.dataType:
                    raise ValueError(f"column {f.name} has another type in {spec.name}")
    topics = {s.topic(): s for s in specs}
    # as in parse_changes, the parse leaves through a one-element explode
    doc = records.filter(F.col("topic").isin(list(topics))).select(
        "topic", "partition", "offset", F.col("timestamp").alias("kafka_timestamp"), "value",
        F.explode(F.array(parse_wire("value", StructType(list(fields.values())), None))).alias("_doc"))
    staged = doc.select("*", envelope_fields(F.col("_doc")).alias("_env")).drop("_doc")
    e = F.col("_env")
    mine = lambda s: F.col("topic") == s.topic()
    key = F.coalesce(*[F.when(mine(s), change_key(e, s.key).cast("string")) for s in specs])
    return staged.select(
        F.coalesce(*[F.when(mine(s), F.lit(s.name)) for s in specs]).alias("table_name"),
        e["op"].alias("operation"), e["ts_ms"].alias("event_timestamp"), "kafka_timestamp", "partition", "offset",
        e["before"].alias("before"), e["after"].alias("after"), _reason(e, F.col("value"), key).alias("reject_reason"))


def accepted(parsed: DataFrame) -> DataFrame:
    """Rows that can be applied to state, without the helper columns."""
    keep = [c for c in parsed.columns if c not in ("reject_reason", "topic", "key", "value")]
    return parsed.filter(F.col("reject_reason").isNull()).select(*keep)


def rejected(parsed: DataFrame) -> DataFrame:
    """Dead letters with the raw record and the reason."""
    cols = [c for c in REJECT_COLUMNS if c in parsed.columns]
    return parsed.filter(F.col("reject_reason").isNotNull()).select(*cols)


def normalise(records: DataFrame, spec: TableSpec, routed: bool = False) -> DataFrame:
    """Typed, keyed change rows of one table (rejects dropped)."""
    return accepted(parse_changes(records, spec, routed=routed))


def dead_letter_counts(records: DataFrame, specs: Iterable[TableSpec]) -> DataFrame:
    """``table_name, reject_reason, records`` over every table's topic."""
    parts = [rejected(parse_changes(records, s, keep_raw=True)).select("table_name", "reject_reason")
             for s in specs]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.groupBy("table_name", "reject_reason").agg(F.count(F.lit(1)).alias("records"))

