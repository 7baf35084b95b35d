"""What the explicit schemas do not hold (C1, C5): fields that a producer added, and values that
a typed column could not take.

The record is read a second time as VARIANT, beside the typed parse. ``rescue`` keeps such
fields with the position of their record; ``schema_drift`` sums them up. Both read the image
that the row is made from: ``after``, else ``before``.

Defined cases: a null value (tombstone) has nothing to rescue; text that VARIANT refuses
(malformed, a repeated field name, too large) is ``unreadable``; a new field counts even where
it is null; a known field counts where it holds a value and the typed column is null.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.functions.envelope import envelope_fields, parse_wire
from changelake.operators.envelope import route
from changelake.schemas import TableSpec

# How a field departs from the schema.
NEW, MISTYPED, UNREADABLE = "new", "mistyped", "unreadable"

_FIELDS = "map<string,variant>"


def _image(doc: Column) -> Column:
    """Fields of the row image, by name; NULL where there is no object."""
    return F.coalesce(*[F.try_variant_get(doc, path, _FIELDS)
                        for path in ("$.after", "$.payload.after", "$.before", "$.payload.before")])


def rescue(records: DataFrame, spec: TableSpec, routed: bool = False) -> DataFrame:
    """``table_name, topic, partition, offset, kafka_timestamp, unreadable, rescued`` of every
    record of the table; ``rescued`` maps field names to their values (VARIANT)."""
    src = records if routed else route(records, spec)
    both = F.struct(parse_wire("value", spec.row_schema, None).alias("typed"), F.try_parse_json("value").alias("variant"))
    # one parse of each kind for a record, as in envelope.parse_changes
    doc = src.select("topic", "partition", "offset", F.col("timestamp").alias("kafka_timestamp"), "value",
                     F.explode(F.array(both)).alias("_doc"))
    env = envelope_fields(F.col("_doc.typed"))
    row = F.coalesce(env["after"], env["before"])
    empty = F.array_compact(F.array(*[F.when(row[c].isNull(), F.lit(c)) for c in spec.columns]))
    doc = doc.select("*", _image(F.col("_doc.variant")).alias("_image"), empty.alias("_empty"))
    fields = F.map_filter("_image", lambda name, value: ~name.isin(spec.columns)
                          | (F.array_contains("_empty", name) & ~F.is_variant_null(value)))
    return doc.select(F.lit(spec.name).alias("table_name"), "topic", "partition", "offset", "kafka_timestamp",
                      (F.col("value").isNotNull() & F.col("_doc.variant").isNull()).alias("unreadable"),
                      fields.alias("rescued"))


def _report(records: DataFrame, spec: TableSpec) -> DataFrame:
    found = rescue(records, spec)
    # an unreadable record has no fields, so that one entry stands for it
    entry = F.when(F.col("unreadable"), F.map_from_arrays(F.array(F.lit("")), F.array(F.lit(None).cast("variant")))).otherwise(F.col("rescued"))
    fields = found.select("table_name", "kafka_timestamp", "unreadable", F.explode(entry).alias("field", "value"))
    status = F.when(F.col("unreadable"), UNREADABLE).when(F.col("field").isin(spec.columns), MISTYPED).otherwise(NEW)
    return (fields.groupBy("table_name", status.alias("status"), F.when(~F.col("unreadable"), F.col("field")).alias("field"))
            .agg(F.schema_of_variant_agg("value").alias("type"), F.count(F.lit(1)).alias("records"),
                 F.min("kafka_timestamp").alias("first_seen"))
            .withColumn("type", F.when(F.col("status") != UNREADABLE, F.col("type"))))


def schema_drift(records: DataFrame, specs: Iterable[TableSpec]) -> DataFrame:
    """``table_name, status, field, type, records, first_seen``: one row for each field that the
    schema lacks (``new``) or whose values it could not take (``mistyped``), with the type that
    holds all values seen (VARIANT where none does), and one for a table's ``unreadable`` records."""
    return reduce(DataFrame.unionByName, [_report(records, s) for s in specs])
