"""Column expressions over change envelopes.

An envelope is ``{op, ts_ms, before, after}``, either at the top level or wrapped
under ``payload`` (schemaless and schema-carrying converter output). It is parsed
once per record with ``from_json`` and an explicit schema: a bad field becomes
NULL, a malformed document gives all-NULL fields, nothing throws.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType


def envelope_schema(row_schema: StructType, key: str | None) -> StructType:
    """Schema of one envelope level for rows of ``row_schema``. Current state needs only the
    ``key`` of the image before a change; with ``key`` None that image is read in full."""
    return StructType([
        StructField("op", StringType()),
        StructField("ts_ms", LongType()),
        StructField("before", row_schema if key is None else StructType([row_schema[key]])),
        StructField("after", row_schema),
    ])


def wire_schema(row_schema: StructType, key: str | None) -> StructType:
    """Both encodings at once: the top-level fields and the same under ``payload``."""
    level = envelope_schema(row_schema, key)
    return StructType(list(level.fields) + [StructField("payload", level),
                                            StructField(CORRUPT, StringType())])


CORRUPT = "_corrupt_record"


def parse_wire(value: Column | str, row_schema: StructType, key: str | None) -> Column:
    """The single ``from_json`` of a record (both encodings and the corrupt-record text)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.from_json(v, wire_schema(row_schema, key),
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def envelope_fields(doc: Column) -> Column:
    """``struct<op, ts_ms, before, after, parsed>`` from a parsed record; the top level
    wins over ``payload``.

    ``parsed`` is false only for text that is not a JSON object at all; a record with
    one bad field keeps its other fields (the bad one is NULL), like the partial results
    of the JSON reader.
    """
    p = doc["payload"]
    nothing = (doc["op"].isNull() & doc["ts_ms"].isNull() & doc["before"].isNull()
               & doc["after"].isNull() & p.isNull())
    return F.struct(
        F.coalesce(doc["op"], p["op"]).alias("op"),
        F.coalesce(doc["ts_ms"], p["ts_ms"]).alias("ts_ms"),
        F.coalesce(doc["before"], p["before"]).alias("before"),
        F.coalesce(doc["after"], p["after"]).alias("after"),
        (~(doc[CORRUPT].isNotNull() & nothing)).alias("parsed"),
    )


def change_key(env: Column, key: str) -> Column:
    """Key of a change: from ``after``, else from ``before`` (deletes carry only ``before``)."""
    return F.coalesce(env["after"][key], env["before"][key])


def table_from_topic(topic: Column | str) -> Column:
    """``server.schema.table`` -> ``table``."""
    t = F.col(topic) if isinstance(topic, str) else topic
    return F.substring_index(t, ".", -1)


def encode_envelope(op: Column, ts_ms: Column, before: Column, after: Column,
                    wrapped: Column | bool = False) -> Column:
    """JSON text of an envelope; nulls are written (``after: null`` for a delete).

    ``wrapped`` puts the envelope under ``payload`` (per row when a Column).
    """
    env = F.struct(op.alias("op"), ts_ms.alias("ts_ms"), before.alias("before"),
                   after.alias("after"))
    opts = {"ignoreNullFields": "false"}
    flat = F.to_json(env, opts)
    nested = F.to_json(F.struct(env.alias("payload")), opts)
    if isinstance(wrapped, bool):
        return nested if wrapped else flat
    return F.when(wrapped, nested).otherwise(flat)
