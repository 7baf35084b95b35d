"""Repaired dead letters re-enter the log.

A dead letter keeps the position and the time of its record. A repair gives it another value,
and the record is parsed again with its old position and time, so that it takes the place in the
order of events that it always had: a change that is newer than it still wins.

Repairs are rules by reason (a value made from the dead letter itself) and corrections (values
by position, from the producer); a correction wins. Corrections that name one position twice
give the greater value. What is not repaired, or is still not applicable, stays a dead letter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.operators.envelope import accepted, parse_changes, rejected
from changelake.schemas import TableSpec

POSITION = ("topic", "partition", "offset")
#: Names a dead letter, also one without a position.
IDENTITY = (*POSITION, "fingerprint")

Rule = Callable[[], Column]


def key_from_record(spec: TableSpec) -> Rule:
    """For ``no_key``: the key in the images, where it is text or null, becomes that of the record."""
    field = f'"{spec.key}":'

    def value() -> Column:
        name = F.get_json_object("key", f"$.{spec.key}")
        return F.regexp_replace("value", F.lit(field + r'\s*("[^"]*"|null)'), F.concat(F.lit(field), name))

    return value


def identified(dead: DataFrame) -> DataFrame:
    """Dead letters with ``fingerprint``, a hash of the value; each once, however often delivered."""
    return dead.withColumn("fingerprint", F.sha2(F.coalesce("value", F.lit("")), 256)).dropDuplicates(list(IDENTITY))


def still_open(dead: DataFrame, redriven: DataFrame) -> DataFrame:
    """``dead`` without those that ``redriven`` (``IDENTITY``) names."""
    d, r = dead.withColumn("fingerprint", F.sha2(F.coalesce("value", F.lit("")), 256)).alias("d"), redriven.select(*IDENTITY).alias("r")
    same = F.lit(True)
    for c in IDENTITY:
        same = same & F.col(f"d.{c}").eqNullSafe(F.col(f"r.{c}"))
    return d.join(r, same, "left_anti").drop("fingerprint")


def repaired(dead: DataFrame, rules: Mapping[str, Rule], corrections: DataFrame | None = None) -> DataFrame:
    """Kafka-shaped records of the dead letters that have a repair, with ``IDENTITY``'s fingerprint."""
    rows = identified(dead)
    rule = F.lit(None).cast("string")
    for reason, make in rules.items():
        rule = F.when(F.col("reject_reason") == reason, make()).otherwise(rule)
    rows = rows.withColumn("_value", rule)
    if corrections is not None:
        given = corrections.groupBy(*POSITION).agg(F.max("value").alias("_given"))
        rows = rows.join(given, list(POSITION), "left").withColumn("_value", F.coalesce("_given", "_value"))
    return rows.where("_value is not null").select(
        *POSITION, F.col("kafka_timestamp").alias("timestamp"), "key", F.col("_value").alias("value"), "fingerprint")


def redrive(records: DataFrame, specs: Iterable[TableSpec]) -> tuple[dict[str, DataFrame], DataFrame]:
    """``repaired`` records -> rows to append to each table's log, and ``IDENTITY`` of the records
    that entered one. Where two dead letters of a position have one repair, it enters once."""
    rows, entered = {}, None
    for spec in specs:
        parsed = parse_changes(records.dropDuplicates([*POSITION, "value"]), spec)
        rows[spec.name] = accepted(parsed)
        refused = rejected(parse_changes(records, spec, keep_raw=True)).select(*POSITION, "value").distinct()
        mine = records.where(F.col("topic") == spec.topic())
        same = [mine[c].eqNullSafe(refused[c]) for c in (*POSITION, "value")]
        done = mine.join(refused, same[0] & same[1] & same[2] & same[3], "left_anti").select(*IDENTITY)
        entered = done if entered is None else entered.unionByName(done)
    return rows, entered.distinct()
