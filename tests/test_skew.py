"""A key holding a third of all rows reaches its shuffle as a bounded number of rows.

The measure is the executed plan's ``shuffleRecordsWritten`` of the operator's own
exchange (the one nearest the root): with map-side reduction it is bounded by
keys x map tasks (x n for a top-n), however many rows the hot key has.
"""

from pyspark.sql import functions as F

from changelake.operators import capture, entity, state

ROWS, KEYS, MAPS = 30000, 1000, 4


def _skewed(spark):
    # key 0 holds a third of all rows; the rest spread over KEYS keys
    return (spark.range(ROWS).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % KEYS + 1).alias("k"),
        F.col("id").alias("event_timestamp"), F.lit(None).cast("timestamp").alias("kafka_timestamp"),
        F.lit(0).alias("partition"), F.col("id").alias("offset"), F.lit("u").alias("operation"))
        .repartition(MAPS))


def _shuffle_writes(df) -> list[int]:
    """Executes ``df`` and returns shuffleRecordsWritten of its exchanges, root first."""
    df.collect()
    out = []

    def walk(p):
        name = p.nodeName()
        if name == "Exchange":
            m = p.metrics().get("shuffleRecordsWritten")
            if m.isDefined():
                out.append(int(m.get().value()))
        for attr in ("executedPlan", "plan"):
            try:
                walk(getattr(p, attr)())
                return
            except Exception:
                pass
        ch = p.children()
        for i in range(ch.size()):
            walk(ch.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_current_state_ships_at_most_one_row_per_key_per_map_task(spark):
    out = state.latest_per_key(_skewed(spark), "k")
    writes = _shuffle_writes(out)
    assert writes[0] <= (KEYS + 1) * MAPS < ROWS / 3


def test_top_n_per_parent_ships_at_most_n_rows_per_parent_per_map_task(spark):
    df = _skewed(spark).withColumnRenamed("k", "parent")
    top = capture.newest_per_parent(df, "parent", [F.col("offset").desc()], 3)
    writes = _shuffle_writes(top)
    assert writes[0] <= (KEYS + 1) * MAPS * 3 < ROWS


def test_aggregation_combines_hot_key_map_side(spark):
    df = _skewed(spark).select(F.col("k").alias("repository_id"))
    counts = entity.commit_counts(df)
    writes = _shuffle_writes(counts)
    assert writes[0] <= (KEYS + 1) * MAPS
    assert dict(counts.filter("repository_id = 0").first().asDict())["commit_count"] == ROWS // 3
