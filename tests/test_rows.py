from pyspark.sql import functions as F

from changelake.functions.rows import emit
from changelake.plans import testdata as td


def test_emit_gives_the_outputs_that_hold(spark):
    df = spark.range(6).withColumn("c", F.when(F.col("id") != 3, F.col("id") % 2 == 0))  # null at 3
    got = emit(df, [(F.col("c"), [F.col("id").alias("n"), F.lit(None).cast("string").alias("t")]),
                    (F.col("id") > 3, [(F.col("id") * 10).alias("n"), F.lit("x").alias("t")])], F.lit("z").alias("topic"))
    assert got.columns == ["topic", "n", "t"]
    assert sorted((r.n, r.t) for r in got.collect()) == [(0, None), (2, None), (4, None), (40, "x"), (50, "x")]


def test_records_are_encoded_in_generated_code(spark):
    """A lambda over the array had its images encoded by the interpreter, and once more for a filter below."""
    recs = td.activity_records(spark, "/root/testdata/sf0.001", ["pull_requests"])
    assert "lambda" not in recs._jdf.queryExecution().optimizedPlan().toString()
