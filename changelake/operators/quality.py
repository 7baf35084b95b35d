"""Data-quality checks that return their results as rows (Q1-Q6).

Every check is a DataFrame ``table_name, check_name, column_name, observed, expected,
passed``; nothing is folded on the driver. ``table_profile`` computes row count,
duplicate keys and null keys of a table in one aggregation (Q6) instead of three jobs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHECK_COLUMNS = ("table_name", "check_name", "column_name", "observed", "expected", "passed")


def _row(table: str, check: str, column: str | None, observed, expected) -> list:
    return [
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(column).cast("string").alias("column_name"),
        observed.cast("bigint").alias("observed"),
        expected.cast("bigint").alias("expected"),
    ]


def _with_passed(df: DataFrame) -> DataFrame:
    """NULL-safe: a check with no expectation (or no observation) fails, never passes silently."""
    return df.withColumn("passed", F.col("observed").eqNullSafe(F.col("expected")))


def table_profile(df: DataFrame, key: str, table: str) -> DataFrame:
    """Q6: ``table_name, row_count, duplicate_keys, null_keys`` in one pass.

    ``duplicate_keys`` counts key values (the NULL group included) seen more than once,
    not surplus rows; ``null_keys`` counts rows whose key is NULL.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.count_if(F.col("_n") > 1).cast("bigint").alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0)).cast("bigint")
         .alias("null_keys"),
    ).select(F.lit(table).alias("table_name"), "row_count", "duplicate_keys", "null_keys")


def row_count_check(tables: Mapping[str, DataFrame], expectations: DataFrame) -> DataFrame:
    """Q1: actual row count per table against an expectations table ``table, expected``. A table
    that is expected but absent has no count and fails, also where 0 rows are expected."""
    parts = [df.agg(F.count(F.lit(1)).alias("observed")).select(F.lit(n).alias("table_name"), "observed")
             for n, df in tables.items()]
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    exp = expectations.select(F.col("table").alias("table_name"), F.col("expected").cast("bigint"))
    out = counts.join(exp, "table_name", "full_outer").select(
        "table_name", F.lit("row_count").alias("check_name"),
        F.lit(None).cast("string").alias("column_name"),
        F.col("observed").cast("bigint").alias("observed"), "expected")
    return _with_passed(out).select(*CHECK_COLUMNS)


def orphan_keys(child: DataFrame, parent: DataFrame, fk: str, pk: str | None = None) -> DataFrame:
    """Distinct child foreign keys with no parent row; a NULL key never matches, so it counts."""
    pk = pk or fk
    keys = child.select(fk).distinct()
    parents = parent.select(F.col(pk).alias(fk)).distinct()
    return keys.join(parents, fk, "left_anti")


def orphan_check(child: DataFrame, parent: DataFrame, fk: str, table: str,
                 pk: str | None = None) -> DataFrame:
    """Q4: number of distinct orphan foreign keys; passes at 0."""
    n = orphan_keys(child, parent, fk, pk).agg(F.count(F.lit(1)).alias("n"))
    return _with_passed(n.select(*_row(table, "orphan_keys", fk, F.col("n"), F.lit(0))))


def key_checks(df: DataFrame, key: str, table: str) -> DataFrame:
    """Q2 and Q3 from one profile pass (two result rows)."""
    p = table_profile(df, key, table)
    dup = p.select(*_row(table, "duplicate_keys", key, F.col("duplicate_keys"), F.lit(0)))
    nul = p.select(*_row(table, "null_keys", key, F.col("null_keys"), F.lit(0)))
    return _with_passed(dup.unionByName(nul))


def quality_report(tables: Mapping[str, tuple[DataFrame, str]], expectations: DataFrame | None = None,
                   parent: tuple[str, str] | None = None,
                   references: Mapping[str, str] | None = None) -> DataFrame:
    """Q1-Q4 for a set of tables.

    tables      name -> (DataFrame, primary key)
    parent      (table name, key) that ``references`` point at
    references  child table name -> foreign-key column
    """
    parts = []
    if expectations is not None:
        parts.append(row_count_check({n: d for n, (d, _) in tables.items()}, expectations))
    for name, (df, key) in tables.items():
        parts.append(key_checks(df, key, name))
    if parent and references:
        pdf, pkey = tables[parent[0]][0], parent[1]
        for child, fk in references.items():
            parts.append(orphan_check(tables[child][0], pdf, fk, child, pkey))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*CHECK_COLUMNS)


def verdict(report: DataFrame) -> DataFrame:
    """Q5: one row ``checks, failed, all_passed``."""
    return report.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"),
    )


def raise_on_failure(report: DataFrame) -> None:
    """Optional hard stop: one aggregate row reaches the driver, not the report."""
    row = verdict(report).first()
    if not row["all_passed"]:
        raise AssertionError(f"{row['failed']} of {row['checks']} data-quality checks failed")
