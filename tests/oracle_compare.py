"""Run registered queries against their DuckDB oracle, the way the driver checks them.

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(float(v))
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark, sf_dir: str, name: str, query, sql: str | None, con) -> dict:
    t0 = time.time()
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    spark_s = time.time() - t0
    s_cols, s_rows = rows_of(df.columns, rows)
    out = {"name": name, "rows": len(rows), "spark_sec": round(spark_s, 2)}
    if sql is None:
        out["match"] = None
        return out
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_recs = res.fetchall()
    d_cols_s, d_rows = rows_of(d_cols, d_recs)
    out["oracle_rows"] = len(d_recs)
    out["columns_match"] = s_cols == d_cols_s
    out["match"] = out["columns_match"] and s_rows == d_rows
    if not out["match"]:
        out["spark_cols"] = s_cols
        out["oracle_cols"] = d_cols_s
        diff_s = list((s_rows - d_rows).items())[:3]
        diff_d = list((d_rows - s_rows).items())[:3]
        out["only_spark"] = diff_s
        out["only_oracle"] = diff_d
    return out


def main(argv: list[str]) -> int:
    from changelake.session import build_session
    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    if os.environ.get("PLAIN_SESSION"):  # the driver's own session, none of our settings
        from pyspark.sql import SparkSession

        spark = (SparkSession.builder.master("local[8]")
                 .config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    else:
        spark = build_session("local[8]", spark__sql__shuffle__partitions="8")
    tz = os.environ.get("SESSION_TZ")
    if tz:  # results must not depend on the session time zone
        spark.conf.set("spark.sql.session.timeZone", tz)
    con = duck(sf_dir)
    qs, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, q in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, sf_dir, name, q, oracles.get(name), con)
        except Exception as exc:  # noqa: BLE001
            r = {"name": name, "error": repr(exc)[:2000]}
        if r.get("match") is False or "error" in r:
            bad += 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
