"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and executed in full with the ``noop`` sink (every row produced,
nothing collected), twice: ``cold_queries`` holds the first run (JIT and file listing
included), ``queries`` the second. ``value`` is the sum of the second runs. Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from changelake.plans import catalog  # noqa: E402
from changelake.session import build_session  # noqa: E402

HEADLINE = (
    "repository_analytics",
    "cdc_repository_analytics",
    "envelope_parse",
    "current_state",
    "current_state_late",
    "dead_letters",
    "cdc_statistics",
    "language_distribution",
    "event_issue_analytics",
    "pull_request_analytics",
    "quality_profile",
    "quality_report",
    "raw_issue_transform",
    "resolve_keys",
    "upsert",
    "snapshot_diff",
    "newest_per_parent",
    "stream_current_state",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(HEADLINE)
    spark = build_session(f"local[{cpus}]", app="changelake-bench",
                          **{"spark__sql__shuffle__partitions": str(max(8, int(cpus) * 2)),
                             "spark__driver__memory": "16g"})
    run(catalog.QUERIES["top_repositories"](spark, sf_dir))  # warm-up (JIT, file listing)
    cold, times, errors = {}, {}, {}
    for name in names:
        for target in (cold, times):
            t0 = time.perf_counter()
            try:
                run(catalog.QUERIES[name](spark, sf_dir))
            except Exception as exc:  # keep the JSON line; report the failure
                errors[name] = repr(exc)[:300]
                break
            target[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_query_seconds_warm",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold_total": round(sum(cold.values()), 3),
        "cold_queries": cold,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        **({"errors": errors} if errors else {}),
    }))


if __name__ == "__main__":
    main()
