"""DuckDB SQL for the queries of ``plans.upkeep``, from the source tables alone."""

from __future__ import annotations

from changelake.plans.oracles import _EV, CDC_STATISTICS, CURRENT_STATE, SNAPSHOT_DIFF


def _field(status: str, field: str, kind: str, condition: str) -> str:
    return f"""
SELECT 'repositories' AS table_name, '{status}' AS status, {field} AS field, {kind} AS type,
       count(*) AS records, CAST(min(ts_ms) AS BIGINT) AS first_seen_ms
FROM img WHERE {condition} HAVING count(*) > 0"""


SCHEMA_DRIFT = "WITH" + _EV + ", img AS (SELECT * FROM ev WHERE event_type <> 'error')" + " UNION ALL ".join([
    _field("new", "'visibility'", "'STRING'", "k <> 13 AND k % 4 = 1"),
    _field("new", "'size'", "'OBJECT<kb: BIGINT>'", "k <> 13 AND k % 4 = 2"),
    _field("new", "'rate'", "'DECIMAL(2,1)'", "k <> 13 AND k % 8 = 3"),
    _field("new", "'note'", "CASE WHEN bool_and(k > 50) THEN 'STRING' WHEN bool_and(k <= 50) THEN 'BIGINT' ELSE 'VARIANT' END",
           "k <> 13 AND k % 8 = 7"),
    _field("mistyped", "'stars'", "'STRING'", "k <> 13 AND k % 5 = 0"),
    _field("mistyped", "'watchers'", "'BIGINT'", "k <> 13 AND user_id % 53 = 7"),
    _field("unreadable", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", "k = 13"),
])

UPKEEP_ORACLES: dict[str, str] = {
    "cdc_statistics_compacted": CDC_STATISTICS,
    "schema_drift": SCHEMA_DRIFT,
    "dead_letter_redrive": CURRENT_STATE,
    "snapshot_diff_digest": SNAPSHOT_DIFF,
}
