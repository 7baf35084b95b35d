"""DuckDB SQL for the queries of ``plans.live``, from the source tables alone."""

from __future__ import annotations

from changelake.plans.oracles import (
    CDC_STATISTICS,
    COMMIT_ACTIVITY,
    EVENT_ISSUE_ANALYTICS,
    LANGUAGE_DISTRIBUTION,
    PULL_REQUEST_ANALYTICS,
    _FINAL_SELECT,
    _ISO,
    _PRIO,
    _REPOS,
)

STREAM_REPOSITORY_ANALYTICS = "WITH" + _REPOS.replace("\nr AS", "\nall_r AS") + """,
r AS (SELECT all_r.* REPLACE (CAST(stars + CASE WHEN stars < 0 THEN 1 ELSE 0 END AS INT) AS stars)
      FROM all_r WHERE repository_id % 10 <> 0),
c AS (SELECT user_id + CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS repository_id, count(*) AS commit_count
      FROM events WHERE event_type <> 'error' GROUP BY 1),
i AS (SELECT o_custkey + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS repository_id, count(*) AS issue_count,
             count(*) FILTER (WHERE o_orderstatus = 'O') AS open_issues,
             count(*) FILTER (WHERE o_orderstatus = 'F') AS closed_issues, avg(""" + _PRIO + """) AS av
      FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
u AS (SELECT max(l_suppkey) AS repository_id, min(l_linestatus) AS status FROM lineitem GROUP BY l_orderkey, l_linenumber),
p AS (SELECT repository_id, count(*) AS pull_request_count, count(*) FILTER (WHERE status <> 'F') AS open_pull_requests,
             count(*) FILTER (WHERE status = 'F') AS closed_pull_requests
      FROM u GROUP BY 1)""" + _FINAL_SELECT

STREAM_EVENT_ANALYTICS = f"""
SELECT * FROM ({COMMIT_ACTIVITY}) FULL JOIN ({EVENT_ISSUE_ANALYTICS}) USING (repository_id)
FULL JOIN ({PULL_REQUEST_ANALYTICS}) USING (repository_id)"""

_PULLS = "SELECT min(l_linestatus) AS status FROM lineitem GROUP BY l_orderkey, l_linenumber"
CDC_STATISTICS_REDELIVERED = f"""
SELECT 'repositories' AS table_name, 'r' AS operation, count(*) AS event_count FROM customer
UNION ALL SELECT 'repositories', 'u', count(*) FROM customer WHERE c_acctbal < 0 HAVING count(*) > 0
UNION ALL SELECT 'repositories', 'd', count(*) FROM customer WHERE c_custkey % 10 = 0 HAVING count(*) > 0
UNION ALL SELECT 'commits', 'c', count(*) FROM events
UNION ALL SELECT 'commits', 'u', count(*) FROM events WHERE event_type = 'purchase' HAVING count(*) > 0
UNION ALL SELECT 'commits', 'd', count(*) FROM events WHERE event_type = 'error' HAVING count(*) > 0
UNION ALL SELECT 'issues', 'c', count(*) FROM orders
UNION ALL SELECT 'issues', 'u', count(*) FILTER (WHERE o_orderstatus = 'F') + count(*) FILTER (WHERE o_orderstatus <> 'P' AND o_orderkey % 3 = 0)
          FROM orders
UNION ALL SELECT 'issues', 'd', count(*) FROM orders WHERE o_orderstatus = 'P' HAVING count(*) > 0
UNION ALL SELECT 'pull_requests', 'c', count(*) FROM ({_PULLS})
UNION ALL SELECT 'pull_requests', 'u', count(*) FROM ({_PULLS}) WHERE status = 'F' HAVING count(*) > 0"""

STREAM_NEWEST_PER_PARENT = """
WITH u AS (
  SELECT l_orderkey * 8 + l_linenumber AS pull_request_id,
         max(l_suppkey) + CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE 0 END AS repository_id,
         epoch_us(min(l_shipdate)) // 1000
           + 86400000 * CASE WHEN l_orderkey % 3 = 0 THEN 2 WHEN min(l_linestatus) = 'F' THEN 1 ELSE 0 END AS updated_ms
  FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING year(min(l_shipdate)) < 2000)
SELECT repository_id, pull_request_id, updated_ms FROM u WHERE repository_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY repository_id ORDER BY updated_ms DESC, pull_request_id DESC) <= 20"""

# ---- raw files (see plans.raw_files); k is the customer number of the parent
_NAMED = """
named AS (
  SELECT c_custkey AS k,
         CASE WHEN c_custkey % 80 = 40 THEN 'pair_' || ((c_custkey + 40) // 80) || '/x'
              WHEN c_custkey % 80 = 0 THEN 'pair/' || ((c_custkey + 40) // 80) || '_x'
              ELSE 'owner_' || c_nationkey || '/customer_' || c_custkey END AS full_name
  FROM customer)"""
#: Whether k's file name is that of two listed repositories.
_AMBIGUOUS = "(k % 40 = 0 AND EXISTS (FROM customer WHERE c_custkey = CASE WHEN k % 80 = 40 THEN k + 40 ELSE k - 40 END))"
_DOCS = "WITH" + _NAMED + """,
docs AS (
  SELECT o.*, k, full_name, o_orderkey % 2 = 0 AS even FROM orders o JOIN named ON k = o_custkey % 150 + 1
  WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')),
landed AS (
  SELECT *, 0 AS fetched, false AS again FROM docs WHERE even AND k % 50 <> 7
  UNION ALL SELECT *, 1, even FROM docs WHERE NOT even OR o_orderstatus = 'F'),
flat AS (SELECT * FROM landed WHERE NOT """ + _AMBIGUOUS + """)"""
_LATER = "'2030-01-01T00:00:00Z'"
_ISSUE_COLUMNS = """
       CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'closed' END AS state,
       CASE WHEN o_orderstatus <> 'P' THEN 'user_' || CAST(o_custkey AS VARCHAR) END AS author,
       CASE WHEN {late} THEN """ + _LATER + """ ELSE """ + _ISO.format(c="o_orderdate") + """ END AS created_at,
       CASE WHEN again THEN """ + _LATER + """ ELSE """ + _ISO.format(c="o_orderdate") + """ END AS updated_at,
       CASE WHEN o_orderstatus = 'F' THEN """ + _ISO.format(c="o_orderdate") + """ END AS closed_at,
       CAST(""" + _PRIO + """ AS BIGINT) AS comments,
       CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderstatus || '|' || o_orderpriority ELSE '' END AS labels,
       'https://example.org/issues/' || CAST(o_orderkey AS VARCHAR) AS url"""
_TITLE = "'order ' || CAST(o_orderkey AS VARCHAR) || CASE WHEN again THEN ' again' ELSE '' END AS title"

STREAM_RAW_ISSUES = _DOCS + f"""
SELECT o_orderkey AS issue_id, o_orderkey % 1000 AS issue_number,
       CASE WHEN k % 60 = 41 OR (k % 60 = 11 AND fetched = 0) THEN replace(full_name, '/', '_') ELSE full_name END AS repository,
       {_TITLE}, {_ISSUE_COLUMNS.format(late="again")}
FROM flat"""

# the last fetch of a row counts, but a row that the first load took keeps its creation time
RAW_LOAD_ISSUES = _DOCS + f""",
newest AS (SELECT * FROM flat WHERE k % 60 <> 41 QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY fetched DESC) = 1)
SELECT o_orderkey AS issue_id, o_orderkey % 1000 AS issue_number, k AS repository_id, {_TITLE},
       {_ISSUE_COLUMNS.format(late="again AND (k % 50 = 7 OR k % 60 = 11)")}
FROM newest"""

_PULLS_OF = """
pulls AS (SELECT l.*, k FROM lineitem l JOIN named ON k = l_suppkey
          QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_suppkey DESC, l_shipdate DESC) = 1)"""
_PULL_DOCS = "WITH" + _NAMED + "," + _PULLS_OF
RAW_LOAD_PULL_REQUESTS = _PULL_DOCS + """
SELECT CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS pull_request_id, CAST(l_linenumber AS BIGINT) AS number,
       k AS repository_id, 'line ' || CAST(l_orderkey AS VARCHAR) AS title, CAST(l_linenumber AS BIGINT) AS commits, CAST(0 AS BIGINT) AS deletions,
       """ + _ISO.format(c="l_shipdate") + """ AS updated_at, 'https://example.org/pulls/' || CAST(l_orderkey AS VARCHAR) AS url
FROM pulls WHERE NOT """ + _AMBIGUOUS + """ AND k % 60 <> 41"""

LOAD_REJECTS = _DOCS + "," + _PULLS_OF + """,
rejects AS (
  SELECT 'raw' AS stage, 'issues' AS table_name, 'ambiguous_parent' AS reject_reason FROM (
    SELECT k, even, o_orderstatus, 0 AS fetched FROM (SELECT o.*, k, o_orderkey % 2 = 0 AS even FROM orders o JOIN named ON k = o_custkey % 150 + 1)
      WHERE even AND k % 50 <> 7
    UNION ALL SELECT k, even, o_orderstatus, 1 FROM (SELECT o.*, k, o_orderkey % 2 = 0 AS even FROM orders o JOIN named ON k = o_custkey % 150 + 1)
      WHERE NOT even OR o_orderstatus = 'F') WHERE """ + _AMBIGUOUS + """
  UNION ALL SELECT 'raw', 'issues', 'malformed_page' FROM (SELECT DISTINCT k FROM orders JOIN named ON k = o_custkey % 150 + 1
                                                           WHERE o_orderkey % 2 = 0 AND k % 50 = 7)
  UNION ALL SELECT 'raw', 'pull_requests', 'ambiguous_parent' FROM pulls WHERE """ + _AMBIGUOUS + """
  UNION ALL SELECT 'load', 'issues', 'no_parent' FROM (SELECT DISTINCT o_orderkey FROM flat WHERE k % 60 = 41)
  UNION ALL SELECT 'load', 'pull_requests', 'no_parent' FROM pulls WHERE k % 60 = 41)
SELECT stage, table_name, reject_reason, count(*) AS rejected FROM rejects GROUP BY ALL"""

LOAD_PENDING = """
SELECT 'e' || CAST(event_id AS VARCHAR) AS commit_sha, CAST(user_id AS BIGINT) AS repository_id,
       'user_' || CAST(user_id AS VARCHAR) AS author, 'user_' || CAST(user_id AS VARCHAR) || '@example.org' AS author_email,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') AS commit_date, event_type AS message
FROM events JOIN customer ON c_custkey = user_id"""

LIVE_ORACLES: dict[str, str] = {
    "stream_newest_per_parent": STREAM_NEWEST_PER_PARENT,
    "stream_repository_analytics": STREAM_REPOSITORY_ANALYTICS,
    "stream_cdc_statistics": CDC_STATISTICS,
    "stream_event_analytics": STREAM_EVENT_ANALYTICS,
    "stream_language_distribution": LANGUAGE_DISTRIBUTION,
    "cdc_statistics_redelivered": CDC_STATISTICS_REDELIVERED,
    "stream_raw_issues": STREAM_RAW_ISSUES,
    "raw_load_issues": RAW_LOAD_ISSUES,
    "raw_load_pull_requests": RAW_LOAD_PULL_REQUESTS,
    "load_rejects": LOAD_REJECTS,
    "load_pending": LOAD_PENDING,
}
