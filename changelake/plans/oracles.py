"""Independent DuckDB SQL for each registered query (same names, same column aliases).

The oracle never goes through JSON: it computes from the source tables what the
Spark side must recover after encoding, parsing, routing and ranking.
"""

from __future__ import annotations

# Event log of ``repositories`` derived from ``events`` (see plans.testdata).
_EV = """
ev AS (
  SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000 AS ts_ms,
         CAST(props->>'$.k' AS INT) AS k
  FROM events)"""

_LOG = _EV + """,
log AS (
  SELECT CAST(event_id AS BIGINT) AS "offset",
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r'
                         WHEN 'error' THEN 'd' ELSE 'u' END AS operation,
         CAST(ts_ms AS BIGINT) AS event_timestamp,
         CAST(user_id % 4 AS INT) AS "partition",
         CAST(user_id AS BIGINT) AS repository_id,
         CASE WHEN event_type <> 'error' THEN 'repo_' || CAST(user_id AS VARCHAR) END AS name,
         CASE WHEN event_type <> 'error' THEN 'owner_' || CAST(user_id % 7 AS VARCHAR) || '/repo_'
                                              || CAST(user_id AS VARCHAR) END AS full_name,
         CASE WHEN event_type <> 'error' THEN 'owner_' || CAST(user_id % 7 AS VARCHAR) END AS owner,
         CASE WHEN event_type <> 'error' THEN event_type END AS description,
         CASE WHEN event_type <> 'error' AND k % 10 <> 0
              THEN ['Python', 'Scala', 'Java', 'Go', 'Rust'][k % 5 + 1] END AS language,
         CASE WHEN event_type <> 'error' THEN k END AS stars,
         CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS INT) END AS forks,
         CASE WHEN event_type <> 'error' THEN CAST(k % 7 AS INT) END AS open_issues,
         CASE WHEN event_type <> 'error' THEN CAST(user_id % 53 AS INT) END AS watchers,
         CASE WHEN event_type <> 'error' THEN event_type = 'purchase' END AS archived
  FROM ev)"""

_STATE_COLS = ('"offset", operation, event_timestamp, repository_id, name, full_name, owner, '
               'description, language, stars, forks, open_issues, watchers, archived')

_CUR = _LOG + """,
cur AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY repository_id
                                 ORDER BY event_timestamp DESC, "partition" DESC, "offset" DESC) AS rn
    FROM log)
  WHERE rn = 1 AND operation <> 'd')"""

_REPOS = """
r AS (
  SELECT c_custkey AS repository_id,
         'owner_' || CAST(c_nationkey AS VARCHAR) || '/' || c_name AS full_name,
         'owner_' || CAST(c_nationkey AS VARCHAR) AS owner,
         c_mktsegment AS language,
         CAST(round(c_acctbal * 100) AS INT) AS stars,
         CAST(c_custkey % 97 AS INT) AS forks,
         CAST(c_custkey % 53 AS INT) AS watchers,
         CAST(c_custkey % 11 AS INT) AS github_open_issues
  FROM customer)"""

_PRIO = "CAST(regexp_extract(o_orderpriority, '^(\\d+)', 1) AS INT)"

# Spark rounds the decimal text of a double (HALF_UP); a decimal cast does the same here.
_ROUND2 = "CAST(round(CAST({x} AS DECIMAL(38, 12)), 2) AS DOUBLE)"

_FINAL_SELECT = """
SELECT r.repository_id, r.full_name, r.owner, r.language, r.stars, r.forks, r.watchers,
       r.github_open_issues,
       CAST(coalesce(c.commit_count, 0) AS BIGINT) AS commit_count,
       CAST(coalesce(i.issue_count, 0) AS BIGINT) AS issue_count,
       CAST(coalesce(i.open_issues, 0) AS BIGINT) AS open_issues,
       CAST(coalesce(i.closed_issues, 0) AS BIGINT) AS closed_issues,
       """ + _ROUND2.format(x="coalesce(i.av, 0.0)") + """ AS average_issue_comments,
       CAST(coalesce(p.pull_request_count, 0) AS BIGINT) AS pull_request_count,
       CAST(coalesce(p.open_pull_requests, 0) AS BIGINT) AS open_pull_requests,
       CAST(coalesce(p.closed_pull_requests, 0) AS BIGINT) AS closed_pull_requests
FROM r LEFT JOIN c USING (repository_id) LEFT JOIN i USING (repository_id)
       LEFT JOIN p USING (repository_id)"""

REPOSITORY_ANALYTICS = "WITH" + _REPOS + """,
c AS (SELECT user_id AS repository_id, count(*) AS commit_count FROM events GROUP BY 1),
i AS (SELECT o_custkey AS repository_id, count(*) AS issue_count,
             count(*) FILTER (WHERE o_orderstatus = 'O') AS open_issues,
             count(*) FILTER (WHERE o_orderstatus = 'F') AS closed_issues,
             avg(""" + _PRIO + """) AS av
      FROM orders GROUP BY 1),
p AS (SELECT l_suppkey AS repository_id, count(*) AS pull_request_count,
             count(*) FILTER (WHERE l_linestatus = 'O') AS open_pull_requests,
             count(*) FILTER (WHERE l_linestatus <> 'O') AS closed_pull_requests
      FROM lineitem GROUP BY 1)""" + _FINAL_SELECT

TOP_REPOSITORIES = "WITH" + _REPOS + """
SELECT repository_id, full_name, language, stars, forks FROM r
ORDER BY stars DESC, repository_id LIMIT 20"""

ENVELOPE_PARSE = "WITH" + _LOG + """
SELECT * FROM log"""

CURRENT_STATE = "WITH" + _CUR + f"""
SELECT {_STATE_COLS} FROM cur"""

DEAD_LETTERS = "WITH" + _EV + """
SELECT 'repositories' AS table_name, reject_reason, count(*) AS records FROM (
  SELECT 'tombstone' AS reject_reason FROM ev WHERE event_type = 'error'
  UNION ALL SELECT 'malformed' FROM ev WHERE event_type <> 'error' AND k = 13
  UNION ALL SELECT 'no_key' FROM ev WHERE event_type <> 'error' AND k = 17
  UNION ALL SELECT 'no_operation' FROM ev WHERE event_type <> 'error' AND k = 19)
GROUP BY reject_reason"""

TOPIC_ROUTING = """
SELECT 'repositories' AS table_name, 'r' AS operation, count(*) AS records FROM customer
UNION ALL SELECT 'commits', 'c', count(*) FROM events
UNION ALL SELECT 'issues', 'c', count(*) FROM orders
UNION ALL SELECT 'issues', 'u', count(*) FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'issues', 'd', count(*) FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'pull_requests', 'c', count(*) FROM lineitem
UNION ALL SELECT 'pull_requests', 'u', count(*) FROM lineitem WHERE l_linestatus = 'F'"""

CDC_STATISTICS = """
SELECT table_name, operation, records AS event_count FROM (""" + TOPIC_ROUTING + """
  UNION ALL SELECT NULL, NULL, count(*) FROM orders WHERE o_orderstatus = 'P')"""

EVENT_POPULARITY = "WITH" + _LOG + """
SELECT repository_id, name, full_name, owner, language, stars, forks, open_issues, watchers
FROM log WHERE operation <> 'd'"""

LANGUAGE_DISTRIBUTION = "WITH" + _LOG + """
SELECT language, count(*) AS repository_count, avg(stars) AS average_stars,
       CAST(sum(stars) AS BIGINT) AS total_stars
FROM log WHERE operation <> 'd' AND language IS NOT NULL GROUP BY language"""

COMMIT_ACTIVITY = """
SELECT user_id AS repository_id, count(*) AS commit_count FROM events GROUP BY 1"""

EVENT_ISSUE_ANALYTICS = """
WITH ie AS (
  SELECT o_custkey AS repository_id, 'open' AS state, """ + _PRIO + """ AS comments FROM orders
  UNION ALL
  SELECT o_custkey, 'closed', """ + _PRIO + """ FROM orders WHERE o_orderstatus = 'F')
SELECT repository_id, count(*) AS issue_count,
       count(*) FILTER (WHERE state = 'open') AS open_issues,
       count(*) FILTER (WHERE state = 'closed') AS closed_issues,
       avg(comments) AS average_comments
FROM ie GROUP BY 1"""

PULL_REQUEST_ANALYTICS = """
WITH pe AS (
  SELECT l_suppkey AS repository_id, 'open' AS state FROM lineitem
  UNION ALL SELECT l_suppkey, 'closed' FROM lineitem WHERE l_linestatus = 'F')
SELECT repository_id, count(*) AS pull_request_count,
       count(*) FILTER (WHERE state = 'open') AS open_pull_requests,
       count(*) FILTER (WHERE state = 'closed') AS closed_pull_requests
FROM pe GROUP BY 1"""

# Pull-request state: newest event per id; repeated ids resolve on content.
_PR_STATE = """
pe AS (
  SELECT l_orderkey * 8 + l_linenumber AS pr_id, epoch_us(l_shipdate) // 1000 AS ts,
         l_orderkey * 16 + l_linenumber * 2 AS off, l_suppkey AS repository_id, 'open' AS state
  FROM lineitem
  UNION ALL
  SELECT l_orderkey * 8 + l_linenumber, epoch_us(l_shipdate) // 1000 + 86400000,
         l_orderkey * 16 + l_linenumber * 2 + 1, l_suppkey, 'closed'
  FROM lineitem WHERE l_linestatus = 'F'),
ps AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY pr_id
                                 ORDER BY ts DESC, off DESC, repository_id DESC, state DESC) AS rn
    FROM pe)
  WHERE rn = 1)"""

CDC_REPOSITORY_ANALYTICS = "WITH" + _REPOS + "," + _PR_STATE + """,
c AS (SELECT user_id AS repository_id, count(*) AS commit_count FROM events GROUP BY 1),
i AS (SELECT o_custkey AS repository_id, count(*) AS issue_count,
             count(*) FILTER (WHERE o_orderstatus = 'O') AS open_issues,
             count(*) FILTER (WHERE o_orderstatus = 'F') AS closed_issues,
             avg(""" + _PRIO + """) AS av
      FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
p AS (SELECT repository_id, count(*) AS pull_request_count,
             count(*) FILTER (WHERE state = 'open') AS open_pull_requests,
             count(*) FILTER (WHERE state = 'closed') AS closed_pull_requests
      FROM ps GROUP BY 1)""" + _FINAL_SELECT


def _profile(name: str, keys_sql: str) -> str:
    return f"""
SELECT '{name}' AS table_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS row_count,
       count(*) FILTER (WHERE n > 1) AS duplicate_keys,
       CAST(coalesce(sum(n) FILTER (WHERE k IS NULL), 0) AS BIGINT) AS null_keys
FROM (SELECT k, count(*) AS n FROM ({keys_sql}) GROUP BY k)"""


QUALITY_PROFILE = "WITH" + _EV + ", rc AS (" + """
  SELECT user_id AS k FROM ev
  UNION ALL SELECT user_id FROM ev WHERE event_type <> 'error' AND k = 19
  UNION ALL SELECT NULL FROM ev WHERE event_type = 'error'
  UNION ALL SELECT NULL FROM ev WHERE event_type <> 'error' AND k IN (13, 17))""" + \
    _profile("repositories", "SELECT c_custkey AS k FROM customer") + " UNION ALL " + \
    _profile("commits", "SELECT 'e' || CAST(event_id AS VARCHAR) AS k FROM events") + " UNION ALL " + \
    _profile("issues", "SELECT o_orderkey AS k FROM orders") + " UNION ALL " + \
    _profile("pull_requests", "SELECT l_orderkey * 8 + l_linenumber AS k FROM lineitem") + " UNION ALL " + \
    _profile("repository_changes", "SELECT k FROM rc")


def _orphans(table: str, keys_sql: str, parent_sql: str) -> str:
    return f"""
SELECT '{table}' AS table_name, 'orphan_keys' AS check_name, 'repository_id' AS column_name,
       count(*) AS observed, CAST(0 AS BIGINT) AS expected, count(*) = 0 AS passed
FROM (SELECT DISTINCT k FROM ({keys_sql}) WHERE k NOT IN ({parent_sql}))"""


QUALITY_ORPHANS = "WITH" + _CUR + " " + " UNION ALL ".join([
    _orphans("commits", "SELECT user_id AS k FROM events", "SELECT repository_id FROM cur"),
    _orphans("issues", "SELECT o_custkey AS k FROM orders", "SELECT repository_id FROM cur"),
    _orphans("pull_requests", "SELECT l_suppkey AS k FROM lineitem", "SELECT repository_id FROM cur"),
])

_COUNTS = """
WITH cnt AS (
  SELECT 'repositories' AS t, (SELECT count(*) FROM customer) AS n
  UNION ALL SELECT 'commits', (SELECT count(*) FROM events)
  UNION ALL SELECT 'issues', (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P')
  UNION ALL SELECT 'pull_requests',
                   (SELECT count(DISTINCT l_orderkey * 8 + l_linenumber) FROM lineitem)),
keys AS (
  SELECT 'repositories' AS t, 'repository_id' AS k UNION ALL SELECT 'commits', 'commit_sha'
  UNION ALL SELECT 'issues', 'issue_id' UNION ALL SELECT 'pull_requests', 'pull_request_id'),
report AS (
  SELECT t AS table_name, 'row_count' AS check_name, CAST(NULL AS VARCHAR) AS column_name,
         CAST(n AS BIGINT) AS observed, CAST(n AS BIGINT) AS expected, true AS passed FROM cnt
  UNION ALL SELECT t, 'duplicate_keys', k, CAST(0 AS BIGINT), CAST(0 AS BIGINT), true FROM keys
  UNION ALL SELECT t, 'null_keys', k, CAST(0 AS BIGINT), CAST(0 AS BIGINT), true FROM keys
  UNION ALL SELECT t, 'orphan_keys', 'repository_id', CAST(0 AS BIGINT), CAST(0 AS BIGINT), true
            FROM keys WHERE t <> 'repositories')"""

QUALITY_REPORT = _COUNTS + "\nSELECT * FROM report"

QUALITY_VERDICT = _COUNTS + """
SELECT count(*) AS checks, count(*) FILTER (WHERE NOT passed) AS failed,
       bool_and(passed) AS all_passed FROM report"""

_FAILURES = "WITH" + _CUR + """,
cm AS (
  SELECT CASE event_type WHEN 'error' THEN NULL WHEN 'purchase' THEN 'u' || CAST(user_id AS VARCHAR)
                         ELSE 'e' || CAST(event_id AS VARCHAR) END AS k,
         CASE WHEN event_type <> 'signup' THEN user_id END AS fk
  FROM events),
prof AS (""" + _profile("repositories", "SELECT repository_id AS k FROM cur") + " UNION ALL " + \
    _profile("commits", "SELECT k FROM cm") + """),
named AS (SELECT *, CASE table_name WHEN 'commits' THEN 'commit_sha' ELSE 'repository_id' END AS key FROM prof),
checks AS (
  SELECT table_name, 'row_count' AS check_name, CAST(NULL AS VARCHAR) AS column_name, row_count AS observed,
         CASE table_name WHEN 'commits' THEN (SELECT count(*) FROM events) ELSE (SELECT count(*) FROM customer) END AS expected
  FROM prof
  UNION ALL SELECT 'releases', 'row_count', NULL, CAST(NULL AS BIGINT), CAST(0 AS BIGINT)
  UNION ALL SELECT table_name, 'duplicate_keys', key, duplicate_keys, 0 FROM named
  UNION ALL SELECT table_name, 'null_keys', key, null_keys, 0 FROM named
  UNION ALL SELECT 'commits', 'orphan_keys', 'repository_id',
                   (SELECT count(*) FROM (SELECT DISTINCT fk FROM cm
                                          WHERE fk IS NULL OR fk NOT IN (SELECT repository_id FROM cur))), 0),
report AS (SELECT *, observed IS NOT DISTINCT FROM expected AS passed FROM checks)"""

QUALITY_FAILURES = _FAILURES + "\nSELECT * FROM report"

QUALITY_VERDICT_FAILURES = _FAILURES + """
SELECT count(*) AS checks, count(*) FILTER (WHERE NOT passed) AS failed,
       bool_and(passed) AS all_passed FROM report"""

_ISO = "strftime({c}, '%Y-%m-%dT%H:%M:%SZ')"

RAW_REPOSITORY_TRANSFORM = """
SELECT c_custkey AS repository_id, c_name AS name,
       'owner_' || CAST(c_nationkey AS VARCHAR) || '/' || c_name AS full_name,
       CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN 'owner_' || CAST(c_nationkey AS VARCHAR) END AS owner,
       c_mktsegment AS language, CAST(round(c_acctbal * 100) AS BIGINT) AS stars,
       c_custkey % 97 AS forks, c_custkey % 11 AS open_issues, c_custkey % 53 AS watchers,
       c_custkey AS size, c_acctbal < 0 AS archived,
       CASE WHEN c_acctbal >= 0 THEN lower(c_mktsegment) || '|derived' ELSE '' END AS topics,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN 'MIT' END AS license
FROM customer"""

RAW_COMMIT_TRANSFORM = """
SELECT 'e' || CAST(event_id AS VARCHAR) AS commit_sha, 'repo_' || CAST(user_id AS VARCHAR) AS repository,
       CASE WHEN event_type IN ('view', 'click') THEN 'name_' ELSE 'user_' END
         || CAST(user_id AS VARCHAR) AS author,
       'user_' || CAST(user_id AS VARCHAR) || '@example.org' AS author_email,
       """ + _ISO.format(c="ts") + """ AS commit_date, event_type AS message
FROM events"""

RAW_ISSUE_TRANSFORM = """
SELECT o_orderkey AS issue_id, o_orderkey % 1000 AS issue_number,
       'customer_' || CAST(o_custkey AS VARCHAR) AS repository,
       'order ' || CAST(o_orderkey AS VARCHAR) AS title,
       CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'closed' END AS state,
       CASE WHEN o_orderstatus <> 'P' THEN 'user_' || CAST(o_custkey AS VARCHAR) END AS author,
       """ + _ISO.format(c="o_orderdate") + """ AS created_at,
       CASE WHEN o_orderstatus = 'F' THEN """ + _ISO.format(c="o_orderdate") + """ END AS closed_at,
       CAST(regexp_extract(o_orderpriority, '^(\\d+)', 1) AS BIGINT) AS comments,
       CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderstatus || '|' || o_orderpriority ELSE '' END AS labels,
       'https://example.org/issues/' || CAST(o_orderkey AS VARCHAR) AS url
FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')"""

RAW_PULL_REQUEST_TRANSFORM = """
SELECT 'supplier_' || CAST(l_suppkey AS VARCHAR) AS repository, count(*) AS pull_requests,
       count(*) FILTER (WHERE l_returnflag = 'R') AS merged,
       count(*) FILTER (WHERE l_linestatus = 'F') AS closed,
       CAST(sum(CAST(floor(l_quantity) AS BIGINT)) AS BIGINT) AS additions,
       CAST(sum(CAST(floor(l_tax * 100) AS BIGINT)) AS BIGINT) AS review_comments
FROM lineitem GROUP BY 1"""

TRANSFORM_TOTALS = """
SELECT 'customer_' || CAST(o_custkey AS VARCHAR) AS repository,
       count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS issues,
       count(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) AS pull_requests_skipped
FROM orders GROUP BY 1"""

RESOLVE_KEYS = "WITH" + _CUR + """
SELECT 'e' || CAST(event_id AS VARCHAR) AS commit_sha, user_id AS repository_id, event_type AS message
FROM events WHERE user_id IN (SELECT repository_id FROM cur)"""

RESOLVE_REJECTS = "WITH" + _CUR + """
SELECT 'e' || CAST(event_id AS VARCHAR) AS commit_sha,
       'owner_' || CAST(user_id % 7 AS VARCHAR) || '/repo_' || CAST(user_id AS VARCHAR) AS repository
FROM events WHERE user_id NOT IN (SELECT repository_id FROM cur)"""

UPSERT = """
SELECT p_partkey,
       CASE WHEN p_size > 45 AND p_type = 'PROMO' THEN upper(p_name) ELSE p_name END AS p_name,
       p_brand, p_type, p_size,
       CASE WHEN p_brand <> 'Brand#13' AND p_type = 'PROMO' THEN p_retailprice + 1
            ELSE p_retailprice END AS p_retailprice
FROM part WHERE p_size <= 45 OR p_brand <> 'Brand#13'"""

UPSERT_ALL_MUTABLE = """
SELECT p_partkey,
       CASE WHEN p_brand <> 'Brand#13' AND p_type = 'PROMO' THEN upper(p_name) ELSE p_name END AS p_name,
       p_brand, p_type, p_size,
       CASE WHEN p_brand <> 'Brand#13' AND p_type = 'PROMO' THEN p_retailprice + 1
            ELSE p_retailprice END AS p_retailprice
FROM part WHERE p_size <= 45 OR p_brand <> 'Brand#13'"""

SNAPSHOT_DIFF = """
SELECT p_partkey,
       CASE WHEN p_size > 45 THEN 'c' WHEN p_brand = 'Brand#13' THEN 'd' ELSE 'u' END AS operation,
       CASE WHEN p_size <= 45 THEN p_retailprice END AS before_price,
       CASE WHEN p_brand <> 'Brand#13' THEN
            CASE WHEN p_type = 'PROMO' THEN p_retailprice + 1 ELSE p_retailprice END END AS after_price,
       CASE WHEN p_size <= 45 THEN p_name END AS before_name,
       CASE WHEN p_brand <> 'Brand#13' THEN
            CASE WHEN p_type = 'PROMO' THEN upper(p_name) ELSE p_name END END AS after_name
FROM part
WHERE (p_size > 45 AND p_brand <> 'Brand#13') OR (p_size <= 45 AND p_brand = 'Brand#13')
   OR (p_size <= 45 AND p_brand <> 'Brand#13' AND p_type = 'PROMO')"""

APPLY_DIFF = """
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN upper(p_name) ELSE p_name END AS p_name,
       p_brand, p_type, p_size,
       CASE WHEN p_type = 'PROMO' THEN p_retailprice + 1 ELSE p_retailprice END AS p_retailprice
FROM part WHERE p_brand <> 'Brand#13'"""

NEWEST_PER_PARENT = """
SELECT repository_id, pull_request_id, updated_ms FROM (
  SELECT l_suppkey AS repository_id, l_orderkey * 8 + l_linenumber AS pull_request_id,
         epoch_us(l_shipdate) // 1000 AS updated_ms,
         row_number() OVER (PARTITION BY l_suppkey
                            ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn
  FROM lineitem)
WHERE rn <= 100"""

STREAM_ARCHIVE = """
SELECT 'repositories' AS table_name, count(*) AS records, CAST(0 AS BIGINT) AS tombstones FROM customer
UNION ALL SELECT 'commits', count(*), 0 FROM events
UNION ALL SELECT 'issues',
  (SELECT count(*) FROM orders) + (SELECT count(*) FROM orders WHERE o_orderstatus IN ('F', 'P'))
  + (SELECT count(*) FROM orders WHERE o_orderstatus = 'P'),
  (SELECT count(*) FROM orders WHERE o_orderstatus = 'P')
UNION ALL SELECT 'pull_requests',
  (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM lineitem WHERE l_linestatus = 'F'), 0"""

ORACLES: dict[str, str] = {
    "repository_analytics": REPOSITORY_ANALYTICS,
    "top_repositories": TOP_REPOSITORIES,
    "envelope_parse": ENVELOPE_PARSE,
    "current_state": CURRENT_STATE,
    "current_state_late": CURRENT_STATE,
    "current_state_faulty": CURRENT_STATE,
    "dead_letters": DEAD_LETTERS,
    "topic_routing": TOPIC_ROUTING,
    "cdc_statistics": CDC_STATISTICS,
    "event_popularity": EVENT_POPULARITY,
    "language_distribution": LANGUAGE_DISTRIBUTION,
    "commit_activity": COMMIT_ACTIVITY,
    "event_issue_analytics": EVENT_ISSUE_ANALYTICS,
    "pull_request_analytics": PULL_REQUEST_ANALYTICS,
    "cdc_repository_analytics": CDC_REPOSITORY_ANALYTICS,
    "quality_profile": QUALITY_PROFILE,
    "quality_orphans": QUALITY_ORPHANS,
    "quality_report": QUALITY_REPORT,
    "quality_verdict": QUALITY_VERDICT,
    "quality_failures": QUALITY_FAILURES,
    "quality_verdict_failures": QUALITY_VERDICT_FAILURES,
    "raw_repository_transform": RAW_REPOSITORY_TRANSFORM,
    "raw_commit_transform": RAW_COMMIT_TRANSFORM,
    "raw_issue_transform": RAW_ISSUE_TRANSFORM,
    "raw_pull_request_transform": RAW_PULL_REQUEST_TRANSFORM,
    "transform_totals": TRANSFORM_TOTALS,
    "resolve_keys": RESOLVE_KEYS,
    "resolve_rejects": RESOLVE_REJECTS,
    "upsert": UPSERT,
    "upsert_all_mutable": UPSERT_ALL_MUTABLE,
    "load_versions": UPSERT,
    "snapshot_diff": SNAPSHOT_DIFF,
    "apply_diff": APPLY_DIFF,
    "newest_per_parent": NEWEST_PER_PARENT,
    "diff_envelope_state": APPLY_DIFF,
    "upsert_deduplicated": UPSERT,
    "stream_current_state": CURRENT_STATE,
    "stream_normalise": ENVELOPE_PARSE,
    "stream_archive": STREAM_ARCHIVE,
    "stream_dead_letters": DEAD_LETTERS,
    "staged_repository_analytics": CDC_REPOSITORY_ANALYTICS,
}
