"""The driver's test tables seen as the reference's four tables and their change streams.

Every function reads the given parquet tables and derives from them with Spark
expressions, so the work grows with the tables. The mapping (fixed, mirrored by the
oracle SQL in ``plans.oracles``):

repositories   customer: id c_custkey, name c_name, owner 'owner_'||c_nationkey,
               full_name owner||'/'||c_name, language c_mktsegment, stars = acctbal in
               cents, forks c_custkey%97, watchers c_custkey%53, open_issues c_custkey%11
commits        events: sha 'e'||event_id, repository_id user_id, message event_type
issues         orders: id o_orderkey, repository_id o_custkey, state O open, F closed,
               P pending, comments = leading digit of o_orderpriority
pull_requests  lineitem: id l_orderkey*8+l_linenumber (not unique: the table has
               repeated pairs), repository_id l_suppkey, state O open, F closed

Change streams:

repository log  one event per ``events`` row, key user_id; signup c, view r, click and
                purchase u, error d; offset event_id, partition user_id%4, time ts;
                every odd event_id is wrapped under ``payload``
activity stream four topics: customer snapshot (r); commits created (c) per event;
                issues created (c) at o_orderdate, then closed (u, F) or deleted (d, P)
                one day later; pull requests created (c) at l_shipdate and closed
                (u) one day later when l_linestatus is F; each delete is followed by
                a tombstone (NULL value) as a log-compacted topic would carry
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.functions import rows
from changelake.functions.envelope import encode_envelope
from changelake.functions.text import leading_int
from changelake.schemas import COMMITS, ISSUES, PULL_REQUESTS, REPOSITORIES, TableSpec

DAY_MS = 86_400_000
# Snapshot time of the customer snapshot (2024-01-01T00:00:00Z) and
# the languages assigned to derived repositories.
SNAPSHOT_MS = 1_704_067_200_000
LANGUAGES = ("Python", "Scala", "Java", "Go", "Rust")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Spread source rows over partitions by a unique column (no hot partition even when
    one entity owns a third of the rows), as a producer spreads a topic."""
    return df.repartition(*[F.col(k) for k in keys])


def epoch_millis(ts: str) -> Column:
    """Epoch milliseconds of a ``timestamp_ntz`` column read as UTC wall-clock time.

    Built from the date and time fields, which for ``timestamp_ntz`` never consult the
    session time zone (a cast to ``timestamp`` would, and would shift across DST).
    """
    return F.expr(
        f"(unix_date(cast({ts} AS DATE)) * 86400000000L + hour({ts}) * 3600000000L"
        f" + minute({ts}) * 60000000L + cast(extract(SECOND FROM {ts}) * 1000000 AS BIGINT)) div 1000")


def kafka_time(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def row_struct(spec: TableSpec, values: dict[str, Column]) -> Column:
    """A row image with exactly ``spec``'s schema; missing columns are NULL."""
    fields = []
    for f in spec.row_schema.fields:
        v = values.get(f.name, F.lit(None))
        fields.append(v.cast(f.dataType).alias(f.name))
    return F.struct(*fields)


def records(spec: TableSpec, op: Column, ts_ms: Column, before: Column, after: Column,
            partition: Column, offset: Column, key: Column, wrapped: Column | bool = False,
            tombstone: Column | None = None) -> list[Column]:
    """Columns of a Kafka-shaped record for one change."""
    value = encode_envelope(op, ts_ms, before, after, wrapped)
    if tombstone is not None:
        value = F.when(~tombstone, value)
    return [
        F.lit(spec.topic()).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        kafka_time(ts_ms).alias("timestamp"),
        F.to_json(F.struct(key.alias(spec.key))).alias("key"),
        value.alias("value"),
    ]


def emit(df: DataFrame, outputs: list[tuple[Column, list[Column]]]) -> DataFrame:
    """Zero or more records per source row, from one scan: ``(condition, record columns)``.

    All outputs share one topic. It stays a plain literal column outside the generated
    struct, so a route filter on the topic still folds to a constant and prunes this
    branch instead of generating and discarding its records.
    """
    topic = outputs[0][1][0]            # records() puts the topic literal first
    return rows.emit(df, [(cond, cols[1:]) for cond, cols in outputs], topic)


# ---------------------------------------------------------------------------------------
# Tables in the shape of the current state (direct mapping)
# ---------------------------------------------------------------------------------------
def repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    owner = F.concat(F.lit("owner_"), F.col("c_nationkey").cast("string"))
    return c.select(
        F.col("c_custkey").alias("repository_id"),
        F.col("c_name").alias("name"),
        F.concat(owner, F.lit("/"), F.col("c_name")).alias("full_name"),
        owner.alias("owner"),
        F.concat(F.lit("segment "), F.col("c_mktsegment")).alias("description"),
        F.col("c_mktsegment").alias("language"),
        F.round(F.col("c_acctbal") * 100).cast("int").alias("stars"),
        (F.col("c_custkey") % 97).cast("int").alias("forks"),
        (F.col("c_custkey") % 11).cast("int").alias("open_issues"),
        (F.col("c_custkey") % 53).cast("int").alias("watchers"),
        (F.col("c_acctbal") < 0).alias("archived"),
    )


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("commit_sha"),
        F.col("user_id").alias("repository_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("author"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string"), F.lit("@example.org")).alias("author_email"),
        F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("commit_date"),
        F.col("event_type").alias("message"),
    )


def _issue_state(status: Column) -> Column:
    return (F.when(status == "O", F.lit("open"))
             .when(status == "F", F.lit("closed"))
             .otherwise(F.lit("pending")))


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("issue_id"),
        (F.col("o_orderkey") % 1000).cast("int").alias("issue_number"),
        F.col("o_custkey").alias("repository_id"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("title"),
        _issue_state(F.col("o_orderstatus")).alias("state"),
        F.concat(F.lit("user_"), F.col("o_custkey").cast("string")).alias("author"),
        leading_int("o_orderpriority").alias("comments"),
        F.concat(F.lit("https://example.org/issues/"), F.col("o_orderkey").cast("string")).alias("url"),
    )


def _pr_images(li: DataFrame) -> dict[str, Column]:
    return {
        "pull_request_id": F.col("l_orderkey") * 8 + F.col("l_linenumber"),
        "number": F.col("l_linenumber"),
        "repository_id": F.col("l_suppkey"),
        "title": F.concat(F.lit("line "), F.col("l_orderkey").cast("string")),
        "author": F.concat(F.lit("supplier_"), F.col("l_suppkey").cast("string")),
        "comments": F.floor(F.col("l_quantity")),
        "review_comments": F.floor(F.col("l_tax") * 100),
        "commits": F.col("l_linenumber"),
        "changed_files": F.floor(F.col("l_discount") * 100),
        "additions": F.floor(F.col("l_quantity")),
        "deletions": F.lit(0),
        "url": F.concat(F.lit("https://example.org/pulls/"), F.col("l_orderkey").cast("string")),
    }


def pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    img = _pr_images(li)
    img["state"] = F.when(F.col("l_linestatus") == "O", F.lit("open")).otherwise(F.lit("closed"))
    return li.select(*[img[c].cast(t.dataType).alias(c) for c, t in
                       ((f.name, f) for f in PULL_REQUESTS.row_schema.fields)])


# ---------------------------------------------------------------------------------------
# Repository change log derived from ``events``
# ---------------------------------------------------------------------------------------
def _event_k() -> Column:
    return F.from_json(F.col("props"), "k int")["k"]


def event_operation(event_type: Column) -> Column:
    return (F.when(event_type == "signup", F.lit("c"))
             .when(event_type == "view", F.lit("r"))
             .when(event_type == "error", F.lit("d"))
             .otherwise(F.lit("u")))


def _language(k: Column) -> Column:
    pick = F.element_at(F.array(*[F.lit(x) for x in LANGUAGES]), (k % len(LANGUAGES) + 1).cast("int"))
    return F.when(k % 10 == 0, F.lit(None).cast("string")).otherwise(pick)


def repository_image_from_event(user_id: Column, event_type: Column, value: Column, k: Column) -> Column:
    owner = F.concat(F.lit("owner_"), (user_id % 7).cast("string"))
    name = F.concat(F.lit("repo_"), user_id.cast("string"))
    return row_struct(REPOSITORIES, {
        "repository_id": user_id,
        "name": name,
        "full_name": F.concat(owner, F.lit("/"), name),
        "owner": owner,
        "description": event_type,
        "language": _language(k),
        "stars": k,
        "forks": F.floor(value),
        "open_issues": k % 7,
        "watchers": user_id % 53,
        "archived": event_type == "purchase",
    })


def repository_change_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped change records of ``repositories``, one per event."""
    e = by_key(table(spark, sf_dir, "events"), "event_id").select(
        "event_id", "user_id", "event_type", "value", epoch_millis("ts").alias("ts_ms"),
        _event_k().alias("k"))
    op = event_operation(F.col("event_type"))
    is_delete = op == "d"
    after = F.when(~is_delete, repository_image_from_event(
        F.col("user_id"), F.col("event_type"), F.col("value"), F.col("k")))
    before = F.when(is_delete, row_struct(REPOSITORIES, {"repository_id": F.col("user_id")}))
    return e.select(*records(
        REPOSITORIES, op, F.col("ts_ms"), before, after,
        partition=F.col("user_id") % 4, offset=F.col("event_id"), key=F.col("user_id"),
        wrapped=(F.col("event_id") % 2 == 1)))


def _variants(recs: DataFrame, variants: list[tuple[Column, dict[str, Column]]]) -> DataFrame:
    """One pass: each record emits the variants whose condition holds, each variant the
    record with some fields replaced. The topic stays outside the generator (foldable)."""
    fields = ("partition", "offset", "timestamp", "key", "value")
    return rows.emit(recs, [(cond, [over.get(f, F.col(f)).alias(f) for f in fields]) for cond, over in variants], "topic")


def late_and_repeated(recs: DataFrame) -> DataFrame:
    """The same log delivered twice, plus a stale update after every delete.

    The stale update carries an event time 1 ms before its delete but a later offset,
    so it arrives later and must still lose. Current state must not change.
    """
    field = lambda name: F.coalesce(F.get_json_object("value", f"$.{name}"),
                                    F.get_json_object("value", f"$.payload.{name}"))
    is_delete = field("op") == "d"
    stale = F.concat(F.lit('{"op":"u","ts_ms":'),
                     (field("ts_ms").cast("bigint") - 1).cast("string"),
                     F.lit(',"before":null,"after":{"repository_id":'),
                     F.get_json_object("key", "$.repository_id"),
                     F.lit(',"stars":-1}}'))
    return _variants(recs, [
        (F.lit(True), {}),
        (F.lit(True), {}),
        (F.coalesce(is_delete, F.lit(False)),
         {"offset": F.col("offset") + F.lit(1 << 40), "value": stale}),
    ])


def faulty_records(recs: DataFrame) -> DataFrame:
    """The log plus faults derived from it: a tombstone after each delete, truncated text
    (k = 13), a non-numeric key (k = 17) and a missing operation (k = 19)."""
    # ``stars`` of the after image equals the event's k (see repository_image_from_event).
    k = F.coalesce(F.get_json_object("value", "$.after.stars"),
                   F.get_json_object("value", "$.payload.after.stars")).cast("int")
    is_delete = F.coalesce(F.get_json_object("value", "$.op"),
                           F.get_json_object("value", "$.payload.op")) == "d"
    return _variants(recs, [
        (F.lit(True), {}),
        (F.coalesce(is_delete, F.lit(False)), {"value": F.lit(None).cast("string")}),
        (F.coalesce(k == 13, F.lit(False)), {"value": F.substring("value", 1, 20)}),
        (F.coalesce(k == 17, F.lit(False)),
         {"value": F.regexp_replace("value", r'"repository_id":(\d+)', '"repository_id":"x$1"')}),
        (F.coalesce(k == 19, F.lit(False)),
         {"value": F.regexp_replace("value", r'"op":"[a-z]"', '"op":null')}),
    ])


# ---------------------------------------------------------------------------------------
# Four-topic activity stream
# ---------------------------------------------------------------------------------------
def activity_records(spark: SparkSession, sf_dir: str, tables=None) -> DataFrame:
    """Kafka-shaped records of the four tables (or of ``tables``) on their own topics."""
    wanted = set(tables or ("repositories", "commits", "issues", "pull_requests"))
    parts = []
    if "repositories" in wanted:
        parts.append(_repository_snapshot_records(spark, sf_dir))
    if "commits" in wanted:
        parts.append(_commit_records(spark, sf_dir))
    if "issues" in wanted:
        parts.append(_issue_records(spark, sf_dir))
    if "pull_requests" in wanted:
        parts.append(_pull_request_records(spark, sf_dir))
    out = parts[0]
    for part_df in parts[1:]:
        out = out.unionByName(part_df)
    return out


def _repository_snapshot_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repositories: one snapshot read per customer."""
    repo = by_key(repositories(spark, sf_dir), "repository_id")
    return repo.select(*records(
        REPOSITORIES, F.lit("r"), F.lit(SNAPSHOT_MS).cast("bigint"), F.lit(None),
        row_struct(REPOSITORIES, {c: F.col(c) for c in REPOSITORIES.columns}),
        partition=F.col("repository_id") % 4, offset=F.col("repository_id"),
        key=F.col("repository_id")))


def _commit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commits: created once per event."""
    ev = by_key(table(spark, sf_dir, "events"), "event_id").select("event_id", "user_id", "event_type", "ts",
                                               epoch_millis("ts").alias("ts_ms"))
    commit_img = row_struct(COMMITS, {
        "commit_sha": F.concat(F.lit("e"), F.col("event_id").cast("string")),
        "repository_id": F.col("user_id"),
        "author": F.concat(F.lit("user_"), F.col("user_id").cast("string")),
        "author_email": F.concat(F.lit("user_"), F.col("user_id").cast("string"), F.lit("@example.org")),
        "commit_date": F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss"),
        "message": F.col("event_type"),
    })
    commit_recs = ev.select(*records(
        COMMITS, F.lit("c"), F.col("ts_ms"), F.lit(None), commit_img,
        partition=F.col("user_id") % 4, offset=F.col("event_id"),
        key=F.concat(F.lit("e"), F.col("event_id").cast("string")), wrapped=True))

    return commit_recs


def _issue_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues: created open, then closed (F) or deleted (P) a day later."""
    o = by_key(table(spark, sf_dir, "orders"), "o_orderkey").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        epoch_millis("o_orderdate").alias("ts_ms"))
    issue_vals = {
        "issue_id": F.col("o_orderkey"),
        "issue_number": F.col("o_orderkey") % 1000,
        "repository_id": F.col("o_custkey"),
        "title": F.concat(F.lit("order "), F.col("o_orderkey").cast("string")),
        "author": F.concat(F.lit("user_"), F.col("o_custkey").cast("string")),
        "comments": leading_int("o_orderpriority"),
        "url": F.concat(F.lit("https://example.org/issues/"), F.col("o_orderkey").cast("string")),
    }
    opened = row_struct(ISSUES, {**issue_vals, "state": F.lit("open")})
    closed = row_struct(ISSUES, {**issue_vals, "state": F.lit("closed")})
    key_only = row_struct(ISSUES, {"issue_id": F.col("o_orderkey")})
    part = F.col("o_custkey") % 4
    is_close = F.col("o_orderstatus") == "F"
    is_pending = F.col("o_orderstatus") == "P"
    issue_recs = emit(o, [
        (F.lit(True), records(ISSUES, F.lit("c"), F.col("ts_ms"), F.lit(None), opened,
                              part, F.col("o_orderkey") * 4, F.col("o_orderkey"))),
        (is_close | is_pending, records(
            ISSUES, F.when(is_close, F.lit("u")).otherwise(F.lit("d")), F.col("ts_ms") + DAY_MS,
            F.when(~is_close, key_only), F.when(is_close, closed),
            part, F.col("o_orderkey") * 4 + 1, F.col("o_orderkey"))),
        (is_pending, records(
            ISSUES, F.lit("d"), F.col("ts_ms") + DAY_MS, key_only, F.lit(None),
            part, F.col("o_orderkey") * 4 + 2, F.col("o_orderkey"), tombstone=F.lit(True))),
    ])

    return issue_recs


def _pull_request_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pull requests: created open, closed a day later when the line status is F."""
    li = by_key(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")
    li = li.select("*", epoch_millis("l_shipdate").alias("ts_ms"))
    img = _pr_images(li)
    pr_open = row_struct(PULL_REQUESTS, {**img, "state": F.lit("open")})
    pr_closed = row_struct(PULL_REQUESTS, {**img, "state": F.lit("closed")})
    pr_key = img["pull_request_id"]
    pr_part = F.col("l_linenumber") % 4
    pr_recs = emit(li, [
        (F.lit(True), records(PULL_REQUESTS, F.lit("c"), F.col("ts_ms"), F.lit(None), pr_open, pr_part,
                              F.col("l_orderkey") * 16 + F.col("l_linenumber") * 2, pr_key)),
        (F.col("l_linestatus") == "F", records(
            PULL_REQUESTS, F.lit("u"), F.col("ts_ms") + DAY_MS, F.lit(None), pr_closed, pr_part,
            F.col("l_orderkey") * 16 + F.col("l_linenumber") * 2 + 1, pr_key, wrapped=True)),
    ])

    return pr_recs


# Pull-request ids repeat in ``lineitem`` with equal event coordinates; state for them
# is made deterministic by ordering on the row content after the event coordinates.
PR_ORDER = ("event_timestamp", "kafka_timestamp", "partition", "offset", "repository_id", "state")


# ---------------------------------------------------------------------------------------
# Raw documents (REST listing shape) derived from the tables, one JSON text per row
# ---------------------------------------------------------------------------------------
def iso(ts: str) -> Column:
    return F.date_format(F.col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def repository_object() -> Column:
    """The repository object of a customer. Missing on purpose: ``owner`` for the
    AUTOMOBILE segment, ``license`` for BUILDING, ``topics`` for a negative balance."""
    owner_login = F.concat(F.lit("owner_"), F.col("c_nationkey").cast("string"))
    return F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.concat(owner_login, F.lit("/"), F.col("c_name")).alias("full_name"),
        F.when(F.col("c_mktsegment") != "AUTOMOBILE", F.struct(owner_login.alias("login"))).alias("owner"),
        F.lit("derived repository").alias("description"),
        F.concat(F.lit("https://example.org/"), F.col("c_name")).alias("html_url"),
        F.lit("2024-01-01T00:00:00Z").alias("created_at"),
        F.lit("2024-02-01T00:00:00Z").alias("updated_at"),
        F.lit("2024-02-02T00:00:00Z").alias("pushed_at"),
        F.col("c_mktsegment").alias("language"),
        F.round(F.col("c_acctbal") * 100).cast("bigint").alias("stargazers_count"),
        (F.col("c_custkey") % 97).alias("forks_count"),
        (F.col("c_custkey") % 11).alias("open_issues_count"),
        (F.col("c_custkey") % 53).alias("watchers_count"),
        F.col("c_custkey").alias("size"),
        (F.col("c_acctbal") < 0).alias("archived"),
        F.lit(True).alias("has_issues"), F.lit(False).alias("has_discussions"),
        F.lit("main").alias("default_branch"),
        F.when(F.col("c_acctbal") >= 0, F.array(F.lower("c_mktsegment"), F.lit("derived"))).alias("topics"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.struct(F.lit("MIT").alias("spdx_id"))).alias("license"),
    )


def raw_repository_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One repository object per customer."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.lit("customer.json").alias("source_file"), F.to_json(repository_object()).alias("doc"))


def raw_commit_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One commit object per event; the account login is empty for views and the
    account is missing for clicks, so the author falls back to the commit name."""
    e = table(spark, sf_dir, "events")
    uid = F.col("user_id").cast("string")
    login = F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.concat(F.lit("user_"), uid))
    doc = F.struct(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("sha"),
        F.when(F.col("event_type") != "click", F.struct(login.alias("login"))).alias("author"),
        F.struct(
            F.struct(F.concat(F.lit("name_"), uid).alias("name"),
                     F.concat(F.lit("user_"), uid, F.lit("@example.org")).alias("email"),
                     iso("ts").alias("date")).alias("author"),
            F.col("event_type").alias("message")).alias("commit"),
    )
    return e.select(F.concat(F.lit("repo_"), uid).alias("repository"), F.to_json(doc).alias("doc"))


def issue_object() -> Column:
    """The issue-feed object of an order: priority 5 entries have no labels; pending orders
    have no user."""
    prio = F.col("o_orderpriority")
    return F.struct(
        F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 1000).alias("number"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.when(F.col("o_orderstatus") == "O", F.lit("open")).otherwise(F.lit("closed")).alias("state"),
        F.when(F.col("o_orderstatus") != "P",
               F.struct(F.concat(F.lit("user_"), F.col("o_custkey").cast("string")).alias("login"))).alias("user"),
        iso("o_orderdate").alias("created_at"), iso("o_orderdate").alias("updated_at"),
        F.when(F.col("o_orderstatus") == "F", iso("o_orderdate")).alias("closed_at"),
        leading_int("o_orderpriority").alias("comments"),
        F.when(prio != "5-LOW", F.array(F.struct(F.col("o_orderstatus").alias("name")),
                                         F.struct(prio.alias("name")))).alias("labels"),
        F.concat(F.lit("https://example.org/issues/"), F.col("o_orderkey").cast("string")).alias("html_url"),
    )


def issue_doc(issue: Column) -> Column:
    """Text of an ``issue_object``. Priority 1 entries are pull requests (the key holds an
    object), priority 2 entries carry the key with a null value (still pull requests)."""
    prio = F.col("o_orderpriority")
    text = F.to_json(issue)
    return (F.when(prio == "1-URGENT", F.regexp_replace(text, r"\}$", ',"pull_request":{"url":"x"}}'))
             .when(prio == "2-HIGH", F.regexp_replace(text, r"\}$", ',"pull_request":null}'))
             .otherwise(text))


def raw_issue_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One issue-feed object per order."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.concat(F.lit("customer_"), F.col("o_custkey").cast("string")).alias("repository"),
                    issue_doc(issue_object()).alias("doc"))


def pull_request_doc() -> Column:
    """Text of the pull-request object of a line item."""
    return F.to_json(F.struct(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.col("l_linenumber").alias("number"),
        F.concat(F.lit("line "), F.col("l_orderkey").cast("string")).alias("title"),
        F.when(F.col("l_linestatus") == "O", F.lit("open")).otherwise(F.lit("closed")).alias("state"),
        F.struct(F.concat(F.lit("supplier_"), F.col("l_suppkey").cast("string")).alias("login")).alias("user"),
        iso("l_shipdate").alias("created_at"), iso("l_shipdate").alias("updated_at"),
        F.when(F.col("l_linestatus") == "F", iso("l_shipdate")).alias("closed_at"),
        F.when(F.col("l_returnflag") == "R", iso("l_shipdate")).alias("merged_at"),
        F.floor("l_quantity").alias("comments"), F.floor(F.col("l_tax") * 100).alias("review_comments"),
        F.col("l_linenumber").alias("commits"), F.floor(F.col("l_discount") * 100).alias("changed_files"),
        F.floor("l_quantity").alias("additions"), F.lit(0).alias("deletions"),
        F.concat(F.lit("https://example.org/pulls/"), F.col("l_orderkey").cast("string")).alias("html_url"),
    ))


def raw_pull_request_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.concat(F.lit("supplier_"), F.col("l_suppkey").cast("string")).alias("repository"),
                     pull_request_doc().alias("doc"))


# ---------------------------------------------------------------------------------------
# Two snapshots of ``part``: parts larger than 45 arrive later, Brand#13 is delisted,
# PROMO parts are renamed upper-case and cost one more in the new snapshot.
# ---------------------------------------------------------------------------------------
PART_COLUMNS = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


def part_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, sf_dir, "part").select(*PART_COLUMNS)
    old = p.filter(F.col("p_size") <= 45)
    promo = F.col("p_type") == "PROMO"
    new = p.filter(F.col("p_brand") != "Brand#13").select(
        "p_partkey",
        F.when(promo, F.upper("p_name")).otherwise(F.col("p_name")).alias("p_name"),
        "p_brand", "p_type", "p_size",
        F.when(promo, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice")).alias("p_retailprice"))
    return old, new
