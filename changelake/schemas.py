"""Explicit schemas for every layer, and the per-table specification.

Nothing in this package lets a JSON reader infer types: an all-null column would
vanish and integers or timestamps would change type after a round trip.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, L, I, B = StringType(), LongType(), IntegerType(), BooleanType()

# --------------------------------------------------------------------------------------
# Stream record: what a Kafka source (or its landing-folder stand-in) delivers.
# --------------------------------------------------------------------------------------
KAFKA_SCHEMA = _struct(
    ("topic", S),
    ("partition", I),
    ("offset", L),
    ("timestamp", TimestampType()),
    ("key", S),
    ("value", S),
)

# Metadata every normalised change row starts with.
META_SCHEMA = _struct(
    ("table_name", S),
    ("operation", S),
    ("event_timestamp", L),
    ("kafka_timestamp", TimestampType()),
    ("partition", I),
    ("offset", L),
)
META_COLUMNS = tuple(META_SCHEMA.fieldNames())

# Order of events for one key, newest first (ties broken in this order).
EVENT_ORDER = ("event_timestamp", "kafka_timestamp", "partition", "offset")

# Operation codes of the change envelope.
OP_SNAPSHOT = "r"
OP_CREATE = "c"
OP_UPDATE = "u"
OP_DELETE = "d"
OPERATIONS = (OP_SNAPSHOT, OP_CREATE, OP_UPDATE, OP_DELETE)


@dataclass(frozen=True)
class TableSpec:
    """Everything table-specific: the rest of the package is generic over it.

    name        table name (last dotted part of the topic)
    key         primary-key column
    row_schema  typed columns of a row image (``before`` / ``after``)
    mutable     columns an upsert may refresh; ``None`` means every non-key column
    parent_key  foreign key to the parent table, if any
    """

    name: str
    key: str
    row_schema: StructType
    mutable: tuple[str, ...] | None = None
    parent_key: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.row_schema.fieldNames()

    @property
    def value_columns(self) -> list[str]:
        return [c for c in self.columns if c != self.key]

    def mutable_columns(self) -> list[str]:
        if self.mutable is None:
            return self.value_columns
        return list(self.mutable)

    def topic(self, server: str = "cdc", schema: str = "public") -> str:
        return f"{server}.{schema}.{self.name}"

    def normalised_schema(self) -> StructType:
        return StructType(list(META_SCHEMA.fields) + list(self.row_schema.fields))


# --------------------------------------------------------------------------------------
# Row images carried by the change stream (the columns the stream projection keeps).
# --------------------------------------------------------------------------------------
REPOSITORIES = TableSpec(
    "repositories",
    "repository_id",
    _struct(
        ("repository_id", L), ("name", S), ("full_name", S), ("owner", S), ("description", S),
        ("language", S), ("stars", I), ("forks", I), ("open_issues", I), ("watchers", I),
        ("archived", B),
    ),
)
COMMITS = TableSpec(
    "commits",
    "commit_sha",
    _struct(
        ("commit_sha", S), ("repository_id", L), ("author", S), ("author_email", S),
        ("commit_date", S), ("message", S),
    ),
    parent_key="repository_id",
)
ISSUES = TableSpec(
    "issues",
    "issue_id",
    _struct(
        ("issue_id", L), ("issue_number", I), ("repository_id", L), ("title", S), ("state", S),
        ("author", S), ("comments", I), ("url", S),
    ),
    parent_key="repository_id",
)
PULL_REQUESTS = TableSpec(
    "pull_requests",
    "pull_request_id",
    _struct(
        ("pull_request_id", L), ("number", I), ("repository_id", L), ("title", S), ("state", S),
        ("author", S), ("comments", I), ("review_comments", I), ("commits", I),
        ("changed_files", I), ("additions", I), ("deletions", I), ("url", S),
    ),
    parent_key="repository_id",
)
TABLES: dict[str, TableSpec] = {t.name: t for t in (REPOSITORIES, COMMITS, ISSUES, PULL_REQUESTS)}

# --------------------------------------------------------------------------------------
# Flat records after the raw transform (the columns loaded into the tables), with the
# columns an upsert may refresh on a key conflict.
# --------------------------------------------------------------------------------------
FLAT_REPOSITORIES = TableSpec(
    "repositories",
    "repository_id",
    _struct(
        ("repository_id", L), ("name", S), ("full_name", S), ("owner", S), ("description", S),
        ("html_url", S), ("created_at", S), ("updated_at", S), ("pushed_at", S), ("language", S),
        ("stars", L), ("forks", L), ("open_issues", L), ("watchers", L), ("size", L),
        ("archived", B), ("has_issues", B), ("has_discussions", B), ("default_branch", S),
        ("topics", ArrayType(S)), ("license", S),
    ),
    # The columns refreshed when a repository already exists.
    mutable=("stars", "forks", "open_issues", "watchers", "updated_at", "pushed_at"),
)
FLAT_COMMITS = TableSpec(
    "commits",
    "commit_sha",
    _struct(
        ("commit_sha", S), ("repository", S), ("author", S), ("author_email", S),
        ("commit_date", S), ("message", S),
    ),
    parent_key="repository",
)
FLAT_ISSUES = TableSpec(
    "issues",
    "issue_id",
    _struct(
        ("issue_id", L), ("issue_number", L), ("repository", S), ("title", S), ("state", S),
        ("author", S), ("created_at", S), ("updated_at", S), ("closed_at", S), ("comments", L),
        ("labels", ArrayType(S)), ("url", S),
    ),
    parent_key="repository",
)
FLAT_PULL_REQUESTS = TableSpec(
    "pull_requests",
    "pull_request_id",
    _struct(
        ("pull_request_id", L), ("number", L), ("repository", S), ("title", S), ("state", S),
        ("author", S), ("created_at", S), ("updated_at", S), ("closed_at", S), ("merged_at", S),
        ("comments", L), ("review_comments", L), ("commits", L), ("changed_files", L),
        ("additions", L), ("deletions", L), ("url", S),
    ),
    parent_key="repository",
)
FLAT_TABLES: dict[str, TableSpec] = {
    t.name: t for t in (FLAT_REPOSITORIES, FLAT_COMMITS, FLAT_ISSUES, FLAT_PULL_REQUESTS)
}


def immutable_after_create(spec: TableSpec, *frozen: str) -> TableSpec:
    """Spec whose upsert refreshes every column but the key and ``frozen``."""
    keep = tuple(c for c in spec.value_columns if c not in frozen)
    return TableSpec(spec.name, spec.key, spec.row_schema, keep, spec.parent_key)


# Issues and pull requests refresh all but ``created_at``; commits refresh all.
UPSERT_SPECS: dict[str, TableSpec] = {
    "repositories": FLAT_REPOSITORIES,
    "commits": FLAT_COMMITS,
    "issues": immutable_after_create(FLAT_ISSUES, "created_at"),
    "pull_requests": immutable_after_create(FLAT_PULL_REQUESTS, "created_at"),
}

# --------------------------------------------------------------------------------------
# Raw documents as the REST listing returns them (only the fields that are read).
# --------------------------------------------------------------------------------------
_LOGIN = _struct(("login", S))
RAW_REPOSITORY = _struct(
    ("id", L), ("name", S), ("full_name", S), ("owner", _LOGIN), ("description", S),
    ("html_url", S), ("created_at", S), ("updated_at", S), ("pushed_at", S), ("language", S),
    ("stargazers_count", L), ("forks_count", L), ("open_issues_count", L), ("watchers_count", L),
    ("size", L), ("archived", B), ("has_issues", B), ("has_discussions", B),
    ("default_branch", S), ("topics", ArrayType(S)), ("license", _struct(("spdx_id", S))),
)
RAW_COMMIT = _struct(
    ("sha", S),
    ("author", _LOGIN),
    ("commit", _struct(
        ("author", _struct(("name", S), ("email", S), ("date", S))),
        ("message", S),
    )),
)
RAW_ISSUE = _struct(
    ("id", L), ("number", L), ("title", S), ("state", S), ("user", _LOGIN), ("created_at", S),
    ("updated_at", S), ("closed_at", S), ("comments", L),
    ("labels", ArrayType(_struct(("name", S)))), ("html_url", S),
)
RAW_PULL_REQUEST = _struct(
    ("id", L), ("number", L), ("title", S), ("state", S), ("user", _LOGIN), ("created_at", S),
    ("updated_at", S), ("closed_at", S), ("merged_at", S), ("comments", L),
    ("review_comments", L), ("commits", L), ("changed_files", L), ("additions", L),
    ("deletions", L), ("html_url", S),
)

# Quality expectations: one row per table.
EXPECTATIONS_SCHEMA = _struct(("table", S), ("expected", L))
