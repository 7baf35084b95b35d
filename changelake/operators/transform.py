"""Raw documents -> flat records (T1-T11) as Spark projections.

Input is ``source_file, doc`` (one JSON text per document, see
``sources.readers.raw_documents``) or any DataFrame with a ``doc`` text column and,
for child documents, a ``repository`` column naming the parent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.functions.text import field_of_each, first_non_empty, string_array_or_empty
from changelake.schemas import RAW_COMMIT, RAW_ISSUE, RAW_PULL_REQUEST, RAW_REPOSITORY


def _parsed(docs: DataFrame, schema) -> DataFrame:
    return docs.withColumn("_d", F.from_json("doc", schema))


def repositories(docs: DataFrame, *carried: str) -> DataFrame:
    """T1 (+T6, T9): 21 columns, renamed counters, owner and license flattened. Here and below,
    ``carried`` columns of the documents follow."""
    d = F.col("_d")
    return _parsed(docs, RAW_REPOSITORY).select(
        d["id"].alias("repository_id"), d["name"].alias("name"), d["full_name"].alias("full_name"),
        d["owner"]["login"].alias("owner"), d["description"].alias("description"),
        d["html_url"].alias("html_url"), d["created_at"].alias("created_at"),
        d["updated_at"].alias("updated_at"), d["pushed_at"].alias("pushed_at"),
        d["language"].alias("language"), d["stargazers_count"].alias("stars"),
        d["forks_count"].alias("forks"), d["open_issues_count"].alias("open_issues"),
        d["watchers_count"].alias("watchers"), d["size"].alias("size"),
        d["archived"].alias("archived"), d["has_issues"].alias("has_issues"),
        d["has_discussions"].alias("has_discussions"), d["default_branch"].alias("default_branch"),
        string_array_or_empty(d["topics"]).alias("topics"),
        d["license"]["spdx_id"].alias("license"), *carried,
    )


def commits(docs: DataFrame, *carried: str) -> DataFrame:
    """T2 (+T6, T7, T10): the account login, or the commit author's name when it is empty."""
    d = F.col("_d")
    a = d["commit"]["author"]
    return _parsed(docs, RAW_COMMIT).select(
        d["sha"].alias("commit_sha"), F.col("repository"),
        first_non_empty(d["author"]["login"], a["name"]).alias("author"),
        a["email"].alias("author_email"), a["date"].alias("commit_date"),
        d["commit"]["message"].alias("message"), *carried,
    )


def is_pull_request(doc: str = "doc") -> F.Column:
    """T5: the issue feed marks pull requests by the *presence* of ``pull_request``,
    even with a null value."""
    return F.coalesce(F.array_contains(F.json_object_keys(F.col(doc)), "pull_request"), F.lit(False))


def issues(docs: DataFrame, *carried: str, keep_pull_requests: bool = False) -> DataFrame:
    """T3 (+T5, T6, T8, T9): 12 columns; entries of the issue feed that are pull
    requests are dropped."""
    src = docs if keep_pull_requests else docs.filter(~is_pull_request())
    d = F.col("_d")
    return _parsed(src, RAW_ISSUE).select(
        d["id"].alias("issue_id"), d["number"].alias("issue_number"), F.col("repository"),
        d["title"].alias("title"), d["state"].alias("state"), d["user"]["login"].alias("author"),
        d["created_at"].alias("created_at"), d["updated_at"].alias("updated_at"),
        d["closed_at"].alias("closed_at"), d["comments"].alias("comments"),
        field_of_each(d["labels"], "name").alias("labels"), d["html_url"].alias("url"), *carried,
    )


def pull_requests(docs: DataFrame, *carried: str) -> DataFrame:
    """T4 (+T6): 17 columns."""
    d = F.col("_d")
    return _parsed(docs, RAW_PULL_REQUEST).select(
        d["id"].alias("pull_request_id"), d["number"].alias("number"), F.col("repository"),
        d["title"].alias("title"), d["state"].alias("state"), d["user"]["login"].alias("author"),
        d["created_at"].alias("created_at"), d["updated_at"].alias("updated_at"),
        d["closed_at"].alias("closed_at"), d["merged_at"].alias("merged_at"),
        d["comments"].alias("comments"), d["review_comments"].alias("review_comments"),
        d["commits"].alias("commits"), d["changed_files"].alias("changed_files"),
        d["additions"].alias("additions"), d["deletions"].alias("deletions"),
        d["html_url"].alias("url"), *carried,
    )


def issue_feed_totals(docs: DataFrame) -> DataFrame:
    """Per parent, issues kept and pull requests skipped (one aggregation)."""
    pr = is_pull_request()
    return docs.groupBy("repository").agg(
        F.count_if(~pr).alias("issues"),
        F.count_if(pr).alias("pull_requests_skipped"),
    )
