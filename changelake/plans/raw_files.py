"""Registered queries of the raw and load stages on landed files, in two drops and two loads.

Derived from the tables (fixed, mirrored by the oracle SQL); k is ``c_custkey``:

repositories   one object per customer, in pages of about a hundred. Full name
               owner_<nation>/customer_<k>; k % 80 = 40 and k % 80 = 0 are pairs of names that give
               one file name. Where k % 30 = 11 the repository is not listed at first; k % 60 = 11
               is listed in the second drop, k % 60 = 41 never.
issues         pages of about ``PAGE_DOCS`` for each repository k = o_custkey % 150 + 1 and drop, in
               its folder. First drop: even orders, the page of k % 50 = 7 a single one, cut off.
               Second drop: odd orders, and even closed ones fetched again with another title,
               creation and update time.
pull requests  pages likewise for each repository k = l_suppkey and drop, in its folder: even orders,
               then odd ones. Of rows of one id, that of the greatest supplier and latest date.

Rows are chosen, named and dealt to pages as columns, and become text last: only the shuffle that
brings a page together carries documents.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changelake.operators import load
from changelake.plans import stages
from changelake.plans import testdata as td
from changelake.schemas import UPSERT_SPECS
from changelake.session import scratch_dir, settings, tidy
from changelake.sources import fs
from changelake.sources.readers import file_stem_of

LATER = "2030-01-01T00:00:00Z"
#: Documents of a page on average, at most: a task holds a page whole.
PAGE_DOCS = 4096


def _full_name() -> Column:
    k = F.col("c_custkey")
    pair = F.floor((k + 40) / 80).cast("string")
    return (F.when(k % 80 == 40, F.concat(F.lit("pair_"), pair, F.lit("/x")))
            .when(k % 80 == 0, F.concat(F.lit("pair/"), pair, F.lit("_x")))
            .otherwise(F.concat(F.lit("owner_"), F.col("c_nationkey").cast("string"), F.lit("/customer_"), k.cast("string"))))


def _write_pages(docs: DataFrame, path: str, folder: str, cut: Column | None = None, number: Column | None = None) -> None:
    """One array of ``doc`` for each value of ``folder`` and page ``number``, as one packed file in
    the folder's folder."""
    text = F.concat(F.lit("["), F.array_join(F.collect_list("doc"), ","), F.lit("]"))
    docs = docs.withColumns({"_cut": F.lit(False) if cut is None else cut, "_number": F.lit(0) if number is None else number})
    pages = docs.groupBy(folder, "_cut", "_number").agg(text.alias("value"))
    whole = F.when(F.col("_cut"), F.expr("left(value, length(value) - 9)")).otherwise(F.col("value"))
    (pages.select(folder, whole.alias("value")).write.mode("append").options(compression="gzip", maxRecordsPerFile=1)
     .partitionBy(folder).text(path))


def _in_folders(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Rows with the folder of their parent ``c_custkey``, and in how many pages its rows lie."""
    parents = td.table(spark, sf_dir, "customer").select("c_custkey", file_stem_of(_full_name()).alias("repository"))
    sizes = rows.groupBy("c_custkey").agg(F.ceil(F.count("*") / PAGE_DOCS).alias("_pages"))
    return rows.join(parents.join(sizes, "c_custkey"), "c_custkey")


def _number(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.col("_pages"))


def land_repositories(spark: SparkSession, sf_dir: str, root: str, drop: int) -> None:
    k = F.col("c_custkey")
    listed = {0: k % 30 != 11, 1: k % 60 == 11}[drop]
    rows = td.table(spark, sf_dir, "customer").where(listed)
    docs = rows.select(F.to_json(td.repository_object().withField("full_name", _full_name())).alias("doc"), F.floor(k / 100).alias("page"))
    _write_pages(docs, os.path.join(root, "raw", "repositories"), "page")


def land_issues(spark: SparkSession, sf_dir: str, root: str, drop: int) -> None:
    issue, even = td.issue_object(), F.col("o_orderkey") % 2 == 0
    rows = td.table(spark, sf_dir, "orders").withColumn("c_custkey", F.col("o_custkey") % 150 + 1)
    if drop == 0:
        rows = rows.where(even)
    else:
        again = even & issue["closed_at"].isNotNull()
        rows = rows.where(~even | again)
        later = lambda name, value: F.when(again, value).otherwise(issue[name])
        issue = (issue.withField("created_at", later("created_at", F.lit(LATER))).withField("updated_at", later("updated_at", F.lit(LATER)))
                 .withField("title", later("title", F.concat(issue["title"], F.lit(" again")))))
    cut = (F.col("c_custkey") % 50 == 7) & F.lit(drop == 0)
    docs = _in_folders(spark, sf_dir, rows).select("repository", "c_custkey", td.issue_doc(issue).alias("doc"),
                                                   F.when(cut, 0).otherwise(_number("o_orderkey")).alias("_page"))
    _write_pages(docs, os.path.join(root, "raw", "issues"), "repository", cut, F.col("_page"))


def land_pull_requests(spark: SparkSession, sf_dir: str, root: str, drop: int) -> None:
    rows = td.table(spark, sf_dir, "lineitem").withColumn("c_custkey", F.col("l_suppkey").cast("bigint"))
    rows = rows.withColumns({"id": F.col("l_orderkey") * 8 + F.col("l_linenumber"), "at": td.iso("l_shipdate")})
    rows = rows.where(F.floor(F.col("id") / 8) % 2 == drop).withColumn(
        "_rank", F.rank().over(Window.partitionBy("id").orderBy(F.col("c_custkey").desc(), F.col("at").desc()))).where("_rank = 1")
    # rows alike in all that have been ordered: the greatest document
    last = rows.groupBy("id").agg(F.max_by(F.struct(*rows.columns), td.pull_request_doc()).alias("last")).select("last.*")
    docs = _in_folders(spark, sf_dir, last).select("repository", td.pull_request_doc().alias("doc"), _number("id").alias("_page"))
    _write_pages(docs, os.path.join(root, "raw", "pull_requests"), "repository", number=F.col("_page"))


_LAND = {"repositories": land_repositories, "issues": land_issues, "pull_requests": land_pull_requests}


@tidy
def _transformed(spark: SparkSession, sf_dir: str, children: tuple[str, ...], loads: bool = True) -> str:
    """Two drops, each transformed by a newly started stream, and loaded; returns the root."""
    root = scratch_dir(spark, "raw", fresh=True)
    for drop in range(2):
        for name in ("repositories", *children):
            _LAND[name](spark, sf_dir, root, drop)
            stages.raw_stream(spark, root, name, available_now=True).awaitTermination()
        if loads:
            stages.load_job(spark, root, drop + 1)
    return root


def stream_raw_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat issues after two drops with a restart and cut-off pages."""
    root = _transformed(spark, sf_dir, ("issues",), loads=False)
    flat = spark.read.parquet(os.path.join(root, "flat", "issues"))
    return flat.select("issue_id", "issue_number", "repository", "title", "state", "author", "created_at", "updated_at", "closed_at",
                       "comments", F.array_join("labels", "|").alias("labels"), "url")


def raw_load_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages 2 and 3 from files: issues after two loads (L1-L8; creation time and key stay)."""
    root = _transformed(spark, sf_dir, ("issues",))
    rows = load.read_current(spark, os.path.join(root, "tables", "issues"))
    return rows.select("issue_id", "issue_number", "repository_id", "title", "state", "author", "created_at", "updated_at", "closed_at",
                       "comments", F.array_join("labels", "|").alias("labels"), "url")


def raw_load_pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages 2 and 3 from files: pull requests after two loads."""
    root = _transformed(spark, sf_dir, ("pull_requests",))
    rows = load.read_current(spark, os.path.join(root, "tables", "pull_requests"))
    return rows.select("pull_request_id", "number", "repository_id", "title", "commits", "deletions", "updated_at", "url")


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the two stages set aside, by stage, table and reason, after the second load."""
    root = _transformed(spark, sf_dir, ("issues", "pull_requests"))
    counts = []
    for stage in ("raw", "load"):
        for name in ("issues", "pull_requests"):
            rows = spark.read.parquet(os.path.join(root, "rejects", stage, name))
            counts.append(rows.groupBy("reject_reason").agg(F.count("*").alias("rejected"))
                          .select(F.lit(stage).alias("stage"), F.lit(name).alias("table_name"), "reject_reason", "rejected"))
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


@tidy
def load_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commits loaded from processed JSON, of which half arrive one load before their
    repository; each load sees its own records only."""
    root = scratch_dir(spark, "pending", fresh=True)
    docs = td.raw_repository_docs(spark, sf_dir)
    k = F.get_json_object("doc", "$.id").cast("bigint")
    for n in range(2):
        flat = stages.RAW_TRANSFORMS["repositories"](docs.where(k % 2 == n))
        flat.write.mode("overwrite").parquet(os.path.join(root, "flat", "repositories"))
        names = td.repositories(spark, sf_dir).select("repository_id", "full_name")
        commits = (td.commits(spark, sf_dir).join(names, "repository_id").withColumnRenamed("full_name", "repository")
                   .where(F.pmod(F.xxhash64("commit_sha"), F.lit(2)) == n))
        text = F.to_json(F.struct(*UPSERT_SPECS["commits"].columns))
        processed = os.path.join(root, "processed", "commits")
        fs.delete(spark, processed)
        with settings(spark, stages.NO_BROADCASTS):
            _write_pages(commits.select(text.alias("doc"), F.pmod(F.xxhash64("repository"), F.lit(64)).alias("page")), processed, "page")
        stages.load_job(spark, root, n + 1)
    return load.read_current(spark, os.path.join(root, "tables", "commits")).select(
        "commit_sha", "repository_id", "author", "author_email", "commit_date", "message")


RAW_QUERIES = {
    "stream_raw_issues": stream_raw_issues,
    "raw_load_issues": raw_load_issues,
    "raw_load_pull_requests": raw_load_pull_requests,
    "load_rejects": load_rejects,
    "load_pending": load_pending,
}
