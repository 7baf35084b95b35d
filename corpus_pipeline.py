"""A training corpus from the documents: language, near duplicates, contamination, personal
data, tokens. Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of ``docs``, also such as share a name with one
that an operator makes. No SQL expresses the trained and hashed stages, so ``ORACLE_SQL`` is
None and the tests hold the stages against brute force.

Defined cases: an empty table passes through; null text is dropped by the language stage; a
row without an id is never dropped as a duplicate of another text; of equal rows one stays;
texts that share an id are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changelake.llm import bpe, decontaminate, language_id, minhash_dedup, personal_data
from changelake.llm.store import row_key, stored, table

SHINGLE = 5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null, or no letter."""
    model = language_id.train(docs)
    return language_id.with_language(docs, model).where(F.col("lang_pred") != language_id.UND).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: that of the least id. A document is a text under an id:
    of equal rows one stays, and texts that share an id are judged one by one, after all others
    (for this each gets a number of its own from 2**62).

    Texts are moved once, when the rows to stay are known: until then the ids that several texts
    share are found from ids and keys, and equal rows are one node to the operator."""
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("_id"), row_key().alias("_key"))
    shared = stored(rows.where("_id is not null").groupBy("_id").agg(F.min("_key").alias("least"), F.max("_key").alias("most"))
                    .where("least != most").select("_id", F.lit(True).alias("_several")), "shared-ids")
    own = F.when(F.col("_several"), F.col("_key").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))).otherwise(F.col("_id"))
    rows = rows.join(shared, "_id", "left").select("row", "_key", own.alias("_doc"))
    if not shared.isEmpty():
        rows = stored(rows, "documents")  # the join is not repeated by each of the passes below
    texts = rows.select("_doc", F.col("row.text").alias("_text"))
    gone = minhash_dedup.dedup(texts, "_doc", "_text", shingle=SHINGLE).where("not kept").select(
        F.col("doc_id").alias("_place"), F.lit(True).alias("_named"))
    # rows without an id have places by their keys, apart from those of ids
    rows = rows.select("row", "_key", F.coalesce("_doc", "_key").alias("_place"), F.col("_doc").isNotNull().alias("_named"))
    equal = Window.partitionBy("_place", "_named", "_key").orderBy("_key")
    return rows.join(gone, ["_place", "_named"], "left_anti").withColumn("_n", F.row_number().over(equal)).where("_n = 1").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents contaminated by the benchmark."""
    bad = (decontaminate.scan(docs, table(spark, sf_dir, "benchmark"), unnamed=True).where("contaminated")
           .select(F.col("key").alias("_key"), F.col("doc_id").alias("_id")).distinct())
    rows = docs.select(F.struct("*").alias("row"), row_key().alias("_row_key"))
    same = (F.col("_row_key") == F.col("_key")) & F.col("row.doc_id").cast("long").eqNullSafe(F.col("_id"))
    return rows.join(bad, same, "left_anti").select("row.*")


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; ``n_chars`` follows."""
    out = personal_data.with_redacted(docs)
    changed = {"text": F.col("redacted"), "n_chars": F.length("redacted").cast(docs.schema["n_chars"].dataType)}
    return out.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document (little-endian unsigned 32-bit), with the hash of their decoding."""
    return bpe.code(docs, bpe.vocabulary_path(), output=("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("language id", language),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("personal data", private_data),
    ("bpe", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
