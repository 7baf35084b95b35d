"""Operator 12, ranked lexical search by pipelined term partitioning.

1. Documents are cut into blocks of at most ``BLOCK_BYTES`` and ``BLOCK_DOCS`` (one longer text
   is a block of its own). Each block yields its documents' lengths, and one posting list for each
   term: the documents that hold it and how often.
2. Posting lists are joined by term with the terms of the items, so a term's lists lie with its
   owner. Owners are numbered by the share of documents that hold a term, rarest first.
3. An item bundle is a group of items before one block. It carries a sparse accumulator, the
   (item, document, score) entries so far, through one cogroup for each owner; the owner adds
   its integer contributions and hands the bundle on.
4. After each owner an entry is left out only if it cannot become one of the block's best ``k``
   of its item: its score and the most that later owners could add stay below the ``k``-th
   highest score so far. Equal totals are kept, so the result is exact.
5. After the last owner each bundle gives its best ``k`` of every item, and the best of these
   are the result.

Posting lists of terms that no item uses are never read. While the items' distinct terms number
at most ``TERMS`` they travel to the tasks as sorted 64-bit fingerprints, and other lists are
not even written; beyond it all lists are written and the join by term leaves them out. Terms
are compared by these fingerprints: among a billion different terms, one that shares its
fingerprint with one of a million item terms is expected once in 18,000 collections.

Defined cases: null text has no terms and is not counted in N; a null id is an id like any other,
last among equal scores; rows of one document id are documents of their own. Rows of one item id
are one item with the terms of all their texts, equal texts counted once; an item without terms,
or without a document that scores, returns nothing; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changelake.llm import kernels as K
from changelake.llm.decontaminate import lowered_words
from changelake.llm.store import stored, table

TOP = 20
BLOCK_BYTES, BLOCK_DOCS = 4 << 20, 4096
LEAST_M = 100 - 25
TERMS = 1 << 20
#: Items of a bundle.
BUNDLE = 256
#: Terms in fewer documents than 1 of so many go to the first owner, to the second, ...; all others to the last.
OWNERS = (64, 12, 4)
_NO_ID = np.iinfo(np.int64).max
_INDEX = ("block long, term long, members array<int>, tfs array<int>, docs array<long>, lengths array<long>, "
          "n_docs long, n_words long")
_BUNDLE = pa.schema([("grp", pa.int32()), ("block", pa.int64()), ("docs", pa.list_(pa.int64())), ("ms", pa.list_(pa.int64())),
                     ("items", pa.list_(pa.int64())), ("members", pa.list_(pa.int32())), ("scores", pa.list_(pa.int64()))])
_BUNDLE_TYPE = "grp int, block long, docs array<long>, ms array<long>, items array<long>, members array<int>, scores array<long>"


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values, kind))


def _postings(wanted: np.ndarray | None):
    """Blocks of documents. A block is one row of its documents and their lengths (term null) and
    one row for each term's posting list, of the wanted terms if these are given."""

    def block(number: int, ids: pa.Array, data: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        parts = [lowered_words(data[starts[i]:starts[j]], starts[i:j + 1] - starts[i]) for i, j in K.slices(starts)]
        words = np.concatenate([prints for prints, _ in parts])
        lengths = np.concatenate([np.diff(offsets) for _, offsets in parts])
        n = len(lengths)
        doc = np.repeat(np.arange(n), lengths)
        if wanted is not None:
            at = np.minimum(np.searchsorted(wanted, words), max(len(wanted) - 1, 0))
            hit = wanted[at] == words if len(wanted) else np.zeros(len(words), bool)
            words, doc = words[hit], doc[hit]
        terms, which = np.unique(words, return_inverse=True)
        pairs, tfs = np.unique(which * np.int64(n) + doc, return_counts=True)
        ends = np.cumsum(np.bincount(pairs // n, minlength=len(terms)))
        none = lambda rows, kind: pa.nulls(rows, kind)
        int_list, long_list = pa.list_(pa.int32()), pa.list_(pa.int64())
        names = ["block", "term", "members", "tfs", "docs", "lengths", "n_docs", "n_words"]
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), none(1, pa.int64()), none(1, int_list), none(1, int_list),
             pa.array([ids.to_pylist()], long_list), pa.array([lengths], long_list),
             pa.array([int((lengths > 0).sum())], pa.int64()), pa.array([int(lengths.sum())], pa.int64())], names=names)
        if m := len(terms):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, number)), pa.array(K.signed(terms)), _lists(pairs % n, ends, pa.int32()), _lists(tfs, ends, pa.int32()),
                 none(m, long_list), none(m, long_list), none(m, pa.int64()), none(m, pa.int64())], names=names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40  # the table is stored, so numbers stay
        for batch in batches:
            data, starts = K.texts_of(batch.column(1))
            for i, j in K.slices(starts, BLOCK_BYTES):
                for a in range(i, j, BLOCK_DOCS):
                    b = min(a + BLOCK_DOCS, j)
                    yield from block(number, batch.column(0).slice(a, b - a), data[starts[a]:starts[b]], starts[a:b + 1] - starts[a])
                    number += 1

    return task


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, starts = K.texts_of(batch.column(2))
        for i, j in K.slices(starts):
            prints, offsets = lowered_words(data[starts[i]:starts[j]], starts[i:j + 1] - starts[i])
            row = pa.array(np.repeat(np.arange(i, j), np.diff(offsets)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(K.signed(prints))],
                                             names=["grp", "item", "term"])


def _array(table: pa.Table, name: str) -> np.ndarray:
    """The values of a list column's only row."""
    return table.column(name).chunk(0).flatten().to_numpy(zero_copy_only=False)


def _owner(k: int):
    """One owner's stage: its contributions join a bundle's accumulator."""

    def add(key: tuple, bundle: pa.Table, lists: pa.Table) -> pa.Table:
        if not lists.num_rows or not bundle.num_rows:
            return bundle.select(_BUNDLE.names).cast(_BUNDLE)
        bundle, lists = bundle.combine_chunks(), lists.combine_chunks()
        ms = _array(bundle, "ms")
        had, at, score = (_array(bundle, c) for c in ("items", "members", "scores"))
        column = lambda c: lists.column(c).chunk(0)
        spans = lambda c: column(c).offsets.to_numpy()
        flat = {c: column(c).values.to_numpy(zero_copy_only=False).astype(np.int64) for c in ("members", "tfs", "items", "factors", "rests")}
        items, number = np.unique(np.concatenate([had, flat["items"]]), return_inverse=True)
        held, number = number[:len(had)], number[len(had):]
        total = np.zeros((len(items), len(ms)), np.int64)
        total[held, at] = score
        later = np.full(len(items), 1 << 62)
        later[number] = flat["rests"]
        gain = (1_000_000_000 * flat["tfs"]) // (1000 * flat["tfs"] + 12 * ms[flat["members"]])
        docs_at, items_at = spans("members"), spans("items")
        for r in range(lists.num_rows):
            d, q = slice(docs_at[r], docs_at[r + 1]), slice(items_at[r], items_at[r + 1])
            total[number[q][:, None], flat["members"][d][None, :]] += flat["factors"][q][:, None] * gain[d][None, :]
        if total.shape[1] > k:
            least = np.partition(total, total.shape[1] - k, axis=1)[:, total.shape[1] - k]
            keep = (total > 0) & (total >= (least - later)[:, None])
        else:
            keep = total > 0
        row, member = np.nonzero(keep)
        one = lambda values: pa.array([values])
        return pa.Table.from_arrays([bundle.column("grp"), bundle.column("block"), bundle.column("docs"), bundle.column("ms"),
                                     one(items[row]), one(member.astype(np.int32)), one(total[row, member])], schema=_BUNDLE)

    return add


def _leaders(k: int):
    """The best k documents of each item of a bundle."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                item, member, score = (batch.column(c)[r].values.to_numpy() for c in ("items", "members", "scores"))
                docs = batch.column("docs")[r].values
                order = np.lexsort((docs.fill_null(_NO_ID).to_numpy()[member], -score, item))
                head = np.flatnonzero(np.diff(item[order], prepend=item[order][:1] - 1))
                place = np.arange(len(order)) - np.repeat(head, np.diff(head, append=len(order)))
                best = order[place < k]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best), batch.column("grp")[r].as_py(), np.int32)), pa.array(item[best]),
                                                  docs.take(pa.array(member[best])), pa.array(score[best])], names=["grp", "item", "doc_id", "score"])

    return task


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", most_terms: int = TERMS, bundle: int = BUNDLE) -> DataFrame:
    """item_id, rank, doc_id and score of every item's ``top`` best documents."""
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).distinct()
    bundles = 1 + asked.select(F.count_distinct("item_id")).first()[0] // bundle
    group = F.when(F.col("item_id").isNull(), -1).otherwise(F.pmod(F.xxhash64("item_id"), F.lit(bundles))).cast("int")
    asked = asked.select(group.alias("grp"), F.coalesce("item_id", F.lit(0)).alias("item"), "text")
    terms = stored(asked.mapInArrow(_item_terms, "grp int, item long, term long").groupBy("grp", "item", "term").agg(F.count("*").alias("times")),
                   "search-terms")
    distinct = terms.select("term").distinct()
    wanted = None
    if distinct.count() <= most_terms:
        wanted = np.sort(np.array([r.term for r in distinct.collect()], np.int64).view(K.U64))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    index = stored(texts.mapInArrow(_postings(wanted), _INDEX), "search-index")
    heads, lists = index.where("term is null"), index.where("term is not null").select("block", "term", "members", "tfs")
    n_docs, n_words = heads.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_words"), F.lit(0))).first()

    held = lists.groupBy("term").agg(F.sum(F.size("members")).cast("long").alias("df"), F.max(F.array_max("tfs")).cast("long").alias("most"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")))
    owner = F.lit(len(OWNERS))
    for k, share in reversed(list(enumerate(OWNERS))):
        owner = F.when(F.col("df") * share < n_docs, k).otherwise(owner)
    # the most a document can gain from a term: its highest tf at the least m, that of no words
    gain = F.expr(f"(1000000000 * most) div (1000 * most + 12 * {LEAST_M})")
    asked = (terms.join(held, "term").select("grp", "item", "term", (F.col("times") * weight).alias("factor"), owner.alias("owner"), gain.alias("gain"))
             .where("factor > 0"))
    every = range(len(OWNERS) + 1)
    rest = asked.groupBy("grp", "item").agg(F.array(*[F.coalesce(F.sum(F.when(F.col("owner") > k, F.col("factor") * F.col("gain"))), F.lit(0)) for k in every]).alias("rest"))
    part = F.struct("item", "factor", F.element_at("rest", F.col("owner") + 1).alias("rest"))
    owned = stored(asked.join(rest, ["grp", "item"]).groupBy("term", "grp", "owner").agg(F.collect_list(part).alias("parts")), "search-owned")
    routed = lists.join(owned, "term").select("owner", "grp", "block", "members", "tfs", F.col("parts.item").alias("items"),
                                              F.col("parts.factor").alias("factors"), F.col("parts.rest").alias("rests"))
    routed = stored(routed, "search-routed", partition_by=("owner",))

    ms = F.transform("lengths", lambda n: F.lit(LEAST_M) + F.call_function("div", F.lit(25) * n * F.lit(n_docs), F.lit(max(n_words, 1))))
    none = lambda kind: F.array().cast(f"array<{kind}>")
    state = heads.select(F.explode(F.sequence(F.lit(-1), F.lit(bundles - 1))).alias("grp"), "block", "docs", ms.alias("ms"),
                         none("long").alias("items"), none("int").alias("members"), none("long").alias("scores"))
    for k in every:
        lists_of = routed.where(F.col("owner") == k).drop("owner")
        state = state.groupBy("grp", "block").cogroup(lists_of.groupBy("grp", "block")).applyInArrow(_owner(top), _BUNDLE_TYPE)
    found = state.mapInArrow(_leaders(top), "grp int, item long, doc_id long, score long")
    order = Window.partitionBy("grp", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select(F.when(F.col("grp") >= 0, F.col("item")).alias("item_id"), "rank", "doc_id", "score"))


def query(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
c AS (SELECT count(*) FILTER (len(words) > 0) AS n, CAST(sum(len(words)) AS BIGINT) AS l FROM d),
q AS (SELECT item_id, term, count(*) AS times
      FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
            FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY 1, 2),
tf AS (SELECT row_id, doc_id, term, len(words) AS n_words, count(*) AS tf
       FROM (SELECT row_id, doc_id, words, unnest(words) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY 1, 2, 3, words),
w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * max(n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY 1),
s AS (SELECT item_id, row_id, doc_id,
             CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n_words * n) // l)))) AS BIGINT) AS score
      FROM tf JOIN w USING (term) JOIN q USING (term), c GROUP BY 1, 2, 3)
SELECT item_id, CAST(row_number() OVER o AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
WINDOW o AS (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)
QUALIFY row_number() OVER o <= 20
"""
