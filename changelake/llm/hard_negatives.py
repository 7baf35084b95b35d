"""Operator 13, hard-negative mining by slot-decomposed selection.

1. Rows are quantised. Anchors (every ``EVERY``-th id) are the stated query set; they and all
   rows are cut into blocks, and each pair of an anchor block and a row block is one group.
2. First pass: each group's combiner keeps the best ``POSITIVES`` rows of the same label of
   every anchor; the best of all groups are the anchor's positives.
3. The positives' scores are upper limits, which split an anchor's score axis into disjoint
   slots: slot j reaches from below limit j-1 down to limit j, highest first, and a score belongs
   to the slot of the least limit that it does not exceed. Second pass: each combiner keeps the
   best ``NEGATIVES`` rows of another label per (anchor, slot).
4. The slots' lists are joined in descending order. The window of a positive is the suffix that
   begins with its slot, so one list answers all of an anchor's overlapping windows: the first
   ``NEGATIVES`` of the suffix that reach ``FLOOR`` % of the positive's score.

A row below ``FLOOR`` % of its own slot's limit lies in no window that reaches the slot, so the
combiner leaves it out. Between the passes and the merge travel at most k rows for each anchor,
slot and group, and no more than k for each anchor and slot from any one task.

Defined cases: rows with a null label, a null vector, a null or non-finite component or a null
id take no part; rows of one id are rows of their own, but equal pairs of score and id count
once for an anchor, and no row with the anchor's id is its positive or negative; vectors of
another length than the anchor's are not compared with it; quantised components are held
within +-2**28, so that scores stay exact in 64 bits; ties go to the smaller id; an anchor
without positives, or a positive without rows in its window, returns nothing; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changelake.llm.store import stored, table

EVERY = 100
POSITIVES = NEGATIVES = 5
FLOOR = 80
SCALE = 256
ANCHOR_BLOCK, ROW_BLOCK = 512, 8192
#: Components of a block at most, for long vectors.
BLOCK_SIZE = 1 << 20
LIMIT = 1 << 28
ANCHOR = ("anchor", "anchor_id")
_BEST = pa.schema([("anchor", pa.int64()), ("anchor_id", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("row_id", pa.int64())])
_BEST_TYPE = "anchor long, anchor_id long, slot int, score long, row_id long"


def quantised(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label and integer vector of the rows that take part."""
    within = lambda x: F.least(F.greatest(x, F.lit(float(-LIMIT))), F.lit(float(LIMIT)))
    held = F.transform(F.col(vector_col), lambda x: F.floor(within(x.cast("double") * SCALE)).cast("int"))
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (rows.where(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & F.col(id_col).isNotNull() & finite)
            .select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), held.alias("vector")))


def relabelled(rows: DataFrame) -> DataFrame:
    """The contract's label noise: where the id is divisible by 7, label becomes (label+1)%10."""
    return rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def _matrix(column: pa.ChunkedArray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of that length, as a matrix, and which rows they are."""
    lists = column.combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else lists.chunk(0)
    which = np.flatnonzero(np.diff(lists.offsets.to_numpy()) == length)
    values = lists.take(pa.array(which)).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(which), length), which


def _product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer inner products, in doubles where these are exact."""
    top = lambda m: int(np.abs(m).max(initial=0))
    if top(left) * top(right) * max(left.shape[1], 1) < 1 << 53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64).T


def _first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, equal ones by the smaller id, equal pairs once."""
    if len(score) > 4 * k:  # whatever is below the k-th of distinct pairs is out
        best = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        best = np.arange(len(score))
    order = best[np.lexsort((ids[best], -score[best]))]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (np.diff(score[order]) != 0) | (np.diff(ids[order]) != 0)
    if fresh.sum() < k and len(best) < len(score):  # repeated pairs filled the cut
        order = np.lexsort((ids, -score))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (np.diff(score[order]) != 0) | (np.diff(ids[order]) != 0)
    return order[fresh][:k]


def _best(k: int, positive: bool):
    """A group's combiner: the best k rows per anchor and slot. Without limits there is one slot."""

    def combine(key: tuple, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if anchors.num_rows and rows.num_rows:
            number, name, label = (anchors.column(c).to_numpy() for c in ("anchor", "vec_id", "label"))
            ids, labels = (rows.column(c).to_numpy() for c in ("vec_id", "label"))
            lengths = np.array(anchors.column("length").to_pylist())
            limits = anchors.column("limits").to_pylist()
            for length in np.unique(lengths).tolist():
                left, anchor_at = _matrix(anchors.column("vector").filter(pa.array(lengths == length)), length)
                anchor_at = np.flatnonzero(lengths == length)[anchor_at]
                right, row_at = _matrix(rows.column("vector"), length)
                scores = _product(left, right)
                for i, a in enumerate(anchor_at.tolist()):
                    fits = (labels[row_at] == label[a]) == positive
                    fits &= ids[row_at] != name[a]
                    score, own = scores[i][fits], ids[row_at][fits]
                    if positive:
                        slots = [np.arange(len(score))]
                    else:
                        top = np.array(limits[a], np.int64)
                        slot = len(top) - 1 - np.searchsorted(top[::-1], score)
                        inside = np.flatnonzero(slot >= 0)
                        inside = inside[100 * score[inside] >= FLOOR * top[slot[inside]]]
                        slots = [inside[slot[inside] == j] for j in range(len(top))]
                    for j, members in enumerate(slots):
                        for p in members[_first(score[members], own[members], k)].tolist():
                            out.append((int(number[a]), int(name[a]), j, int(score[p]), int(own[p])))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [()] * 5, _BEST)], schema=_BEST)

    return combine


def _pass(anchors: DataFrame, rows: DataFrame, row_blocks: int, k: int, positive: bool) -> DataFrame:
    """The k best rows of every anchor and slot, over all groups."""
    left = anchors.withColumn("row_block", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    group = ["anchor_block", "row_block"]
    found = left.groupBy(*group).cogroup(rows.groupBy(*group)).applyInArrow(_best(k, positive), _BEST_TYPE)
    rank = F.dense_rank().over(Window.partitionBy(*ANCHOR, "slot").orderBy(F.desc("score"), "row_id"))  # equal pairs share a rank
    return found.withColumn("rank", rank).where(F.col("rank") <= k).distinct()


def mine(rows: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
         anchor_block: int = ANCHOR_BLOCK, row_block: int = ROW_BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score. ``rows`` as
    ``quantised`` returns them."""
    rows = stored(rows.distinct(), "negatives-rows")
    is_anchor = F.col("vec_id") % every == 0
    size = F.size("vector").cast("long")
    n = rows.agg(F.count("*").alias("rows"), F.sum(size).alias("row_size"), F.count_if(is_anchor).alias("anchors"),
                 F.sum(F.when(is_anchor, size)).alias("anchor_size")).first()
    row_blocks = 1 + max(n["rows"] // row_block, (n["row_size"] or 0) // BLOCK_SIZE)
    anchor_blocks = 1 + max(n["anchors"] // anchor_block, (n["anchor_size"] or 0) // BLOCK_SIZE)
    spot = lambda seed, blocks: F.pmod(F.xxhash64(F.lit(seed), "vec_id", "label", "vector"), F.lit(blocks)).cast("int")
    # an anchor is named by its id and a hash of the row: rows of one id are anchors of their own
    anchors = (rows.where(is_anchor)
               .select(F.xxhash64("label", "vector").alias("anchor"), "vec_id", "label", "vector", F.size("vector").alias("length"),
                       spot(1, anchor_blocks).alias("anchor_block")))
    anchors = stored(anchors, "negatives-anchors")
    dealt = rows.select("vec_id", "label", "vector", spot(2, row_blocks).alias("row_block"),
                        F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))).alias("anchor_block"))
    near = stored(_pass(anchors.withColumn("limits", F.lit(None).cast("array<long>")), dealt, row_blocks, positives, True), "negatives-positives")
    limits = near.groupBy(*ANCHOR).agg(F.sort_array(F.collect_set("score"), asc=False).alias("limits"))
    limited = anchors.join(limits.withColumnRenamed("anchor_id", "vec_id"), ["anchor", "vec_id"])
    far = _pass(limited, dealt, row_blocks, negatives, False)
    entry = F.struct(F.col("slot"), (-F.col("score")).alias("down"), F.col("row_id"))
    descending = far.groupBy(*ANCHOR).agg(F.sort_array(F.collect_list(entry)).alias("list"))
    window = (near.select(*ANCHOR, F.col("row_id").alias("positive_id"), F.col("score").alias("positive_score"))
              .join(limits, [*ANCHOR]).join(descending, [*ANCHOR]))
    slot = F.array_position("limits", F.col("positive_score")) - 1
    suffix = F.filter("list", lambda x: (x["slot"] >= slot) & (-100 * x["down"] >= FLOOR * F.col("positive_score")))
    answer = F.slice(suffix, 1, negatives)
    one = window.select("anchor_id", "positive_id", "positive_score", F.posexplode(answer).alias("at", "entry"))
    return one.select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("entry.row_id").alias("negative_id"),
                      "positive_score", (-F.col("entry.down")).alias("negative_score"))


def query(spark, sf_dir: str) -> DataFrame:
    return mine(relabelled(quantised(table(spark, sf_dir, "embeddings"))))


ORACLE_SQL = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS row_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, row_id, score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= 5)
SELECT p.anchor_id, p.row_id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.row_id AS negative_id,
       p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.row_id ORDER BY s.score DESC, s.row_id)
QUALIFY row_number() OVER w <= 5
"""
