"""Operator 6, benchmark decontamination with a distributed positional inverted index.

The training text is indexed in blocks of about a megabyte: for each test term the sorted
positions at which it stands, plus where the block's documents begin. The index is a table
with one row for each block, written to the shared folder, so it is spread over the cluster
and needs no shuffle. Each block then answers all test windows at once: windows with an
absent term are out; the rest start from the postings of their rarest term in that block and
are intersected, offset-adjusted, with the lists of the next rarest terms, until nothing or a
phrase match remains. With a slack, lists are intersected within that many words of their
place in the phrase, which gives proximity matches. A proximity match is placed by the rarest
of its terms in the block; its words, too, lie in one document. ``matches`` returns the exact
and the proximity matches, and ``scan`` derives its counts from them.

The test windows travel to the tasks; their texts are cut into parts of ``PART_BYTES``, so
the size of what is broadcast is bounded, and each part has its own index of its own terms.

Defined cases: a null text has no words; an item without words has no window, one with fewer
words than the window is one window; matches never cross documents; rows with equal id and
text get equal results; a document without words is not contaminated; other columns and
their names do not matter. Items without an id are left out unless ``unnamed``, as the query
and the pipeline say: then their windows count for the spans, together they are one more item
of ``n_items``, and ``items_sha256`` does not name them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm import kernels as K
from changelake.llm.store import row_key, stored, table

WINDOW = 13
SLACK = 2
#: Contaminated from this share of words inside matches: 1 of so many.
SHARE = 20
PART_BYTES = 4 << 20
IS_WORD = np.zeros(256, bool)
IS_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_INDEX = ("keys array<long>, ids array<long>, sizes array<int>, terms array<int>, counts array<int>, postings array<int>")
_MATCHES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("window", pa.int64()), ("exact", pa.bool_()),
                               ("items", pa.list_(pa.int64()))]))
_HITS = "key long, doc_id long, matches array<struct<start:int,end:int,window:long,exact:boolean,items:array<long>>>"


def lowered_words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the words of A-Z lower-cased texts, and the word offsets of the texts."""
    prints, _, _, offsets = K.words_of(K.LOWER[data], starts, IS_WORD)
    return prints, offsets


class Queries:
    """Test windows of one part of the benchmark: term numbers by window, items by window."""

    def __init__(self, items: list, texts: list, window: int):
        data, starts = K.texts_of(pa.array(texts, pa.string()))
        prints, offsets = lowered_words(data, starts)
        self.terms, numbers = np.unique(prints, return_inverse=True)
        all_prints = K.Fingerprints(prints)
        by_length: dict[int, dict[tuple, tuple[int, list[int]]]] = {}
        for k, item in enumerate(items):
            words = numbers[offsets[k]:offsets[k + 1]].tolist()
            n = min(window, len(words))
            first = offsets[k] + np.arange(len(words) - n + 1 if n else 0)
            for p, name in enumerate(K.signed(all_prints.of(first, first + n)).tolist()):
                by_length.setdefault(n, {}).setdefault(tuple(words[p:p + n]), (name, []))[1].append(item)
        #: (length, windows x length term numbers, fingerprint and items of each window)
        self.groups = [(n, np.array(list(w), np.int64), [(name, sorted(set(x), key=lambda i: (i is not None, i)))
                                                         for name, x in w.values()]) for n, w in by_length.items()]


def _index(terms: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key, ids = batch.column(0), batch.column(1)
        data, starts = K.texts_of(batch.column(2))
        for i, j in K.slices(starts):
            prints, offsets = lowered_words(data[starts[i]:starts[j]], starts[i:j + 1] - starts[i])
            number = np.minimum(np.searchsorted(terms, prints), max(len(terms) - 1, 0))
            at = np.flatnonzero(terms[number] == prints) if len(terms) else np.zeros(0, np.int64)
            order = np.argsort(number[at], kind="stable")
            found, counts = np.unique(number[at], return_counts=True)
            one = lambda x, t: pa.array([x], pa.list_(t))
            yield pa.RecordBatch.from_arrays(
                [one(key[i:j].to_pylist(), pa.int64()), one(ids[i:j].to_pylist(), pa.int64()), one(np.diff(offsets), pa.int32()),
                 one(found, pa.int32()), one(counts, pa.int32()), one(at[order], pa.int32())],
                names=["keys", "ids", "sizes", "terms", "counts", "postings"])


class Block:
    """One row of the index. A list is a range of ``packed``: term number, then position."""

    def __init__(self, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray, postings: np.ndarray, n_terms: int):
        self.offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.words = int(self.offsets[-1])
        self.stride = self.words + 1
        self.packed = np.repeat(terms.astype(np.int64), counts) * self.stride + postings
        self.count = np.zeros(n_terms, np.int64)
        self.count[terms] = counts
        self.begin = np.zeros(n_terms, np.int64)
        self.begin[terms] = np.cumsum(counts) - counts
        self.postings = postings.astype(np.int64)

    def search(self, windows: np.ndarray, slack: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window numbers, start positions, and whether the match is exact."""
        counts = self.count[windows]
        alive = np.flatnonzero(counts.min(axis=1) > 0)
        order = np.argsort(counts[alive], axis=1, kind="stable")
        rare = windows[alive, order[:, 0]]
        place, owner = K.expand(self.begin[rare], self.count[rare])
        start = self.postings[place] - order[owner, 0]
        length = windows.shape[1]
        doc = np.searchsorted(self.offsets, np.maximum(start, 0), side="right") - 1
        inside = (start >= 0) & (start + length <= self.offsets[np.minimum(doc + 1, len(self.offsets) - 1)])
        start, owner, doc = start[inside], owner[inside], doc[inside]
        exact = np.ones(len(start), bool)
        for step in range(1, length):
            column = order[owner, step]
            wanted = windows[alive[owner], column] * self.stride + start + column
            at = np.minimum(np.searchsorted(self.packed, wanted), len(self.packed) - 1)
            same = self.packed[at] == wanted
            near = same
            if slack:
                term = wanted - start - column
                least = np.maximum(wanted - slack, term + self.offsets[doc])
                most = np.minimum(wanted + slack, term + self.offsets[doc + 1] - 1)
                low = np.minimum(np.searchsorted(self.packed, least), len(self.packed) - 1)
                near = (self.packed[low] >= least) & (self.packed[low] <= most)
            exact &= same
            start, owner, doc, exact = start[near], owner[near], doc[near], exact[near]
        return alive[owner], start, exact


def _matches(queries: Queries, slack: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                keys, sizes, terms, counts, postings = (
                    batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in ("keys", "sizes", "terms", "counts", "postings"))
                if not len(postings):
                    continue
                block = Block(sizes, terms, counts, postings, len(queries.terms))
                found: dict[int, list] = {}
                for length, windows, owners in queries.groups:
                    which, start, exact = block.search(windows, slack)
                    doc = np.searchsorted(block.offsets, start, side="right") - 1
                    for w, s, e, d in zip(which.tolist(), (start - block.offsets[doc]).tolist(), exact.tolist(), doc.tolist()):
                        name, items = owners[w]
                        found.setdefault(d, []).append({"start": s, "end": s + length, "window": name, "exact": e, "items": items})
                if hit := sorted(found):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(keys[d]) for d in hit], pa.int64()), batch.column("ids")[row].values.take(pa.array(hit)),
                         pa.array([found[d] for d in hit], _MATCHES)], names=["key", "doc_id", "matches"])

    return task


def _parts(benchmark: DataFrame, item_col: str, text_col: str, unnamed: bool) -> Iterator[tuple[list, list]]:
    """The benchmark, in parts of bounded size."""
    rows = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text"))
    if not unnamed:
        rows = rows.where("item is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // PART_BYTES) or 1
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect()
        yield [r.item for r in part], [r.text for r in part]


def _score(share: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n, matches in zip(*(batch.column(c).to_pylist() for c in ("n_words", "matches"))):
                exact = [m for m in matches or () if m["exact"]]
                near = len({(m["start"], m["end"], m["window"]) for m in matches or () if not m["exact"]})
                inside = 0
                last = 0
                for a, b in sorted({(m["start"], m["end"]) for m in exact}):
                    inside += max(0, b - max(a, last))
                    last = max(last, b)
                items = {i for m in exact for i in m["items"]}
                names = sorted(str(i) for i in items if i is not None)
                out.append((n, inside, len(items), hashlib.sha256(",".join(names).encode()).hexdigest(),
                            inside > 0 and share * inside >= n, near))
            cols = list(zip(*out)) if out else [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                names=["key", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near"])

    return task


def _search(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str,
            window: int, slack: int, unnamed: bool) -> tuple[DataFrame, DataFrame]:
    """(key, doc_id, n_words) of every row, and (key, doc_id, matches) of every key with matches."""
    rows = docs.select(row_key(id_col, text_col).alias("key"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    base = hits = None
    for items, texts in _parts(benchmark, item_col, item_text_col, unnamed):
        queries = Queries(items, texts, window)
        terms = queries.terms
        index = stored(rows.mapInArrow(lambda batches, terms=terms: _index(terms, batches), _INDEX), "positional-index")
        found = index.select("keys", "ids", "sizes", "terms", "counts", "postings").mapInArrow(_matches(queries, slack), _HITS)
        hits = found if hits is None else hits.unionByName(found)
        if base is None:
            base = index.select(F.inline(F.arrays_zip("keys", "ids", "sizes"))).toDF("key", "doc_id", "n_words")
    # equal rows have equal lists in each part
    by_key = hits.groupBy("key", "doc_id").agg(F.flatten(F.collect_set("matches")).alias("matches"))
    return base, by_key


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text", window: int = WINDOW, slack: int = SLACK, unnamed: bool = False) -> DataFrame:
    """key, doc_id, item, start, end (in words of the document) and exact of every match; a match
    that is not exact is one within the slack. Equal rows share a key and its matches."""
    _, by_key = _search(docs, benchmark, id_col, text_col, item_col, item_text_col, window, slack, unnamed)
    one = by_key.select("key", "doc_id", F.inline("matches"))
    return one.select("key", "doc_id", F.explode("items").alias("item"), "start", "end", "exact").distinct()


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", window: int = WINDOW, slack: int = SLACK, share: int = SHARE, unnamed: bool = False) -> DataFrame:
    """key (see ``store.row_key``), doc_id, n_words, n_hit, n_items, items_sha256, contaminated
    and n_near (distinct windows by place that match within the slack only) of every row."""
    base, by_key = _search(docs, benchmark, id_col, text_col, item_col, item_text_col, window, slack, unnamed)
    found = by_key.select(F.col("key").alias("_key"), F.col("doc_id").alias("_id"), "matches")
    same = (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    joined = base.join(found, same, "left").select("key", "doc_id", F.col("n_words").cast("long").alias("n_words"), "matches")
    return joined.mapInArrow(_score(share), "key long, doc_id long, n_words long, n_hit long, n_items long, "
                                            "items_sha256 string, contaminated boolean, n_near long")


def query(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), unnamed=True).drop("key", "n_near")


ORACLE_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
q AS (SELECT item_id, least(13, len(words)) AS n, unnest(range(0, greatest(len(words) - 13, 0) + 1)) AS p, words FROM b WHERE len(words) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(words[p + 1:p + n], ' ') AS phrase FROM q),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, words, n, unnest(range(0, len(words) - n + 1)) AS p FROM w, lengths WHERE len(words) >= n),
matches AS (SELECT doc_id, item_id, p, windows.n FROM places JOIN windows
            ON windows.n = places.n AND phrase = array_to_string(words[p + 1:p + places.n], ' ')),
hit AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS x FROM matches) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM matches) GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
