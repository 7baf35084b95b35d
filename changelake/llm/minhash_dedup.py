"""Operator 10, MinHash near-duplicates.

1. Every text becomes its set of word shingles (64-bit fingerprints) and ``BANDS`` x ``ROWS``
   minima of universal hashes, folded to one key for each band. Texts of equal sets are one
   class, represented by its least id.
2. Classes that share a band key are candidates. A bucket is represented by a star from its
   least id, so a bucket of any size gives one edge for each member.
3. Candidate edges are verified on the full sets.
4. Verified links are joined to components by alternating large-star and small-star.
5. A link between two members of a bucket need not show in the stars. So wherever a cluster of
   candidates has not become one component, the members outside its largest component are
   compared with the whole cluster, in blocks of bounded size, again on full sets. Together
   with 3 this covers every pair that shares a band key, without emitting pairs: a block
   returns at most one link for each member.

At a similarity of 0.8 a pair shares no band key with probability (1 - 0.8^5)^40 = 1.2e-7.

Defined cases: null and empty texts have empty sets and are linked with nothing; a text of
fewer words than the shingle is one shingle; rows of one id are one node of the graph, linked
with all that any of its texts is linked with, but a row without words stands alone whatever its
id; a row without an id has no component and is kept; the order of rows, repeated rows and ties
do not matter; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm import kernels as K
from changelake.llm.store import release, stored, table

BANDS, ROWS = 40, 5
SIMILARITY = 80
BLOCK = 256
IS_WORD = ~K.SPACE
_A = K.splitmix(BANDS * ROWS, 11) | K.U64(1)
_B = K.splitmix(BANDS * ROWS, 13)
_EMPTY = np.zeros(0, K.U64)


def _shingles(data: np.ndarray, starts: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    words, _, _, offsets = K.words_of(K.LOWER[data], starts, IS_WORD)
    prints = K.Fingerprints(words)
    grams = prints.grams(k) if len(words) >= k else _EMPTY
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(grams[a:b - k + 1]))
        elif b > a:
            out.append(prints.of(np.array([a]), np.array([b])))
        else:
            out.append(_EMPTY)
    return out


def _signatures(k: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = K.texts_of(batch.column(1))
            for i, j in K.slices(starts):
                sets = _shingles(data[starts[i]:starts[j]], starts[i:j + 1] - starts[i], k)
                sizes = np.array([len(s) for s in sets])
                full = np.flatnonzero(sizes)
                flat = np.concatenate(sets) if len(full) else _EMPTY
                edge = (np.cumsum(sizes) - sizes)[full]
                keys = np.zeros((len(full), BANDS), K.U64)
                name = np.zeros((2, j - i), K.U64)
                if len(full):
                    for h in range(BANDS * ROWS):
                        least = np.minimum.reduceat((flat * _A[h] + _B[h]) >> K.U64(32), edge)
                        keys[:, h // ROWS] = K.mix(keys[:, h // ROWS] * K.U64(31) + least + K.U64(h))
                    name[0, full] = np.add.reduceat(K.mix(flat), edge)
                    name[1, full] = np.add.reduceat(K.mix(flat ^ K.U64(0x5851F42D4C957F2D)), edge)
                bands = np.full((j - i,), None, object)
                for row, d in enumerate(full):
                    bands[d] = K.signed(keys[row])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(sizes, pa.int64()), pa.array(K.signed(name[0])), pa.array(K.signed(name[1])),
                     pa.array(list(bands), pa.list_(pa.int64()))], names=["doc", "n", "s1", "s2", "bands"])

    return task


def _name(shingles: np.ndarray) -> int:
    """The first half of a set's name, as ``_signatures`` gives it."""
    return int(K.signed(np.add.reduce(K.mix(shingles), keepdims=True))[0]) if len(shingles) else 0


def _sets(k: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = K.texts_of(batch.column(1))
            for i, j in K.slices(starts):
                sets = _shingles(data[starts[i]:starts[j]], starts[i:j + 1] - starts[i], k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array([_name(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["doc", "s1", "shingles"])

    return task


def _verify(similarity: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(s.as_buffer(), K.U64) for s in (x, y))
                if 100 * min(len(x), len(y)) < similarity * max(len(x), len(y)):
                    good.append(False)
                    continue
                both = np.intersect1d(x, y, assume_unique=True).size
                good.append(100 * both >= similarity * (len(x) + len(y) - both))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("u").filter(keep), batch.column("v").filter(keep)], names=["u", "v"])

    return task


def _block_links(similarity: int):
    """Links between the outsiders and the others of one block pair, at most one for each
    member: those that join parts not joined yet."""

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["outside"]], pdf[~pdf["outside"]]
        sets = [[np.frombuffer(s, K.U64) for s in part["shingles"]] for part in (left, right)]
        sizes = [np.array([len(s) for s in part], np.int64) for part in sets]
        out: list[tuple[int, int]] = []
        if len(left) and len(right):
            flat = [np.concatenate(part) for part in sets]
            owner = [np.repeat(np.arange(len(s)), s) for s in sizes]
            shared = np.intersect1d(*[np.unique(f) for f in flat])
            both = np.zeros((len(left), len(right)), np.float32)
            for at in range(0, len(shared), 4096):  # counted in slices of the shared shingles
                piece = shared[at:at + 4096]
                grid = []
                for f, o, s in zip(flat, owner, sizes):
                    column = np.minimum(np.searchsorted(piece, f), len(piece) - 1)
                    hit = piece[column] == f
                    m = np.zeros((len(s), len(piece)), np.float32)
                    m[o[hit], column[hit]] = 1
                    grid.append(m)
                both += grid[0] @ grid[1].T
            common = both.astype(np.int64)
            linked = 100 * common >= similarity * (sizes[0][:, None] + sizes[1][None, :] - common)
            linked &= left["comp"].to_numpy()[:, None] != right["comp"].to_numpy()[None, :]
            parent: dict[int, int] = {}

            def root(c: int) -> int:
                while parent.setdefault(c, c) != c:
                    parent[c] = c = parent[parent[c]]
                return c

            for i, j in zip(*np.nonzero(linked)):
                a, b = root(int(left["comp"].iat[i])), root(int(right["comp"].iat[j]))
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    out.append((max(a, b), min(a, b)))
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return links


def _unfinished(edges: DataFrame) -> bool:
    """Whether some node has two edges to lesser nodes, or one, and is itself a lesser end.
    Otherwise the edges are stars around the least nodes of their components."""
    end = lambda c, up: F.struct(F.col(c).alias("node"), F.lit(up).alias("up"))
    ends = edges.select(F.inline(F.array(end("u", 1), end("v", 0))))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return nodes.where("up > 1 or up = 1 and least = 0").agg(F.count("*")).first()[0] > 0


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, comp) of every node with an edge (u, v), comp the least node it reaches, by
    alternating large-star and small-star until the edges are stars."""
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), name)
    while _unfinished(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, f"{name}-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        after = stored(small, name)
        release(now, large)
        now = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("comp"))).distinct()


def _residual(nodes: DataFrame, sets: DataFrame, similarity: int, block: int) -> DataFrame:
    """Links found by comparing outsiders with their clusters. ``nodes``: (node, cluster, comp)."""
    sizes = nodes.groupBy("cluster", "comp").agg(F.count("*").alias("n"))
    shape = (sizes.groupBy("cluster").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max(F.struct("n", "comp"))["comp"].alias("main"))
             .where("most < n"))
    open_nodes = nodes.join(shape, "cluster").join(sets, F.col("node") == F.col("doc"))
    part = lambda n: F.ceil(n / block).cast("int")
    spot = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    out_blocks, all_blocks = part(F.col("n") - F.col("most")), part(F.col("n"))
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    outside = (open_nodes.where("comp != main")
               .select("cluster", spot(out_blocks).alias("i"), every(all_blocks).alias("j"), F.lit(True).alias("outside"), "comp", "shingles"))
    member = open_nodes.select("cluster", every(out_blocks).alias("i"), spot(all_blocks).alias("j"), F.lit(False).alias("outside"), "comp", "shingles")
    return outside.unionByName(member).groupBy("cluster", "i", "j").applyInPandas(_block_links(similarity), "u long, v long")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 2, similarity: int = SIMILARITY,
          block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    signed = stored(texts.mapInArrow(_signatures(shingle), "doc long, n long, s1 long, s2 long, bands array<long>"), "minhash")
    named = signed.where("n > 0 and doc is not null")
    classes = stored(named.groupBy("s1", "s2").agg(F.min("doc").alias("rep"), F.first("bands").alias("bands")), "minhash-classes")
    keys = classes.select("rep", F.explode("bands").alias("h"))
    buckets = keys.groupBy("h").agg(F.min("rep").alias("v"), F.max("rep").alias("last")).where("v < last").select("h", "v")
    stars = stored(keys.join(buckets, "h").where("rep != v").select(F.col("rep").alias("u"), "v").distinct(), "minhash-stars")
    # an id with several texts stands in several classes: their representatives are linked
    several = (named.groupBy("doc").agg(F.min(F.struct("s1", "s2")).alias("a"), F.max(F.struct("s1", "s2")).alias("b"))
               .where("a != b").select("doc"))
    held = stored(named.select("doc", "s1", "s2").join(several, "doc").distinct(), "minhash-several")
    shared = held.join(classes.select("s1", "s2", "rep"), ["s1", "s2"]).where("doc != rep").select(F.col("doc").alias("u"), F.col("rep").alias("v"))
    cluster = components(stars, "minhash-clusters").withColumnRenamed("comp", "cluster")
    ids = cluster.select(F.col("node").alias("doc"))
    # a merge join at every size: the ids grow with the corpus, and a broadcast of them would not
    sets = stored(texts.join(ids.hint("merge"), "doc").mapInArrow(_sets(shingle), "doc long, s1 long, shingles binary")
                  .groupBy("doc", "s1").agg(F.first("shingles").alias("shingles")), "minhash-sets")
    side = lambda c, s: sets.select(F.col("doc").alias(c), F.col("shingles").alias(s))
    links = stored(stars.join(side("u", "x"), "u").join(side("v", "y"), "v").mapInArrow(_verify(similarity), "u long, v long")
                   .unionByName(shared), "minhash-links")
    comp = components(links, "minhash-linked")
    nodes = stored(cluster.join(comp, "node", "full").select("node", "cluster", F.coalesce("comp", "node").alias("comp")), "minhash-nodes")
    rest = components(_residual(nodes.where("cluster is not null"), sets, similarity, block), "minhash-rest").toDF("comp", "root")
    final = nodes.join(rest, "comp", "left").select(F.col("node").alias("rep"), F.coalesce("root", "comp").alias("component"))
    by_set = classes.select("s1", "s2", "rep").join(final, "rep", "left").select("s1", "s2", F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc", "n", "s1", "s2").join(by_set, ["s1", "s2"], "left")
    component = F.when(F.col("doc").isNotNull(), F.when(F.col("n") > 0, F.coalesce("component", "doc")).otherwise(F.col("doc")))
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("doc"), F.lit(True)).alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))
