"""Operator 9, substring dedup: repeated word windows by level-wise doubling.

Windows repeated at one length alone are extended to the next: the 13-word pieces that the
50-word windows pick (about a quarter of the length, on sampled positions), then the whole
stretch of each run of windows, then the 50-word windows themselves. At each level only what
repeats at the level before goes on, so the costly last level sees few rows.

A window's words are named by 64-bit fingerprints, and a window is compared with others of the
same piece only (128 bits together). A match across a document border cannot occur, since
windows are taken within documents.

Defined cases: a null or empty text has no words; a text of fewer words than the window
keeps all of them; rows with equal ids never count as smaller than each other; a null id
counts as larger than every id; repeated rows get equal results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm import kernels as K
from changelake.llm.repeats import NULL_ID, candidates, keyed, one_of_key, runs, span_lists, spans_by_key
from changelake.llm.store import stored, table

WINDOW = 50
PIECE = 13
IS_WORD = ~K.SPACE


def _symbols(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    prints, _, _, offsets = K.words_of(data, starts, IS_WORD)
    return prints, offsets


def _windows(window: int):
    """Every window of the given runs with its fingerprint."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, key = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            data, starts = K.texts_of(batch.column(2))
            lists = batch.column(3)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            at, count, k1 = (f.to_numpy(zero_copy_only=False) for f in lists.flatten().flatten())
            for i, j in K.slices(starts):
                sym, offsets = _symbols(data[starts[i]:starts[j]], starts[i:j + 1] - starts[i])
                prints = K.Fingerprints(sym)
                mine = np.arange(first[i], first[j])
                text = np.repeat(np.arange(i, j), sizes[i:j])
                pos, owner = K.expand(at[mine].astype(np.int64), count[mine])
                text = text[owner]
                begin = pos + offsets[text - i]
                cols = [k1[mine][owner], K.signed(prints.of(begin, begin + window)), doc[text], key[text], pos.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["k1", "w", "doc", "key", "at"])

    return task


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, starts, ends = span_lists(batch.column(2))
        out: list[tuple] = []
        for i, text in enumerate(batch.column(1).to_pylist()):
            words = (text or "").encode().split()
            kept, removed = words, 0
            if offsets[i] < offsets[i + 1]:
                gone = K.covered(starts[offsets[i]:offsets[i + 1]], ends[offsets[i]:offsets[i + 1]], len(words))
                removed = int(gone.sum())
                kept = [words[k] for k in np.flatnonzero(~gone)]
            body = b" ".join(kept)
            out.append((len(words), removed, hashlib.sha256(body).hexdigest(), body.decode()))
        cols = list(zip(*out)) if out else [()] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
             pa.array(cols[3], pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, piece: int = PIECE) -> DataFrame:
    """(doc, key, start, end) in words: stretches whose windows also start in a document of smaller id."""
    rows = keyed(docs, id_col, text_col)
    base = stored(runs(rows, _symbols, window, piece), "word-runs")
    found = candidates(base, "word")
    whole = (found.where("first_doc < doc")
             .select("doc", "key", F.col("at").alias("start"), (F.col("at") + F.col("windows") - 1 + window).alias("end")))
    open_runs = (found.where("mixed and doc = first_doc").select("doc", "key", "at", "windows", "k1").distinct().groupBy("doc", "key")
                 .agg(F.collect_list(F.struct("at", "windows", "k1")).alias("runs")))
    windows = stored(one_of_key(rows).join(open_runs, ["doc", "key"]).select("doc", "key", "text", "runs")
                     .mapInArrow(_windows(window), "k1 long, w long, doc long, key long, at int"), "word-windows")
    least = windows.groupBy("k1", "w").agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc")).where("first_doc < last_doc")
    single = (windows.join(least, ["k1", "w"]).where("first_doc < doc")
              .select("doc", "key", F.col("at").alias("start"), (F.col("at") + window).alias("end")))
    return whole.unionByName(single)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          window: int = WINDOW, piece: int = PIECE) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the kept text of every row of ``docs``."""
    spans = stored(repeated_spans(docs, id_col, text_col, window, piece).distinct(), "word-spans")
    rows = keyed(docs, id_col, text_col)
    out = (rows.join(spans_by_key(spans), ["doc", "key"], "left").select("doc", "text", "spans")
           .mapInArrow(_strip, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"))
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")))


def query(spark, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents")).drop("kept_text")
