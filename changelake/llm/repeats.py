"""Shared first half of the two exact substring operators: which stretches may repeat.

Fingerprinting every window of a corpus costs a row for each byte or word. Instead each
window is represented by the piece it picks (``kernels.sampled_runs``): windows can only be
equal if they picked equal pieces at equal offsets. Consecutive windows with one pick form a
run. Runs are ranked twice: by the piece alone (``k1``) and by the whole stretch that their
windows span (``k2``). A run whose piece occurs once is out. A run whose whole stretch
occurs again needs no finer look. Only runs whose piece repeats in different surroundings
go to the operators' second half.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm import kernels as K
from changelake.llm.store import release, row_key, stored

#: doc: order of the document (null id last); key: the row; at: first window start; windows:
#: number of windows; lead: symbols from ``at`` to the piece.
RUNS = "doc long, key long, at int, windows int, lead int, k1 long, k2 long"
NULL_ID = (1 << 63) - 1

#: Symbols (64-bit codes) and symbol offsets of texts, from their bytes and byte offsets.
Symbols = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, key, text) of any table; other columns and their names do not matter."""
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc"),
                       row_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))


def runs(keyed_docs: DataFrame, symbols: Symbols, window: int, piece: int) -> DataFrame:
    """The runs of every text that has a window."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, key = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            data, starts = K.texts_of(batch.column(2))
            for i, j in K.slices(starts):
                sym, offsets = symbols(data[starts[i]:starts[j]], starts[i:j + 1] - starts[i])
                text, s, e, p, prints, grams = K.sampled_runs(sym, offsets, window, piece)
                if not len(text):
                    continue
                whole = prints.of(s, e + window)
                shape = ((p - s) << 32 | (e - s)).astype(K.U64)
                cols = [doc[i + text], key[i + text], (s - offsets[text]).astype(np.int32), (e - s + 1).astype(np.int32),
                        (p - s).astype(np.int32), K.signed(grams[p]), K.signed(K.mix(whole ^ K.mix(shape + K.U64(1))))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols],
                                                 names=["doc", "key", "at", "windows", "lead", "k1", "k2"])

    return keyed_docs.mapInArrow(task, RUNS)


def candidates(run_rows: DataFrame, name: str) -> DataFrame:
    """Runs whose piece repeats, with ``n`` (runs with the same stretch), ``first_doc`` and
    ``first_key`` (least of them) and ``mixed`` (the piece has other surroundings too).

    Every group is combined before its shuffle and joined back by a merge join. What is joined
    back is stored first: AQE splits a large partition of a join only where the join reads
    plain shuffles, not the end of an aggregate. ``run_rows`` is a stored table and is released."""
    pieces = (run_rows.groupBy("k1").agg(F.count("*").alias("runs"), (F.min("k2") < F.max("k2")).alias("mixed"))
              .where("runs > 1").drop("runs"))
    pieces = stored(pieces, f"{name}-pieces")
    again = stored(run_rows.join(pieces.hint("merge"), "k1"), f"{name}-again")
    release(run_rows, pieces)
    classes = again.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min("doc").alias("first_doc"), F.min("key").alias("first_key"))
    classes = stored(classes, f"{name}-classes")
    found = stored(again.join(classes.hint("merge"), ["k1", "k2"]), f"{name}-candidates")
    release(again, classes)
    return found


def one_of_key(keyed_docs: DataFrame) -> DataFrame:
    """``keyed`` rows without those whose id and key came before in their task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            new = []
            for name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                new.append(name not in seen)
                seen.add(name)
            yield batch.filter(pa.array(new, pa.bool_()))

    return keyed_docs.mapInArrow(task, "doc long, key long, text string")


def spans_by_key(spans: DataFrame) -> DataFrame:
    """(doc, key, spans) from (doc, key, start, end); a text has fewer spans than symbols."""
    return spans.groupBy("doc", "key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def span_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, starts and ends of a column made by ``spans_by_key``; null is empty."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    return (np.concatenate([[0], np.cumsum(counts)]).astype(np.int64),
            flat.field(0).to_numpy(zero_copy_only=False).astype(np.int64),
            flat.field(1).to_numpy(zero_copy_only=False).astype(np.int64))
