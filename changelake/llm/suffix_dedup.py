"""Operator 4, suffix-array dedup: repeated byte strings by distributed prefix doubling.

Positions are ranked by growing stretches of text, and only positions whose rank is not yet
unique are ranked again, up to the threshold of 200 bytes. A rank is a 64-bit fingerprint of
the stretch, so a pair of ranks at an offset is again a rank and Spark needs to group equal
ranks, not to number them. Dense doubling would move a row for each byte in each round; here
a position enters the first round only if some 200-byte window picks it (one in about eighty,
see ``repeats``), which loses nothing: equal windows pick equal pieces at equal offsets.

Rounds: (1) the picked 40-byte pieces; (2) the stretch that all windows of a run span;
(3) for runs whose piece repeats in other surroundings, blocks of 16 window starts: if the
185 bytes common to a block's windows are unique, none of them repeats, and if all 215 bytes
repeat, each of them does; (4) the single windows of the remaining blocks, compared by the
bytes beyond the common ones. Rounds 3 and 4 always compare within equal pieces and equal
common bytes (128 bits of fingerprint, and the rest byte by byte).

Defined cases: a null text is empty; a text shorter than the threshold keeps everything; a
string that repeats within its own document counts (overlapping too); repeated rows repeat
each other; matches never cross documents; other columns are ignored.
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
from changelake.llm.store import release, stored, table

LENGTH = 200
PIECE = 40
BLOCK = 16
_BLOCKS = "doc long, key long, low int, target boolean, k1 long, slot int, core long, left binary, right binary"
_SAME = ["k1", "slot", "core"]


def _symbols(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return K.BYTE_CODE[data], starts


def _blocks(length: int, block: int):
    """Cuts runs into blocks of window starts at fixed distances before the piece.

    ``low`` is the first start a full block would have; ``left`` and ``right`` are the bytes
    before and after the common ones, as far as the run has windows there."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, key = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            data, starts = K.texts_of(batch.column(2))
            lists = batch.column(3)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            at, count, lead, target, k1 = (f.to_numpy(zero_copy_only=False) for f in lists.flatten().flatten())
            at, count, lead = (x.astype(np.int64) for x in (at, count, lead))
            for i, j in K.slices(starts):
                here = data[starts[i]:starts[j]]
                raw = here.tobytes()
                prints = K.Fingerprints(K.BYTE_CODE[here])
                mine = np.arange(first[i], first[j])
                text = np.repeat(np.arange(i, j), sizes[i:j])
                # distances piece - start: from near (last start) to far (first start)
                near, far = lead[mine] - count[mine] + 1, lead[mine]
                low_slot = near // block
                slot, owner = K.expand(low_slot, far // block - low_slot + 1)
                base = starts[text[owner]] - starts[i]
                piece = base + at[mine][owner] + lead[mine][owner]
                high = piece - slot * block
                low = high - block + 1
                begin = np.maximum(low, piece - far[owner])
                last = np.minimum(high, piece - near[owner])
                core = prints.of(high, low + length)
                cols = [pa.array(doc[text[owner]]), pa.array(key[text[owner]]), pa.array((low - base).astype(np.int32)), pa.array(target[mine][owner]),
                        pa.array(k1[mine][owner]), pa.array(slot.astype(np.int32)), pa.array(K.signed(core)),
                        pa.array([raw[a:b] for a, b in zip(begin, high)], pa.binary()),
                        pa.array([raw[a:b] for a, b in zip(low + length, last + length)], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc", "key", "low", "target", "k1", "slot", "core", "left", "right"])

    return task


def _first(block: int):
    return F.lit(block - 1) - F.length("left")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, piece: int = PIECE, block: int = BLOCK) -> DataFrame:
    """(doc, key, start, end) in bytes: stretches covered by strings that start elsewhere too."""
    rows = keyed(docs, id_col, text_col)
    base = stored(runs(rows, _symbols, length, piece), "byte-runs")
    found = candidates(base, "byte")
    whole = (found.where("n > 1")
             .select("doc", "key", F.col("at").alias("start"), (F.col("at") + F.col("windows") - 1 + length).alias("end")))
    open_runs = (found.where("mixed and key = first_key").withColumn("target", F.col("n") == 1)
                 .select("doc", "key", "at", "windows", "lead", "target", "k1").distinct().groupBy("doc", "key")
                 .agg(F.collect_list(F.struct("at", "windows", "lead", "target", "k1")).alias("runs")))
    blocks = stored(one_of_key(rows).join(open_runs, ["doc", "key"]).select("doc", "key", "text", "runs")
                    .mapInArrow(_blocks(length, block), _BLOCKS), "byte-blocks")
    common = blocks.groupBy(*_SAME).agg(F.count("*").alias("n"), F.max("target").alias("any_target")).where("n > 1 and any_target")
    shared = stored(blocks.join(common.select(*_SAME), _SAME), "byte-shared")
    release(blocks)
    full = shared.groupBy(*_SAME, "left", "right").agg(F.count("*").alias("n"))
    ranked = stored(shared.join(full, [*_SAME, "left", "right"]), "byte-ranked")
    release(shared)
    # the first start of a block is low + block - 1 - length(left), the last low + length(right)
    in_blocks = (ranked.where("target and n > 1")
                 .select("doc", "key", (F.col("low") + _first(block)).alias("start"),
                         (F.col("low") + F.length("right") + length).alias("end")))
    unique = ranked.where("n = 1").select("doc", "key", "low", "target", *_SAME, "left", "right")
    seen = (ranked.where("n > 1").select(*_SAME, "left", "right").distinct()
            .select(*[F.lit(None).cast("long").alias(c) for c in ("doc", "key")], F.lit(0).alias("low"), F.lit(False).alias("target"), *_SAME, "left", "right"))
    step = (unique.unionByName(seen).withColumn("i", F.explode(F.sequence(_first(block), F.length("right"))))
            .withColumn("l", F.expr(f"substring(left, length(left) - ({block} - 1 - i) + 1, {block} - 1 - i)"))
            .withColumn("r", F.expr("substring(right, 1, i)")).drop("left", "right"))
    single = stored(step, "byte-windows")
    again = single.groupBy(*_SAME, "i", "l", "r").agg(F.count("*").alias("n")).where("n > 1")
    start = F.col("low") + F.col("i")
    in_windows = (single.where("target").join(again, [*_SAME, "i", "l", "r"])
                  .select("doc", "key", start.alias("start"), (start + length).alias("end")))
    return whole.unionByName(in_blocks).unionByName(in_windows)


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, starts = K.texts_of(batch.column(1))
        offsets, begin, end = span_lists(batch.column(2))
        n_bytes = np.diff(starts)
        removed, spans, digest, kept = [], [], [], []
        for i, n in enumerate(n_bytes):
            body = data[starts[i]:starts[i + 1]]
            gone = np.zeros(n, bool)
            if offsets[i] < offsets[i + 1]:
                gone = K.covered(begin[offsets[i]:offsets[i + 1]], end[offsets[i]:offsets[i + 1]], n)
            removed.append(int(gone.sum()))
            spans.append(int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum()))
            rest = body[~gone].tobytes()
            digest.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
             pa.array(digest, pa.string()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          length: int = LENGTH, piece: int = PIECE, block: int = BLOCK) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes of every row."""
    spans = stored(repeated_spans(docs, id_col, text_col, length, piece, block), "byte-spans")
    rows = keyed(docs, id_col, text_col)
    out = (rows.join(spans_by_key(spans.distinct()), ["doc", "key"], "left").select("doc", "text", "spans")
           .mapInArrow(_strip, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"))
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")))


def query(spark, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents")).drop("kept")
