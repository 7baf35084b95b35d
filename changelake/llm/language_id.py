"""Operator 8, language identification by spans.

Script ranges narrow the candidates: each word's script (read off the lead bytes of its UTF-8
form) admits only the languages that use it. Each word gets a score for each candidate, the
sum of log probabilities of its byte trigrams. Viterbi then labels the words, with a penalty
for each change of language, so mixed texts come out as spans. The text's language is the one
with the most letters; its score is that share times the posterior of the language.

Trigrams are counted over all training documents on the cluster. What reaches the driver is
one row for each language and trigram bucket, bounded by languages x ``BUCKETS``.

Defined cases: a null text or one without a letter is ``und`` with score 0; a text whose
letters belong to no learned script gets the most frequent language with score 0; with
nothing learned every text is ``und``; equal shares go to the first name; repeated rows get
equal results; other columns are ignored. Texts are handled in groups by bytes and a very long
one in pieces between words, so memory follows ``BYTES_AT_ONCE`` and the longest text's words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.llm import kernels as K
from changelake.llm.chains import best_path
from changelake.llm.store import table

BUCKETS = 1 << 16
PENALTY = 12.0
#: A language uses a script if this share of its words is written in it.
SCRIPT_SHARE = 0.01
#: Bytes of text worked on at once, with up to four languages; with more, as many times fewer.
BYTES_AT_ONCE = 1 << 23
UND = "und"
SCRIPTS = ("latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "kana", "han", "hangul", "other")
_LETTER = regex.compile(r"\p{L}")


def _script_table() -> np.ndarray:
    """Script number by lead byte; 255 where no script begins."""
    t = np.full(256, 255, np.uint8)
    for name, low, high in (("latin", 0x61, 0x7A), ("latin", 0xC3, 0xCA), ("greek", 0xCD, 0xCF), ("cyrillic", 0xD0, 0xD4),
                            ("hebrew", 0xD6, 0xD7), ("arabic", 0xD8, 0xDC), ("indic", 0xE0, 0xE0), ("other", 0xE1, 0xE1),
                            ("kana", 0xE3, 0xE3), ("han", 0xE4, 0xE9), ("hangul", 0xEA, 0xED), ("other", 0xF0, 0xF0)):
        t[low:high + 1] = SCRIPTS.index(name)
    return t


SCRIPT = _script_table()
IS_WORD = np.zeros(256, bool)
IS_WORD[97:123] = True
IS_WORD[128:] = True
IS_WORD_ANY_CASE = IS_WORD[K.LOWER]
_C1, _C2, _C3 = (K.splitmix(256, s) for s in (101, 102, 103))


def _words(data: np.ndarray, starts: np.ndarray):
    """First byte, end byte and script of every word, the word offsets of the texts, and the
    trigram bucket around every byte."""
    low = K.LOWER[data]
    _, begin, end, offsets = K.words_of(low, starts, IS_WORD)
    plain = np.where(IS_WORD[low], low, np.uint8(32))
    framed = np.concatenate([[np.uint8(32)], plain, [np.uint8(32)]])
    if len(starts) > 2 and len(data):  # texts stand side by side; a border is a space on both sides
        inner = starts[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
    else:
        inner = np.zeros(0, np.int64)
    before, after = framed[:-2].copy(), framed[2:].copy()
    before[inner], after[inner - 1] = 32, 32
    bucket = ((_C1[before] ^ _C2[plain] ^ _C3[after]) >> K.U64(48)).astype(np.int64)
    script = SCRIPT[low[begin]] if len(begin) else np.zeros(0, np.uint8)
    return begin, end, script, offsets, bucket


def _in_words(begin: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    change = np.zeros(n + 1, np.int8)
    change[begin] += 1
    change[end] -= 1
    return np.cumsum(change[:-1], dtype=np.int8).astype(bool)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n); negative buckets are scripts."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        data, starts = K.texts_of(batch.column(1))
        for i, j in K.slices(starts):
            part = starts[i:j + 1] - starts[i]
            begin, end, script, offsets, bucket = _words(data[starts[i]:starts[j]], part)
            inside = _in_words(begin, end, len(bucket))
            names, number = np.unique(langs[i:j].astype(str), return_inverse=True)
            by_byte = np.repeat(number, np.diff(part))[inside]
            by_word = np.repeat(number, np.diff(offsets))
            for k, name in enumerate(names):
                total = totals.setdefault(name, np.zeros(BUCKETS + 256, np.int64))
                total[:BUCKETS] += np.bincount(bucket[inside][by_byte == k], minlength=BUCKETS)
                total[BUCKETS:] += np.bincount(script[by_word == k], minlength=256)
    for name, total in totals.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(total[at])],
                                         names=["lang", "bucket", "n"])


class Model:
    """Log probabilities by bucket and language, and which scripts each language uses."""

    def __init__(self, rows: list):
        self.langs = sorted({r[0] for r in rows})
        number = {name: k for k, name in enumerate(self.langs)}
        counts = np.zeros((BUCKETS + 256, len(self.langs)))
        for name, bucket, n in rows:
            counts[bucket, number[name]] = n
        grams, scripts = counts[:BUCKETS], counts[BUCKETS:]
        seen = max(int((grams.sum(axis=1) > 0).sum()), 1)
        self.log = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * seen)).astype(np.float32)
        share = scripts / np.maximum(scripts.sum(axis=0), 1)
        self.uses = share >= SCRIPT_SHARE
        self.common = int(grams.sum(axis=0).argmax()) if self.langs else 0


def fit(training: DataFrame) -> Model:
    """``training``: (lang, text), both from the rows one may learn from."""
    counts = training.select("lang", "text").mapInArrow(_count, "lang string, bucket int, n long")
    return Model([tuple(r) for r in counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()])


def _detect(model: Model, penalty: float, with_spans: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = BYTES_AT_ONCE * 4 // max(4, len(model.langs))
        for batch in batches:
            for part in K.groups(batch, most):
                yield _detect_rows(model, penalty, with_spans, part)

    return task


def _detect_rows(model: Model, penalty: float, with_spans: bool, batch: pa.RecordBatch) -> pa.RecordBatch:
    """(first column, lang_pred, score, spans) of a batch (any first column, text)."""
    k = len(model.langs)
    data, starts = K.texts_of(batch.column(1))
    scores, sizes, known, offsets = [], [], [], [np.zeros(1, np.int64)]
    cuts = K.pieces(data, starts, IS_WORD_ANY_CASE)
    for i, j in K.slices(cuts):
        begin, end, script, own, bucket = _words(data[cuts[i]:cuts[j]], cuts[i:j + 1] - cuts[i])
        offsets.append(own[1:] + offsets[-1][-1])
        sums = np.empty((len(begin), k), np.float32)  # of every language over the bytes of each word
        for c in range(k):
            run = np.concatenate([[0.0], np.cumsum(model.log[bucket, c], dtype=np.float64)])
            sums[:, c] = run[end] - run[begin]
        admitted = model.uses[script]
        sums[~admitted] = -1e4
        sums[~admitted.any(axis=1)] = 0
        scores.append(sums)
        sizes.append(end - begin)
        known.append(admitted.any(axis=1))
    offsets = np.concatenate(offsets)[np.searchsorted(cuts, starts)]
    n = len(offsets) - 1
    score = np.concatenate(scores) if scores else np.zeros((0, k), np.float32)
    size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
    seen = np.concatenate(known) if known else np.zeros(0, bool)
    label = best_path(score, offsets, penalty) if k else np.zeros(len(size), np.uint8)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    weight = np.zeros((n, k))
    total = np.zeros((n, k))
    for c in range(k):
        total[:, c] = np.bincount(owner, weights=score[:, c], minlength=n)
        mine = seen & (label == c)
        weight[:, c] = np.bincount(owner[mine], weights=size[mine], minlength=n)
    names, values = [], []
    for d, text in enumerate(batch.column(1).to_pylist()):
        if not k or not text or not _LETTER.search(text):
            names.append(UND)
            values.append(0.0)
            continue
        mine = weight[d]
        best = int(mine.argmax()) if mine.sum() else model.common
        posterior = 1 / np.exp(np.clip(total[d] - total[d, best], -700, 700)).sum()
        names.append(model.langs[best])
        values.append(float(mine[best] / mine.sum() * min(1.0, posterior)) if mine.sum() else 0.0)
    cols = [batch.column(0), pa.array(names, pa.string()), pa.array(values, pa.float64())]
    if with_spans:
        cols.append(_spans(label, owner, offsets, np.array([name != UND for name in names], bool), model.langs))
    return pa.RecordBatch.from_arrays(cols, names=["key", "lang_pred", "score", "spans"][:len(cols)])


def _spans(label: np.ndarray, owner: np.ndarray, offsets: np.ndarray, known: np.ndarray, langs: list[str]) -> pa.Array:
    """For each text the runs of words of one label; none for a text that is not ``known``."""
    new = np.ones(len(label) + 1, bool)
    new[1:-1] = (np.diff(label.astype(np.int64)) != 0) | (np.diff(owner) != 0)
    edge = np.flatnonzero(new)
    head, tail = edge[:-1], edge[1:]
    kept = known[owner[head]]
    head, tail = head[kept], tail[kept]
    base = offsets[owner[head]]
    rows = pa.StructArray.from_arrays(
        [pa.array((head - base).astype(np.int32)), pa.array((tail - base).astype(np.int32)),
         pa.array(langs or [UND], pa.string()).take(pa.array(label[head].astype(np.int32)))], names=["start", "end", "lang"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner[head], np.arange(len(offsets))).astype(np.int32)), rows)


def detect(docs: DataFrame, model: Model, key: Column, text_col: str = "text", penalty: float = PENALTY,
           with_spans: bool = True) -> DataFrame:
    """key, lang_pred, score and spans (in words) of every row."""
    schema = "key long, lang_pred string, score double" + (
        ", spans array<struct<start:int,end:int,lang:string>>" if with_spans else "")
    return (docs.select(key.cast("long").alias("key"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(_detect(model, penalty, with_spans), schema))


def with_language(docs: DataFrame, model: Model, text_col: str = "text", penalty: float = PENALTY) -> DataFrame:
    """``docs`` in a column ``row``, with lang_pred and score."""
    kind = docs.select(F.struct("*").alias("key")).schema["key"].dataType.simpleString()
    return (docs.select(F.struct("*").alias("key"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(_detect(model, penalty, False), f"key {kind}, lang_pred string, score double")
            .withColumnRenamed("key", "row"))


def fold(id_col: str, n: int) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))


def train(docs: DataFrame) -> Model:
    """From the text and language of documents whose remainder is not 1."""
    return fit(docs.where(F.coalesce(fold("doc_id", 3) != 1, F.lit(True)) & F.col("lang").isNotNull()
                          & F.col("text").isNotNull()))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = detect(docs, train(docs), F.col("doc_id"))
    return out.select(F.col("key").alias("doc_id"), F.coalesce(fold("key", 3) == 1, F.lit(False)).alias("held_out"),
                      "lang_pred", "score", "spans")
