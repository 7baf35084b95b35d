"""Operator 2, toxicity: a linear-chain conditional random field over words.

Labels come for documents, so token labels are made first: words and word beginnings are
weighed by how much more often they occur in toxic than in other documents, and a word of a
toxic document whose weight is high counts as toxic. On those tokens a two-label chain is
trained (own weight, the neighbours' weights, transitions). Forward-backward marginals then
give P(toxic) for every word of every text; a logistic of their sum, greatest and mean gives
the document's score, and words with a marginal of at least 0.5 are the offending offsets.

Fitting uses a bounded sample of the labelled rows (``SAMPLE`` per class, for the weights and
the logistic; ``CHAIN_DOCS`` per class for the chain), chosen by a hash of the id. Scoring
covers every text.

Defined cases: null and empty texts have no words and get the score of a text without
toxic words; several labels of one id count as toxic if any is; ids without a text and texts
without a label are fine; without both classes among the labels every score is the share of
toxic labels; repeated rows get equal results; other columns are ignored. Texts are handled in
groups by bytes and a very long one in pieces between words, so memory follows ``BYTES_AT_ONCE``
and the longest text's words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.llm import kernels as K
from changelake.llm.chains import marginals
from changelake.llm.store import stored, table

SAMPLE = 6000
CHAIN_DOCS = 120
THRESHOLD = 0.3
#: Byte lengths of the word beginnings that are features beside the word itself.
PREFIXES = (4, 5, 6)
MIN_TOXIC_DOCS = 3
#: Log odds from which a feature enters the lexicon, and from which a token is labelled toxic.
LEXICON_ODDS, LABEL_ODDS = 1.5, 2.5
BINS = np.array([0.5, 1.5, 2.5, 3.5, 5.0])
#: Bytes of text worked on at once.
BYTES_AT_ONCE = 1 << 23
IS_WORD = np.zeros(256, bool)
IS_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
IS_WORD_ANY_CASE = IS_WORD[K.LOWER]


def _features(data: np.ndarray, starts: np.ndarray):
    """Feature fingerprints (kinds x words), first and end bytes, and word offsets."""
    low = K.LOWER[data]
    words, begin, end, offsets = K.words_of(low, starts, IS_WORD)
    prints = K.Fingerprints(K.BYTE_CODE[low])
    kinds = [words]
    for n in PREFIXES:
        cut = prints.of(begin, np.minimum(begin + n, end))
        kinds.append(K.mix(np.where(end - begin > n, cut, words) + K.U64(n)))
    return np.stack(kinds), begin, end, offsets


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, n0, n1): documents of either class that have the feature."""
    for batch in batches:
        toxic = batch.column(0).to_numpy(zero_copy_only=False)
        data, starts = K.texts_of(batch.column(1))
        seen: list[list[np.ndarray]] = [[], []]
        for i, j in K.slices(starts):
            feature, _, _, offsets = _features(data[starts[i]:starts[j]], starts[i:j + 1] - starts[i])
            for d in range(j - i):
                seen[int(toxic[i + d])].append(np.unique(feature[:, offsets[d]:offsets[d + 1]]))
        counts = [np.unique(np.concatenate(s), return_counts=True) if s else (np.zeros(0, K.U64), np.zeros(0, np.int64)) for s in seen]
        for k, (f, n) in enumerate(counts):
            zero = np.zeros(len(f), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(K.signed(f)), pa.array(zero if k else n), pa.array(n if k else zero)],
                                             names=["feature", "n0", "n1"])


class Model:
    """Lexicon (sorted fingerprints and log odds), chain weights and document logistic."""

    def __init__(self, features: np.ndarray, odds: np.ndarray, prior: float):
        order = np.argsort(features)
        self.features, self.odds = features[order], odds[order]
        self.prior = prior
        bins = len(BINS) + 1
        self.emission = np.zeros((3, bins))
        self.transition = np.zeros((2, 2))
        self.start = np.zeros(2)
        self.logistic: np.ndarray | None = None

    def weights(self, feature: np.ndarray) -> np.ndarray:
        """The greatest log odds among a word's features; 0 for none."""
        best = np.zeros(feature.shape[1])
        if len(self.features):
            for kind in feature:
                at = np.minimum(np.searchsorted(self.features, kind), len(self.features) - 1)
                best = np.maximum(best, np.where(self.features[at] == kind, self.odds[at], 0.0))
        return best

    def bins(self, weight: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bin of each word's own, previous and next weight (bin 0 beyond the text)."""
        own = np.searchsorted(BINS, weight, side="right")
        before, after = np.zeros_like(own), np.zeros_like(own)
        before[1:], after[:-1] = own[:-1], own[1:]
        first = offsets[:-1][offsets[:-1] < offsets[1:]]
        before[first] = 0
        after[first[1:] - 1] = 0
        return np.stack([own, before, after])

    def log_odds(self, bins: np.ndarray) -> np.ndarray:
        return self.emission[0][bins[0]] + self.emission[1][bins[1]] + self.emission[2][bins[2]]

    def tag(self, data: np.ndarray, starts: np.ndarray):
        """P(toxic) of every word, first and end bytes, word offsets. Words are weighed in
        slices; a long text is one chain all the same."""
        cuts = K.pieces(data, starts, IS_WORD_ANY_CASE)
        weights, offsets, edges = [np.zeros(0)], [np.zeros(1, np.int64)], [np.zeros((2, 0), np.int64)]
        for i, j in K.slices(cuts):
            feature, begin, end, own = _features(data[cuts[i]:cuts[j]], cuts[i:j + 1] - cuts[i])
            weights.append(self.weights(feature))
            offsets.append(own[1:] + offsets[-1][-1])
            edges.append(np.stack([begin, end]) + cuts[i])
        offsets = np.concatenate(offsets)[np.searchsorted(cuts, starts)]
        p = marginals(self.log_odds(self.bins(np.concatenate(weights), offsets)), self.transition, self.start, offsets)
        begin, end = np.concatenate(edges, axis=1)
        return p, begin, end, offsets

    def fit_chain(self, texts: list[str], toxic: np.ndarray, rounds: int = 40, rate: float = 0.25, ridge: float = 1e-3) -> None:
        """Gradient ascent on the likelihood of the labelled tokens."""
        data, starts = K.texts_of(pa.array(texts, pa.string()))
        feature, _, _, offsets = _features(data, starts)
        weight = self.weights(feature)
        bins = self.bins(weight, offsets)
        label = (weight >= LABEL_ODDS) & np.repeat(toxic.astype(bool), np.diff(offsets))
        n = max(len(label), 1)
        first = offsets[:-1][offsets[:-1] < offsets[1:]]
        inner = np.ones(len(label), bool)
        inner[first] = False
        at = np.flatnonzero(inner)
        seen_pairs = np.zeros((2, 2))
        np.add.at(seen_pairs, (label[at - 1].astype(int), label[at].astype(int)), 1)
        seen_start = np.bincount(label[first].astype(int), minlength=2)
        share = max(label.mean(), 1e-4)
        self.start = np.log([1 - share, share])
        values = [self.emission, self.transition, self.start]
        moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
        k = self.emission.shape[1]
        for r in range(1, rounds + 1):
            p, pairs, _ = marginals(self.log_odds(bins), self.transition, self.start, offsets, pairs=True)
            gap = label - p
            slopes = [np.stack([np.bincount(b, weights=gap, minlength=k) for b in bins]), seen_pairs - pairs,
                      seen_start - np.array([(1 - p[first]).sum(), p[first].sum()])]
            for v, g, (m1, m2) in zip(values, slopes, moments):
                g = g / n * 100 - ridge * v
                m1 += 0.1 * (g - m1)
                m2 += 0.01 * (g * g - m2)
                v += rate * (m1 / (1 - 0.9 ** r)) / (np.sqrt(m2 / (1 - 0.99 ** r)) + 1e-9)

    def fit_logistic(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """Weighted ridge logistic by Newton's method."""
        x = np.column_stack([np.ones(len(x)), x])
        b = np.zeros(x.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
            h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(b))
            b += np.clip(np.linalg.solve(h, x.T @ (weight * (y - p)) - 1e-2 * b), -5, 5)
        self.logistic = b

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.logistic is None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.logistic[0] + x @ self.logistic[1:], -30, 30)))


def _document_features(p: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Of each text: log of the expected number of toxic words, the greatest marginal, and
    their share."""
    n = np.diff(offsets)
    owner = np.repeat(np.arange(len(n)), n)
    total = np.bincount(owner, weights=p, minlength=len(n))
    most = np.zeros(len(n))
    np.maximum.at(most, owner, p)
    return np.column_stack([np.log1p(total), most, 10 * total / np.maximum(n, 1)])


def _sample_features(model: Model):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in K.groups(batch, BYTES_AT_ONCE)):
            data, starts = K.texts_of(part.column(1))
            p, _, _, offsets = model.tag(data, starts)
            x = _document_features(p, offsets)
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x[:, c]) for c in range(x.shape[1]))],
                                             names=["toxic", "a", "b", "c"])

    return task


def fit(labelled: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """``labelled``: (id, toxic) of the rows one may learn from."""
    labels = (labelled.where(f"{id_col} is not null and toxic is not null").groupBy(id_col)
              .agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where("toxic in (0, 1)"))
    sizes = {r.toxic: r.n for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    known = sum(sizes.values())
    if min(sizes.get(0, 0), sizes.get(1, 0)) == 0:
        return Model(np.zeros(0, K.U64), np.zeros(0), sizes.get(1, 0) / known if known else 0.0)
    chosen = [labels.where(F.col("toxic") == c).orderBy(F.xxhash64(id_col), id_col).limit(SAMPLE) for c in (0, 1)]
    # at most 2 * SAMPLE rows of two numbers
    sample = stored(docs.select(id_col, F.col(text_col).cast("string").alias("text")).where("text is not null")
                    .join(F.broadcast(chosen[0].unionByName(chosen[1])), id_col).select(id_col, "toxic", "text"), "toxic-sample")
    rows = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = rows.get(0, 0), rows.get(1, 0)
    counts = (sample.select("toxic", "text").mapInArrow(_count_features, "feature long, n0 long, n1 long")
              .groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))
    odds = F.log((F.col("n1") + 0.5) / (n1 + 1)) - F.log((F.col("n0") + 0.5) / (n0 + 1))
    lexicon = counts.where(F.col("n1") >= MIN_TOXIC_DOCS).withColumn("odds", odds).where(F.col("odds") >= LEXICON_ODDS).select("feature", "odds")
    found = lexicon.toPandas()  # of the bounded sample only
    model = Model(found["feature"].to_numpy(np.int64).view(K.U64), found["odds"].to_numpy(float), sizes[1] / known)
    few = [r for c in (0, 1) for r in sample.where(F.col("toxic") == c).orderBy(F.xxhash64(id_col), id_col).limit(CHAIN_DOCS).collect()]
    if n0 and n1:
        model.fit_chain([r.text for r in few], np.array([r.toxic for r in few]))
        x = sample.select("toxic", "text").mapInArrow(_sample_features(model), "toxic int, a double, b double, c double").toPandas()
        y = x["toxic"].to_numpy(float)
        model.fit_logistic(x[["a", "b", "c"]].to_numpy(float), y, np.where(y == 1, sizes[1] / n1, sizes[0] / n0))
    return model


def _tag(model: Model, with_spans: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in K.groups(whole, BYTES_AT_ONCE):
                data, starts = K.texts_of(batch.column(1))
                p, begin, end, offsets = model.tag(data, starts)
                score = model.score(_document_features(p, offsets))
                cols = [batch.column(0), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))]
                if with_spans:
                    spans: list[list] = [[] for _ in range(batch.num_rows)]
                    letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before a byte
                    for w in np.flatnonzero(p >= 0.5):
                        d = int(np.searchsorted(offsets, w, side="right")) - 1
                        spans[d].append({"start": int(letters[begin[w]] - letters[starts[d]]), "end": int(letters[end[w]] - letters[starts[d]])})
                    cols.append(pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "score", "predicted", "spans"][:len(cols)])

    return task


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", with_spans: bool = True) -> DataFrame:
    """doc_id, score, predicted and the offending spans (code points) of every row."""
    schema = "doc_id long, score double, predicted int" + (", spans array<struct<start:int,end:int>>" if with_spans else "")
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(_tag(model, with_spans), schema))


def held_out(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(labels.where(~held_out("doc_id")).select("doc_id", "toxic"), docs)
    out = score(docs, model)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", "spans")
