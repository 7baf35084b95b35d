"""Long texts: worked on in pieces with equal results, and in memory that follows bytes, not rows."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from changelake.llm import kernels as K
from changelake.llm import language_id, toxicity

WORDS = "the haus and schöne день мир of Grün river Übung light ночь 12 end".split()


def text(seed, n):
    rnd = random.Random(seed)
    return "".join(rnd.choice(WORDS) + rnd.choice([" ", ", ", "\n", "--"]) for _ in range(n))


def language_model():
    counts = {}
    for lang, sample in (("de", "das schöne Haus Grün Übung und"), ("en", "the river of light and the end"), ("ru", "день мир ночь")):
        data, starts = K.texts_of(pa.array([sample]))
        begin, end, script, _, bucket = language_id._words(data, starts)
        for b in [*bucket[language_id._in_words(begin, end, len(bucket))], *(script.astype(int) + language_id.BUCKETS)]:
            counts[lang, int(b)] = counts.get((lang, int(b)), 0) + 1
    return language_id.Model([(lang, b, n) for (lang, b), n in counts.items()])


def toxic_model():
    data, starts = K.texts_of(pa.array(WORDS))
    feature, *_ = toxicity._features(data, starts)
    model = toxicity.Model(np.unique(feature[0])[:6], np.linspace(1, 4, 6), 0.1)
    model.emission += np.linspace(-2, 2, model.emission.shape[1])
    return model


def texts(batch_texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(batch_texts))), pa.array(batch_texts, pa.string())], names=["k", "text"])


def test_pieces_lie_between_words(monkeypatch):
    parts = [text(n, 40 * n) for n in range(6)] + ["", "x" * 9000, None, "a " * 4000]
    data, starts = K.texts_of(pa.array(parts, pa.string()))
    cuts = K.pieces(data, starts, toxicity.IS_WORD_ANY_CASE, 500)
    assert set(starts) <= set(cuts) and (np.diff(cuts) > 0).all() and len(cuts) > len(starts)
    inner = np.setdiff1d(cuts, starts)
    assert not toxicity.IS_WORD_ANY_CASE[data[inner]].any()
    whole, cut = (K.words_of(data, s, toxicity.IS_WORD_ANY_CASE) for s in (starts, cuts))
    assert all((a == b).all() for a, b in zip(whole[:3], cut[:3]))
    assert (cut[3][np.searchsorted(cuts, starts)] == whole[3]).all()


@pytest.mark.parametrize("most", [64, 700])
def test_pieces_change_no_result(monkeypatch, most):
    batch = texts([text(1, 900), "", None, text(2, 30), "wort" * 300, text(3, 2000), "12 ."])
    models = language_model(), toxic_model()

    def results():
        data, starts = K.texts_of(batch.column(1))
        return language_id._detect_rows(models[0], 12.0, True, batch).to_pylist(), [a.tolist() for a in models[1].tag(data, starts)]

    want = results()
    real = K.pieces
    monkeypatch.setattr(K, "pieces", lambda data, starts, is_word: real(data, starts, is_word, most))
    plain = K.slices
    monkeypatch.setattr(K, "slices", lambda starts: plain(starts, most))
    got = results()
    assert [{**r, "score": round(r["score"], 6)} for r in got[0]] == [{**r, "score": round(r["score"], 6)} for r in want[0]]
    assert got[1][1:] == want[1][1:] and np.allclose(got[1][0], want[1][0])


@pytest.mark.parametrize("size", [2_000, 30_000])
def test_peak_memory_follows_bytes(size):
    one = text(7, size // 6)
    batch = texts([one] * (12_000_000 // len(one.encode())))
    language, toxic = language_model(), toxic_model()
    for task in (language_id._detect(language, 12.0, True), toxicity._tag(toxic, True)):
        tracemalloc.start()
        rows = sum(out.num_rows for out in task(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows == batch.num_rows and peak < 500_000_000, (size, peak)
