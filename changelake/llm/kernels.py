"""Vectorised helpers used inside Arrow tasks: text bytes, fingerprints, sampled runs.

A text is handled as its UTF-8 bytes. Texts of one Arrow batch are cut into slices of at
most ``SLICE`` bytes (one longer text is a slice of its own), so working memory is bounded
by the slice, not by the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE = 1 << 20
_MULTIPLIER = 0xD1342543DE82EF95
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def splitmix(n: int, seed: int) -> np.ndarray:
    """``n`` well mixed 64-bit constants."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BYTE_CODE = splitmix(256, 7)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(str(base))
    if have is None or len(have) < n:
        v = np.full(max(n, SLICE + 1), U64(base), dtype=U64)
        v[0] = 1
        have = _powers[str(base)] = np.multiply.accumulate(v)
    return have[:n]


class Fingerprints:
    """Fingerprints of any stretch of a symbol sequence in constant time each."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        self.sums = np.zeros(self.n + 1, dtype=U64)
        np.cumsum(symbols * _power(_MULTIPLIER, self.n), out=self.sums[1:])
        self.inverse = _power(_INVERSE, self.n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def grams(self, k: int) -> np.ndarray:
        m = self.n - k + 1
        return mix((self.sums[k:] - self.sums[:m]) * self.inverse[:m])


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0]:ends[-1]], ends - ends[0]


def slices(starts: np.ndarray, most: int = SLICE - 1) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes together; one longer text stands alone."""
    i, n = 0, len(starts) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + most, side="right")) - 1)
        yield i, j
        i = j


def groups(batch: pa.RecordBatch, most: int, column: int = 1) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have at most ``most`` bytes together; one longer text stands
    alone."""
    _, starts = texts_of(batch.column(column))
    for i, j in slices(starts, most):
        yield batch.slice(i, j - i)


def pieces(data: np.ndarray, starts: np.ndarray, is_word: np.ndarray, most: int = SLICE - 1) -> np.ndarray:
    """The offsets of the texts, and places in texts of over ``most`` bytes where no word stands,
    so that a long text is worked on in pieces. Only a longer word is a longer piece."""
    cuts = []
    for t in np.flatnonzero(np.diff(starts) > most):
        at, end = int(starts[t]) + most, int(starts[t + 1])
        while at < end:
            gap = np.flatnonzero(~is_word[data[at:at + 4096]])
            if len(gap):
                cuts.append(at + int(gap[0]))
                at = cuts[-1] + most
            else:
                at += 4096
    cuts = np.array([c for c in cuts if c < starts[-1]], np.int64)
    return np.unique(np.concatenate([starts, cuts]))


def words_of(data: np.ndarray, starts: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, ...]:
    """Fingerprint, first byte and end byte of every word, and the word offsets of the texts.

    ``is_word`` says for each byte value whether it belongs to a word. All separators are
    ASCII, so cutting bytes is cutting code points. No word crosses a text.
    """
    inside = is_word[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    heads = starts[:-1][starts[:-1] < starts[1:]]
    tails = starts[1:][starts[:-1] < starts[1:]] - 1
    first[heads], last[tails] = inside[heads], inside[tails]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    prints = Fingerprints(BYTE_CODE[data]).of(begin, end)
    return prints, begin, end, np.searchsorted(begin, starts)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, U64(0xFFFFFFFFFFFFFFFF))
    padded[:len(x)] = x
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(x) - width + 1
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def sampled_runs(symbols: np.ndarray, starts: np.ndarray, window: int, gram: int):
    """Sampled positions of every text and the windows each stands for.

    Every stretch of ``window`` symbols picks its ``gram``-symbol piece of least fingerprint
    (the leftmost of equals). The pick depends on the stretch alone, so equal stretches pick
    equal pieces at the same offset. A run is a range of consecutive window starts that pick
    the same piece. Returns (text index, first start, last start, piece, fingerprints, gram
    fingerprints); sequences over ``SLICE`` symbols are cut into overlapping parts, which may
    split a run but changes no pick.
    """
    prints = Fingerprints(symbols)
    out = [np.zeros(0, np.int64)] * 4
    if len(symbols) < window:
        return (*out, prints, np.zeros(0, U64))
    grams = prints.grams(gram)
    width, limit = window - gram + 1, SLICE
    mask = U64(limit - 1)
    picks = []
    for at in range(0, len(grams) - width + 1, limit - width):
        part = grams[at:at + limit]
        ranked = (part & ~mask) | np.arange(len(part), dtype=U64)
        picks.append((_sliding_min(ranked, width) & mask).astype(np.int64)[:limit - width] + at)
    pick = np.concatenate(picks)
    lengths = np.diff(starts)
    fits = lengths >= window
    change = np.zeros(len(pick) + 1, np.int8)
    change[starts[:-1][fits]] += 1
    np.subtract.at(change, starts[:-1][fits] + lengths[fits] - window + 1, 1)
    at = np.flatnonzero(np.cumsum(change[:-1]))
    if not len(at):
        return (*out, prints, grams)
    chosen = pick[at]
    text = np.searchsorted(starts, at, side="right") - 1
    cut = np.flatnonzero((np.diff(chosen) != 0) | (np.diff(at) != 1) | (np.diff(text) != 0)) + 1
    heads = np.concatenate([[0], cut])
    tails = np.concatenate([cut - 1, [len(at) - 1]])
    return text[heads], at[heads], at[tails], chosen[heads], prints, grams


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Boolean mask of length ``n``: true inside any [start, end), which lie within 0 to ``n``."""
    if len(starts) and (starts.min() < 0 or ends.max() > n):
        raise ValueError(f"spans beyond a text of {n}")
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.subtract.at(change, ends, 1)
    return np.cumsum(change[:-1]) > 0


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def expand(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges [first, first + count): the members, and the index of each one's range."""
    owner = np.repeat(np.arange(len(first)), count)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return first[owner] + within, owner
