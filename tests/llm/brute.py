"""Plain single-machine versions that the operators are held against."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def suffix_dedup(rows, length=200):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[p:p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((d, len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)))
    return out


def substring_dedup(rows, window=50):
    words = [WORD.findall(t or "") for _, t in rows]
    order = [float("inf") if d is None else d for d, _ in rows]
    first: dict = defaultdict(lambda: float("inf"))
    for d, w in zip(order, words):
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            first[k] = min(first[k], d)
    out = []
    for (d, _), o, w in zip(rows, order, words):
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < o:
                gone[p:p + window] = [True] * window
        out.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


LOWERED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_az(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def license_scan(rows, templates, phrases, containment=0.8, block=128):
    out = []
    for d, t in rows:
        words = LOWERED.findall(lower_az(t))
        places = [(k, p) for k in phrases for n in [k.split()] for p in range(len(words)) if words[p:p + len(n)] == n]
        base = {phrases[k] for k, _ in places}
        labels, score = set(base), float(bool(places))
        for p in range(0, max(len(words), 1), block // 2):
            part = set(words[p:p + block])
            for label, text in templates.items():
                need = set(LOWERED.findall(lower_az(text)))
                share = len(part & need) / len(need)
                if share >= containment - 1e-12:
                    labels.add(label)
                    score = max(score, share)
        at = [p for _, p in places]
        out.append((d, len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
                    ",".join(sorted(labels)), score))
    return out


def quality(rows):
    out = []
    for d, t in rows:
        t = t or ""
        words = WORD.findall(t)
        grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        seen = Counter(grams)
        inside = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        n, r = len(words), len(inside)
        out.append((d, n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), r,
                    n < 10 or 100 * r > 20 * n))
    return out


def near_dedup(rows, shingle=2, similarity=80):
    sets = []
    for d, t in rows:
        w = WORD.findall(lower_az(t))
        sets.append({tuple(w[i:i + shingle]) for i in range(len(w) - shingle + 1)} if len(w) >= shingle else ({tuple(w)} if w else set()))
    parent = {d: d for d, _ in rows}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    holders = defaultdict(list)
    for k, s in enumerate(sets):
        shared = Counter(o for g in s for o in holders[g])
        for o, n in shared.items():
            if 100 * n >= similarity * (len(s) + len(sets[o]) - n):
                a, b = root(rows[k][0]), root(rows[o][0])
                parent[max(a, b)] = min(a, b)
        for g in s:
            holders[g].append(k)
    return [(d, len(s), root(d), root(d) == d) for (d, _), s in zip(rows, sets)]
