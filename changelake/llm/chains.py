"""Dynamic programs over many sequences at once: one step handles the next element of every
sequence that is long enough, so a batch costs as many steps as its longest sequence has."""

from __future__ import annotations

import numpy as np


class Layout:
    """Sequences of a flat array, given by offsets, in falling order of length."""

    def __init__(self, offsets: np.ndarray):
        lengths = np.diff(offsets)
        self.order = np.argsort(-lengths, kind="stable")
        self.first = offsets[:-1][self.order]
        self.lengths = lengths[self.order]
        self.steps = int(self.lengths[0]) if len(lengths) else 0
        #: how many sequences have an element at step t
        self.active = np.searchsorted(-self.lengths, -np.arange(self.steps), side="left")

    def at(self, t: int) -> np.ndarray:
        return self.first[:self.active[t]] + t


def best_path(scores: np.ndarray, offsets: np.ndarray, penalty: float) -> np.ndarray:
    """Viterbi labels of every element: the path of greatest sum of ``scores`` (elements x
    labels) less ``penalty`` for each change of label. The lower label wins ties."""
    layout = Layout(offsets)
    n, k = scores.shape
    kind = np.min_scalar_type(max(k - 1, 0))
    labels = np.zeros(n, kind)
    if not n:
        return labels
    stay = np.zeros((n, k), bool)
    other = np.zeros(n, kind)
    value = np.zeros((len(layout.first), k), np.float32)
    for t in range(layout.steps):
        at = layout.at(t)
        v = value[:len(at)]
        if t:
            best = v.argmax(axis=1)
            jump = v[np.arange(len(at)), best][:, None] - np.float32(penalty)
            stay[at] = v >= jump
            other[at] = best
            v = np.maximum(v, jump)
        value[:len(at)] = v + scores[at]
    state = value.argmax(axis=1)
    for t in range(layout.steps - 1, -1, -1):
        at = layout.at(t)
        s = state[:len(at)]
        labels[at] = s
        if t:
            state[:len(at)] = np.where(stay[at, s], s, other[at])
    return labels


def marginals(emission: np.ndarray, transition: np.ndarray, start: np.ndarray, offsets: np.ndarray,
              pairs: bool = False):
    """Forward-backward of a two-label chain. ``emission``: log weight of label 1 against
    label 0 for each element. Returns P(label 1), and with ``pairs`` also the expected counts
    of label pairs and the sum of log normalisers."""
    layout = Layout(offsets)
    n = len(emission)
    odds = np.exp(np.clip(emission, -30, 30)).astype(np.float64)
    m, a0 = np.exp(transition), np.exp(start)
    forward = np.zeros((n, 2))
    log_z = 0.0
    f = np.zeros((len(layout.first), 2))
    for t in range(layout.steps):
        at = layout.at(t)
        prior = np.broadcast_to(a0, (len(at), 2)) if not t else f[:len(at)] @ m
        zero, one = prior[:, 0], prior[:, 1] * odds[at]
        total = zero + one
        log_z += np.log(total).sum()
        f[:len(at), 0], f[:len(at), 1] = zero / total, one / total
        forward[at] = f[:len(at)]
    back = np.ones((len(layout.first), 2))
    p = np.zeros(n)
    counts = np.zeros((2, 2))
    for t in range(layout.steps - 1, -1, -1):
        at = layout.at(t)
        b = back[:len(at)]
        both = forward[at] * b
        both /= both.sum(axis=1, keepdims=True)
        p[at] = both[:, 1]
        if t:
            weighted = np.stack([b[:, 0], b[:, 1] * odds[at]], axis=1)
            if pairs:
                joint = forward[at - 1][:, :, None] * m[None] * weighted[:, None, :]
                counts += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            nxt = weighted @ m.T
            back[:len(at)] = nxt / nxt.sum(axis=1, keepdims=True)
    return (p, counts, log_z) if pairs else p
