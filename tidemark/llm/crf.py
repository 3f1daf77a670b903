"""A linear-chain conditional random field with the states 0 and 1, over many chains at once.

A position t has the score e[t] for state 1 against state 0, two neighbours the score
trans[i, j]. Forward and backward messages are kept as the logarithm of their ratio. All
chains advance together, one position a step.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def _forgotten(trans: np.ndarray, error: float = 1e-18) -> int:
    """Steps after which a message no longer depends on where it began.

    A step brings two messages closer by tanh(|t00 + t11 - t01 - t10| / 4) at least (Birkhoff's theorem).
    """
    rate = np.tanh(abs(trans[0, 0] + trans[1, 1] - trans[0, 1] - trans[1, 0]) / 4)
    return 8 if rate < 1e-2 else int(np.ceil(np.log(error) / np.log(min(rate, 1 - 1e-9))))


def _segments(first: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chains cut into segments: start, end, and the chain of each."""
    lengths = np.diff(first)
    parts = -(-lengths // longest)
    chain = np.repeat(np.arange(len(lengths)), parts)
    number = np.arange(len(chain)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = first[:-1][chain] + number * longest
    return start, np.minimum(start + longest, first[1:][chain]), chain


def messages(e: np.ndarray, first: np.ndarray, trans: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray]:
    """Log ratios of the forward and the backward messages at each position.

    ``first`` has the start of each chain and the end of the last; chains may be empty. Long chains are
    cut, and each segment is begun so far outside that its messages are those of the whole chain.
    """
    x = np.exp(trans)
    before = _forgotten(trans)
    lo, hi, chain = _segments(first, max(512, before))
    begin = np.maximum(first[:-1][chain], lo - before)
    end = np.minimum(first[1:][chain], hi + before)
    forward, backward = np.zeros(len(e)), np.zeros(len(e))

    def run(origin: np.ndarray, length: np.ndarray, sign: int, out: np.ndarray, step) -> None:
        order = np.argsort(-length, kind="stable")
        origin, low, high, length = origin[order], lo[order], hi[order], length[order]
        reach = len(length) - np.searchsorted(length[::-1], np.arange(1, (length[0] if len(length) else 0) + 1))
        held = np.zeros(len(length))
        for t, k in enumerate(reach):
            at = origin[:k] + sign * t
            held = step(at, held[:k], t)
            own = (at >= low[:k]) & (at < high[:k])
            out[at[own]] = held[own]

    def ahead(at, held, t):
        if t == 0:
            return start + e[at]
        r = np.exp(np.clip(held, -60, 60))
        return e[at] + np.log((x[0, 1] + x[1, 1] * r) / (x[0, 0] + x[1, 0] * r))

    def back(at, held, t):
        if t == 0:
            return np.zeros(len(at))
        r = np.exp(np.clip(held + e[at + 1], -60, 60))
        return np.log((x[1, 0] + x[1, 1] * r) / (x[0, 0] + x[0, 1] * r))

    run(begin, hi - begin, 1, forward, ahead)
    run(end - 1, end - lo, -1, backward, back)
    return forward, backward


def marginals(e: np.ndarray, first: np.ndarray, trans: np.ndarray, start: float) -> np.ndarray:
    """The probability of state 1 at each position, given its whole chain."""
    forward, backward = messages(e, first, trans, start)
    return 1 / (1 + np.exp(-np.clip(forward + backward, -40, 40)))


@dataclass
class Crf:
    """Weights of hashed features (one table for each kind), of dense features, and of transitions."""

    tables: list[np.ndarray]
    dense: np.ndarray
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: float = 0.0

    def scores(self, ids: list[np.ndarray], dense: np.ndarray) -> np.ndarray:
        total = dense @ self.dense
        for table, i in zip(self.tables, ids, strict=True):
            total = total + table[i]
        return total

    def marginals(self, ids: list[np.ndarray], dense: np.ndarray, first: np.ndarray) -> np.ndarray:
        return marginals(self.scores(ids, dense), first, self.trans, self.start)


def fit(
    ids: list[np.ndarray], dense: np.ndarray, first: np.ndarray, y: np.ndarray, width: int, weights: np.ndarray,
    steps: int = 40, rate: float = 0.5, ridge: float = 1e-6, model: Crf | None = None, chained: bool = True,
    keep: float = 1.0, together: int = 0,
) -> Crf:
    """Maximise the likelihood of the labels ``y`` by adaptive gradient steps over all chains.

    The gradient of a feature is its expected count under the model (forward-backward)
    less its count in the labels. ``weights`` is the weight of each position. Without ``chained``
    the transitions stay as they are. With ``keep`` below 1 each hashed feature is left out at random in each
    step, so that none relies on the others. The first ``together`` are also left out all at once in half of the
    positions, so that the later ones do without them.
    """
    model = model or Crf([np.zeros(width) for _ in ids], np.zeros(dense.shape[1]))
    n = max(1.0, weights.sum())
    sums = [np.full(width, 1e-8) for _ in ids]
    dense_sum, trans_sum, start_sum = np.full(dense.shape[1], 1e-8), np.full((2, 2), 1e-8), 1e-8
    heads = first[:-1][np.diff(first) > 0]
    inner = np.ones(len(y), bool)
    inner[heads] = False
    right = np.flatnonzero(inner)  # positions with a left neighbour
    left = right - 1
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[left], y[right]), weights[right])
    rng = np.random.default_rng(1)
    masks = [1.0] * len(ids)
    for _ in range(steps):
        if keep < 1:
            masks = [(rng.random(len(y), np.float32) < keep) / keep for _ in ids]
            some = rng.random(len(y), np.float32) < 0.5 if together else 1.0
            masks = [m * some if k < together else m for k, m in enumerate(masks)]
        e = dense @ model.dense
        for table, i, mask in zip(model.tables, ids, masks, strict=True):
            e = e + table[i] * mask
        forward, backward = messages(e, first, model.trans, model.start)
        p = 1 / (1 + np.exp(-np.clip(forward + backward, -40, 40)))
        off = weights * (p - y) / n
        later = np.clip(e[right] + backward[right], -60, 60)
        f = np.clip(forward[left], -60, 60)
        joint = np.stack([
            np.full(len(right), model.trans[0, 0]), model.trans[0, 1] + later,
            model.trans[1, 0] + f, model.trans[1, 1] + f + later])
        joint = np.exp(joint - joint.max(0))
        joint /= joint.sum(0)
        if chained:
            g = ((joint * weights[right]).sum(1).reshape(2, 2) - seen) / n + 1e-3 * model.trans
            trans_sum += g * g
            model.trans = model.trans - rate * g / np.sqrt(trans_sum)
        g = off[heads].sum()
        start_sum += g * g
        model.start -= rate * g / np.sqrt(start_sum)
        g = dense.T @ off + ridge * model.dense
        dense_sum += g * g
        model.dense = model.dense - rate * g / np.sqrt(dense_sum)
        for k, i in enumerate(ids):
            g = np.bincount(i, off * masks[k], width) + ridge * model.tables[k]
            sums[k] += g * g
            model.tables[k] = model.tables[k] - rate * g / np.sqrt(sums[k])
    return model
