"""Forward and backward recursions over many sequences at once.

Sequences are sorted by length and laid out by time: all first steps, then
all second steps and so on. A recursion is then a few numpy calls for each
time step, over all sequences that are still running.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .common import ragged

GROUP = 250_000      # steps that are worked on together


def groups(count: np.ndarray, most: int = GROUP) -> Iterator[np.ndarray]:
    """Sequence numbers, longest first, in groups of about ``most`` steps in
    all (a longer sequence is a group of its own). Sequences without steps
    are left out."""
    order = np.argsort(-count, kind="stable")
    order = order[count[order] > 0]
    total = np.cumsum(count[order])
    at = 0
    while at < len(order):
        done = total[at - 1] if at else 0
        to = max(int(np.searchsorted(total, done + most, side="right")), at + 1)
        yield order[at:to]
        at = to


class Layout:
    """Places by time of the steps of sequences (longest first) that lie
    one after another in a flat array."""

    def __init__(self, first: np.ndarray, count: np.ndarray):
        longest = int(count[0])
        self.active = len(count) - np.cumsum(np.bincount(count, minlength=longest + 1))[:longest]
        self.begin = np.concatenate(([0], np.cumsum(self.active)))
        rank = np.repeat(np.arange(len(count)), count)
        time = ragged(np.zeros(len(count), np.int64), count)
        self.source = np.empty(len(rank), np.int64)          # of the step at each place
        self.source[self.begin[time] + rank] = ragged(first, count)
        self.rank = np.empty(len(rank), np.int64)            # its sequence
        self.rank[self.begin[time] + rank] = rank


def forward(start: np.ndarray, step: np.ndarray, fit: np.ndarray, lay: Layout, every: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward weights and the scales; the logarithms of a sequence's
    scales sum to that of its total weight. ``fit``: steps × states. Weights
    are scaled at each ``every``-th step and at a sequence's last one, so the
    product of that many fits must be far from underflow."""
    alpha, scale, ones = np.empty_like(fit), np.ones(len(fit)), np.ones(fit.shape[1])
    begin = lay.begin.tolist()
    last = len(begin) - 2
    for t in range(last + 1):
        a, b = begin[t], begin[t + 1]
        now = alpha[a:b]
        if t:
            np.matmul(alpha[before:before + b - a], step, out=now)
            now *= fit[a:b]
        else:
            np.multiply(fit[a:b], start, out=now)
        # sequences that go on come first
        due = a if t == last or t % every == every - 1 else a + begin[t + 2] - b
        if due < b:
            np.matmul(alpha[due:b], ones, out=scale[due:b])
            alpha[due:b] /= scale[due:b, None]
        before = a
    return alpha, scale


def backward_and_ahead(step: np.ndarray, fit: np.ndarray, scale: np.ndarray, lay: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Backward weights, scaled so that alpha * beta are the marginals; and
    for each step but the first of a sequence fit * beta / scale."""
    beta, ahead = np.ones_like(fit), fit / scale[:, None]
    back = step.T.copy()
    begin = lay.begin.tolist()
    for t in range(len(begin) - 3, -1, -1):
        a, m, b = begin[t], begin[t + 1], begin[t + 2]
        now = ahead[m:b]
        now *= beta[m:b]
        np.matmul(now, back, out=beta[a:a + b - m])
    return beta, ahead


def backward(step: np.ndarray, fit: np.ndarray, scale: np.ndarray, lay: Layout) -> np.ndarray:
    """Backward weights, scaled so that alpha * beta are the marginals."""
    return backward_and_ahead(step, fit, scale, lay)[0]


def moves(alpha: np.ndarray, ahead: np.ndarray, step: np.ndarray, lay: Layout) -> np.ndarray:
    """Expected number of each transition, states × states."""
    if len(lay.begin) < 3:
        return np.zeros_like(step)
    # a place's predecessor: the same sequence one time step earlier
    size = lay.active[1:]
    return step * (alpha.take(ragged(lay.begin[:len(size)], size), axis=0).T @ ahead[lay.begin[1]:])


def pairs(alpha: np.ndarray, beta: np.ndarray, step: np.ndarray, fit: np.ndarray, scale: np.ndarray, lay: Layout) -> np.ndarray:
    """Expected number of each transition, from the backward weights."""
    return moves(alpha, fit * beta / scale[:, None], step, lay)
