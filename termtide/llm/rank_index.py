"""A learned rank index over increasing numbers: piecewise linear with stored residuals.

Rank k of an increasing sequence is predicted by the line of the segment that k falls
into; every prediction is at most ``bound`` off, and what it is off is stored in one
byte, so that the answer is exact. Segments are found for many sequences at once: each
starts as one segment through its first and last point, and whichever is off by more
than the bound is halved, until none is.
"""

from __future__ import annotations

import numpy as np

BOUND = 127


class RankIndex:
    """Segments (first rank, value there, slope) and one residual for each rank."""

    def __init__(self, firsts: np.ndarray, bases: np.ndarray, slopes: np.ndarray, residuals: np.ndarray):
        self.firsts, self.bases, self.slopes, self.residuals = firsts, bases, slopes, residuals

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        """What the segments say, at most the bound away from the truth."""
        at = np.searchsorted(self.firsts, ranks, side="right") - 1
        return self.bases[at] + np.rint(self.slopes[at] * (ranks - self.firsts[at])).astype(np.int64)

    def values(self, ranks: np.ndarray) -> np.ndarray:
        """The exact numbers at these ranks."""
        return self.predict(ranks) + self.residuals[ranks]


def fit(values: np.ndarray, starts: np.ndarray, bound: int = BOUND) -> RankIndex:
    """Index of ``values``, in which sequences begin at ``starts`` (the first at 0); no segment goes over such a start."""
    if not 0 <= bound <= BOUND:
        raise ValueError(f"bound must be 0 to {BOUND}: a residual is one byte")
    total = len(values)
    residuals = np.zeros(total, np.int8)
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    begins, ends = starts.astype(np.int64), np.append(starts[1:], total).astype(np.int64)
    begins, ends = begins[ends > begins], ends[ends > begins]
    while len(begins):
        steps = ends - begins - 1
        bases = values[begins]
        slopes = (values[ends - 1] - bases) / np.maximum(steps, 1)
        sizes = ends - begins
        edges = np.cumsum(sizes) - sizes
        ranks = np.arange(int(sizes.sum())) - np.repeat(edges - begins, sizes)
        off = values[ranks] - np.repeat(bases, sizes) - np.rint(np.repeat(slopes, sizes) * (ranks - np.repeat(begins, sizes))).astype(np.int64)
        good = np.maximum.reduceat(np.abs(off), edges) <= bound
        done.append((begins[good], bases[good], slopes[good]))
        inside = np.repeat(good, sizes)
        residuals[ranks[inside]] = off[inside]
        begins, ends = begins[~good], ends[~good]
        middles = (begins + ends) // 2
        begins, ends = np.concatenate([begins, middles]), np.concatenate([middles, ends])
    if not done:
        return RankIndex(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), residuals)
    firsts, bases, slopes = (np.concatenate([d[i] for d in done]) for i in range(3))
    order = np.argsort(firsts)
    return RankIndex(firsts[order], bases[order], slopes[order], residuals)
