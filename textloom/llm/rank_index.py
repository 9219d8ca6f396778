"""A piecewise-linear learned index from token ranks to text offsets.

A text has n tokens and n + 1 boundaries. Straight segments are fitted to the points (rank, offset)
one after the other, each as long as it stays within ``ERROR`` code points of all of its points; what
remains at every boundary is stored as a small residual. A lookup finds the segment by its first rank,
predicts, and corrects by the residual, which makes it exact.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Code points by which a segment may miss a boundary. Residuals then fit one signed byte.
ERROR = 24
#: Points that are tested at a time while a segment grows.
_STEP = 256

# fixed values: the characters of [\x20\x09-\x0D]
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True


def blank(cps: np.ndarray) -> np.ndarray:
    """Which code points are blanks."""
    return BLANK[np.minimum(cps, 255)]


def boundaries(cps: np.ndarray) -> np.ndarray:
    """0 and the end of every token: blanks and the word after them, or blanks at the end of the text."""
    gap = blank(cps)
    ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    return np.concatenate(([0], ends, [len(cps)] if len(cps) else [])).astype(np.int64)


class RankIndex(NamedTuple):
    ranks: np.ndarray  # first rank of each segment
    offsets: np.ndarray  # offset at it
    slopes: np.ndarray
    residuals: np.ndarray  # one per boundary

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.ranks, ranks, "right") - 1
        return np.rint(self.offsets[at] + self.slopes[at] * (ranks - self.ranks[at])).astype(np.int64)

    def lookup(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets of some ranks."""
        return self.predict(ranks) + self.residuals[ranks]


def fit(ends: np.ndarray, error: int = ERROR) -> RankIndex:
    """Segments within ``error`` of all boundaries, and the residuals.

    A segment passes through its first point. The slopes that keep a further point within the error
    form an interval; the segment ends before the point at which no slope is left for all.
    """
    ranks, slopes = [], []
    start, n = 0, len(ends)
    while start < n:
        low, high, at = -np.inf, np.inf, start + 1
        while at < n:
            stop = min(at + _STEP, n)
            run = np.arange(at, stop) - start
            rise = ends[at:stop] - ends[start]
            lows = np.maximum.accumulate(np.maximum((rise - error) / run, low))
            highs = np.minimum.accumulate(np.minimum((rise + error) / run, high))
            broken = np.flatnonzero(lows > highs)
            kept = int(broken[0]) if len(broken) else stop - at
            if kept:
                low, high = float(lows[kept - 1]), float(highs[kept - 1])
            at += kept
            if len(broken):
                break
        ranks.append(start)
        slopes.append((low + high) / 2 if at > start + 1 else 0.0)
        start = at
    first = np.array(ranks, np.int64)
    index = RankIndex(first, ends[first], np.array(slopes), np.zeros(n, np.int64))
    rest = ends - index.predict(np.arange(n))
    small = np.int8 if error < 127 else np.int64
    return index._replace(residuals=rest.astype(small))
