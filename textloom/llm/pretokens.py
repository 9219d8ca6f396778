"""Splits texts into the matches of the public byte-level BPE pattern, a chunk at a time.

The pattern cuts a text into contractions, letters, numbers and other signs (each with one blank
before it) and white space. It covers every character, so the split is a set of start positions,
found here from the runs of one character class.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np

from textloom.llm.text import LETTER, SPACE, Chunk

_LONG = 32


def match_starts(chunk: Chunk) -> np.ndarray:
    """Code point positions where the pattern's matches begin."""
    cps, n = chunk.cps, len(chunk.cps)
    if not n:
        return np.empty(0, np.int64)
    starts, ends = chunk.runs(chunk.kinds)
    kinds = chunk.kinds[starts]
    first = np.zeros(n + 1, bool)
    first[chunk.starts[chunk.starts < n]] = True
    first[n] = True
    last_of_text = first[ends]
    mark = np.zeros(n + 1, bool)
    mark[starts] = True
    space = (kinds == SPACE) & ~last_of_text
    tail = ends[space] - 1
    mark[tail] = True
    # a blank before another run joins it
    blank = cps[tail] == 32
    joined = tail[blank] + 1
    mark[joined] = False
    # contractions: a lone apostrophe at a match start before certain letters
    lone = np.flatnonzero((cps[starts] == 39) & (ends - starts == 1) & ~last_of_text & mark[starts])
    if len(lone):
        lone = lone[(lone + 1 < len(starts))]
        lone = lone[kinds[lone + 1] == LETTER]
        at, stop = starts[lone + 1], ends[lone + 1]
        padded = np.append(cps, 0)
        a, b = padded[at], np.where(at + 1 < stop, padded[np.minimum(at + 1, n)], 0)
        code = lambda x: np.uint32(ord(x))
        one = np.isin(a, [code(x) for x in "stmd"])
        two = ((a == code("r")) & (b == code("e"))) | ((a == code("v")) & (b == code("e"))) | ((a == code("l")) & (b == code("l")))
        taken = np.where(one, 1, np.where(two, 2, 0))
        hit = taken > 0
        mark[at[hit]] = False
        mark[(at + taken)[hit]] = True  # at the end of the letters a match begins anyway
    return np.flatnonzero(mark[:n])


class Matches:
    """The matches of a chunk as an index into its distinct ones.

    ``distinct`` lists the byte strings, which lie at ``starts`` of ``data`` with their ``sizes``;
    ``index`` gives one entry per match in order and ``firsts`` the first match of each text, with
    the total at its end.
    """

    def __init__(self, texts: list[str]):
        chunk = Chunk(texts)
        at = match_starts(chunk)
        self.firsts = np.concatenate((np.searchsorted(at, chunk.starts), [len(at)])).astype(np.int64)
        offsets = chunk.byte_offsets()
        self.data = chunk.joined.encode("utf-8")
        starts = offsets[at]
        sizes = np.append(starts[1:], len(self.data)) - starts
        self.index, where = _distinct(self.data, starts, sizes)
        self.starts, self.sizes = starts[where], sizes[where]

    @cached_property
    def distinct(self) -> list[bytes]:
        return [self.data[s : s + k] for s, k in zip(self.starts.tolist(), self.sizes.tolist(), strict=True)]


def _distinct(data: bytes, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each span the number of its content, and one place for each content.

    Spans of up to 32 bytes are compared as four integers, longer ones as bytes.
    """
    n = len(starts)
    index = np.empty(n, np.int64)
    short = sizes <= _LONG
    s, k = starts[short], sizes[short]
    padded = np.frombuffer(data + bytes(_LONG + 8), np.uint8)
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    parts = []
    key = k.astype(np.uint64)
    widest = int(k.max()) if len(k) else 0
    for j in range(0, widest, 8):
        left = np.clip(k - j, 0, 8).astype(np.uint64)
        keep = np.where(left == 8, ~np.uint64(0), (np.uint64(1) << (left * np.uint64(8))) - np.uint64(1))
        part = eight[s + j] & keep
        parts.append(part)
        key = (key ^ part) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    _, where, back = np.unique(key, return_index=True, return_inverse=True)
    same = np.ones(len(s), bool)
    for part in [*parts, k]:
        same &= part == part[where][back]
    index[short] = back
    places = [np.flatnonzero(short)[where]]
    # what is left: long spans, and any that share a key with different content
    rest = np.concatenate((np.flatnonzero(~short), np.flatnonzero(short)[~same]))
    seen: dict[bytes, int] = {}
    more: list[int] = []
    for i in rest.tolist():
        word = data[starts[i] : starts[i] + sizes[i]]
        if word not in seen:
            seen[word] = len(where) + len(more)
            more.append(i)
        index[i] = seen[word]
    return index, np.concatenate((*places, np.array(more, np.int64))).astype(np.int64)
