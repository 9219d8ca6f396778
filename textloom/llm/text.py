"""Vectorised text steps for Arrow batches: code points, character classes, words and their hashes.

A batch is worked through in chunks of whole texts, so memory follows the chunk and the longest
text. Null texts count as empty everywhere.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3

#: Code points of one chunk, unless a single text is longer, and texts at most.
CHUNK = 1 << 19
CHUNK_TEXTS = 2048

_BASE = 0x9E3779B97F4A7C15


@cache
def classes() -> np.ndarray:
    """Class of each code point: letter (L*), number (N*), white space, or other."""
    table = np.zeros(sys.maxunicode + 1, np.uint8)
    for cp in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            table[cp] = LETTER
        elif kind == "N":
            table[cp] = NUMBER
    # fixed values: the characters with the White_Space property
    spaces = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
    table[list(spaces)] = SPACE
    return table


@cache
def uppers() -> np.ndarray:
    """Which code points are upper- or title-case letters."""
    return np.fromiter((unicodedata.category(chr(cp)) in ("Lu", "Lt") for cp in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that few texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts_of(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def chunks(texts: list[str], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``limit`` characters each."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if i > start and (held + len(t) > limit or i - start == CHUNK_TEXTS):
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


class Chunk:
    """Some texts side by side: ``cps`` code points, ``kinds`` their classes, ``ends`` the text ends."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.joined = "".join(texts)
        self.cps = np.frombuffer(self.joined.encode("utf-32-le"), np.uint32)
        self.ends = np.fromiter(accumulate(map(len, texts)), np.int64, len(texts))
        self.starts = np.concatenate(([0], self.ends[:-1])).astype(np.int64)
        self.kinds = classes()[self.cps]

    def runs(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of maximal runs of one kind that stay within a text."""
        if not len(kinds):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        cut = np.empty(len(kinds), bool)
        cut[0] = True
        np.not_equal(kinds[1:], kinds[:-1], out=cut[1:])
        cut[self.starts[self.starts < len(kinds)]] = True
        starts = np.flatnonzero(cut)
        return starts, np.append(starts[1:], len(kinds))

    def byte_offsets(self) -> np.ndarray:
        """UTF-8 offset of every code point, and of the end."""
        out = np.empty(len(self.cps) + 1, np.int64)
        out[0] = 0
        if self.joined.isascii():
            out[1:] = np.arange(1, len(self.cps) + 1)
            return out
        size = np.ones(len(self.cps), np.int64)
        for limit in (0x80, 0x800, 0x10000):
            size += self.cps >= limit
        np.cumsum(size, out=out[1:])
        return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64; kept up to the chunk size."""
    if len(_powers[0]) >= n:
        return _powers
    made = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        made.append(np.multiply.accumulate(steps))
    if n <= 2 * CHUNK:
        _powers[:] = made
    return made


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of ``values`` (by content, whatever its place)."""
    up, down = _power_tables(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mixed(values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Words:
    """Normalised words of some texts: maximal runs of letters and digits, in lower case.

    ``hashes`` holds one 64-bit hash per word in order; ``firsts`` the index of each text's first
    word, with the total at its end.
    """

    def __init__(self, texts: list[str]):
        chunk = Chunk([t.lower() for t in texts])
        starts, ends = chunk.runs((chunk.kinds == LETTER) | (chunk.kinds == NUMBER))
        kept = np.isin(chunk.kinds[starts], (LETTER, NUMBER)) if len(starts) else np.empty(0, bool)
        starts, ends = starts[kept], ends[kept]
        self.hashes = span_hashes(chunk.cps, starts, ends)
        self.firsts = np.concatenate((np.searchsorted(starts, chunk.starts), [len(starts)])).astype(np.int64)
        self.starts, self.ends, self.chunk = starts, ends, chunk


def shingles(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words within each text, and the index of each text's first.

    A text with fewer words has one shingle of all its words; a text without words has none.
    """
    counts = np.diff(words.firsts)
    sizes = np.where(counts == 0, 0, np.maximum(counts - width + 1, 1))
    firsts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    total = int(firsts[-1])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    starts = words.firsts[owner] + np.arange(total) - firsts[owner]
    ends = np.minimum(starts + width, words.firsts[owner + 1])
    return span_hashes(words.hashes, starts, ends), firsts
