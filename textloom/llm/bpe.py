"""Byte-level BPE encoding and decoding by a rank file, for whole tables of texts.

Each match of the public pattern is encoded on its own: its bytes are the leaves of a segment tree
whose nodes hold the least (pair rank, position) below them, so the root names the leftmost pair of
least rank. A merge removes one position and changes two pairs, hence two walks to the root. Trees
of equal size are worked on together, one merge each per step, as rows of one array.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import cache
from typing import NamedTuple

import numpy as np

from textloom.llm.pretokens import Matches

#: Distinct matches whose ids a worker keeps; those met later are encoded each time.
CACHE = 100_000
#: Tree leaves worked on at once.
LEAVES = 1 << 17

_NONE = np.int64(1) << np.int64(62)


class Ranks(NamedTuple):
    """A rank file as arrays; ids are ranks."""

    single: np.ndarray  # id of each byte
    keys: np.ndarray  # sorted (left id << 32 | right id)
    merged: np.ndarray  # id of each pair
    tokens: list[bytes]  # bytes of each id
    table: np.ndarray  # the same, side by side
    offsets: np.ndarray


@cache
def load_ranks(path: str) -> Ranks:
    """Read a rank file: lines of base64 bytes and a rank. Every executor has the file."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    tokens = [b""] * (max(ranks.values()) + 1)
    for word, rank in ranks.items():
        tokens[rank] = word
    pairs = [
        (ranks[word[:i]] << 32 | ranks[word[i:]], rank)
        for word, rank in ranks.items()
        for i in range(1, len(word))
        if word[:i] in ranks and word[i:] in ranks
    ]
    keys = np.array([k for k, _ in pairs], np.int64)
    merged = np.array([r for _, r in pairs], np.int64)
    order = np.argsort(keys)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype(np.int64)
    single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
    return Ranks(single, keys[order], merged[order], tokens, np.frombuffer(b"".join(tokens), np.uint8), offsets)


def pair_ranks(ranks: Ranks, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Rank of each joined pair; a very large number where the vocabulary has none."""
    key = left << np.int64(32) | right
    at = np.minimum(np.searchsorted(ranks.keys, key), len(ranks.keys) - 1)
    return np.where((ranks.keys[at] == key) & (left >= 0) & (right >= 0), ranks.merged[at], _NONE >> np.int64(32))


def _encode_rows(ranks: Ranks, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Merge rows of byte ids in place; dead positions become -1. Rows have a power of two of places."""
    rows, leaves = ids.shape
    place = np.arange(leaves, dtype=np.int64)
    after = np.where(place + 1 < counts[:, None], place + 1, -1)
    before = np.broadcast_to(place - 1, ids.shape).copy()
    tree = np.full((rows, 2 * leaves), _NONE)
    score = np.full(ids.shape, _NONE)
    if leaves > 1:
        score[:, :-1] = (pair_ranks(ranks, ids[:, :-1], ids[:, 1:]) << np.int64(32)) | place[:-1]
        score[after < 0] = _NONE
    tree[:, leaves:] = score
    width = leaves // 2
    while width >= 1:
        tree[:, width : 2 * width] = np.minimum(tree[:, 2 * width : 4 * width : 2], tree[:, 2 * width + 1 : 4 * width : 2])
        width //= 2
    limit = (_NONE >> np.int64(32)) << np.int64(32)

    def update(r, at, value):
        node = at + leaves
        tree[r, node] = value
        while leaves > 1 and node[0] > 1:
            node = node >> 1
            tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])

    live = np.flatnonzero(tree[:, 1] < limit)
    while len(live):
        best = tree[live, 1]
        at = best & np.int64(0xFFFFFFFF)
        gone = after[live, at]
        ids[live, at] = best >> np.int64(32)
        ids[live, gone] = -1
        nxt = after[live, gone]
        after[live, at] = nxt
        has = nxt >= 0
        before[live[has], nxt[has]] = at[has]
        update(live, gone, np.full(len(live), _NONE))
        value = np.full(len(live), _NONE)
        value[has] = (pair_ranks(ranks, ids[live[has], at[has]], ids[live[has], nxt[has]]) << np.int64(32)) | at[has]
        update(live, at, value)
        prev = before[live, at]
        has = prev >= 0
        if has.any():
            r, p, a = live[has], prev[has], at[has]
            update(r, p, (pair_ranks(ranks, ids[r, p], ids[r, a]) << np.int64(32)) | p)
        live = live[tree[live, 1] < limit]
    return ids


def encode_words(ranks: Ranks, words: list[bytes]) -> list[bytes]:
    """Ids of each byte string as little-endian unsigned 32-bit integers."""
    out: list[bytes] = [b""] * len(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    power = np.where(sizes > 0, 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64), 0)
    for leaves in np.unique(power[power > 0]).tolist():
        members = np.flatnonzero(power == leaves)
        step = max(1, LEAVES // leaves)
        for k in range(0, len(members), step):
            part = members[k : k + step]
            counts = sizes[part]
            ids = np.full((len(part), leaves), -1, np.int64)
            held = np.frombuffer(b"".join(words[i] for i in part.tolist()), np.uint8)
            ids[np.arange(leaves) < counts[:, None]] = ranks.single[held]
            ids = _encode_rows(ranks, ids, counts)
            flat = ids[ids >= 0].astype("<u4").tobytes()
            stops = (4 * np.cumsum((ids >= 0).sum(1))).tolist()
            start = 0
            for i, stop in zip(part.tolist(), stops, strict=True):
                out[i] = flat[start:stop]
                start = stop
    return out


_kept: dict[str, dict[bytes, bytes]] = {}


def encode_texts(path: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts side by side, and the first of each text with the total at the end."""
    matches = Matches(texts)
    return spread_ids(matches, known_ids(_kept.setdefault(path, {}), matches.distinct, lambda words: encode_words(load_ranks(path), words)))


def known_ids(known: dict[bytes, bytes], words: list[bytes], encode: Callable[[list[bytes]], list[bytes]]) -> list[bytes]:
    """Ids of distinct matches, from what the worker has kept or else from ``encode``."""
    parts = list(map(known.get, words))
    missing = [i for i, p in enumerate(parts) if p is None]
    if missing:
        made = encode([words[i] for i in missing])
        for i, p in zip(missing, made, strict=True):
            parts[i] = p
        if len(known) < CACHE:
            known.update((words[i], parts[i]) for i in missing)
    return parts


def spread_ids(matches: Matches, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts from the ids of their distinct matches."""
    sizes = np.fromiter(map(len, parts), np.int32, len(parts)) >> 2
    return spread_bank(matches, np.frombuffer(b"".join(parts), "<u4"), np.cumsum(sizes, dtype=np.int64) - sizes, sizes)


def spread_bank(matches: Matches, bank: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same, where the ids of a distinct match are ``sizes`` places of ``bank`` from ``begin`` on."""
    each = sizes[matches.index]
    stops = np.cumsum(each, dtype=np.int64)
    total = int(stops[-1]) if len(stops) else 0
    ids = bank[np.repeat(begin[matches.index] - (stops - each), each) + np.arange(total)]
    return ids, np.concatenate(([0], stops))[matches.firsts]


def decode_ids(path: str, ids: np.ndarray) -> bytes:
    """Bytes of a sequence of ids."""
    ranks = load_ranks(path)
    sizes = ranks.offsets[ids.astype(np.int64) + 1] - ranks.offsets[ids]
    stops = np.cumsum(sizes)
    total = int(stops[-1]) if len(stops) else 0
    return ranks.table[np.repeat(ranks.offsets[ids] - (stops - sizes), sizes) + np.arange(total)].tobytes()
