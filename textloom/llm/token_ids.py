"""Token ids of whole documents by a public tokenizer file of the ``tokenizers`` library.

Texts are split into the pattern's matches here; the library's model then encodes distinct matches one
by one, without the normalising, splitting and tracking of places that ``encode`` adds to each.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from functools import cache
from operator import attrgetter

import numpy as np
import public_tokenizers

from textloom.llm.bpe import spread_bank
from textloom.llm.pretokens import Matches
from textloom.llm.text import mixed

TOKENIZER = "byte_bpe_50k.json"
#: Ends every document.
END = 0
#: Matches of up to ``SHORT`` bytes whose ids a worker keeps: about 60 bytes each.
KEPT = 500_000
SHORT = 16

_id = attrgetter("id")


def _byte_signs() -> str:
    """The sign that stands for each byte in byte-level vocabularies: itself if it is visible, else the next from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return "".join(chr(b if b in visible else next(hidden)) for b in range(256))


class Coder:
    """A byte-level tokenizer file: ``words`` encodes matches of its pattern, ``cut`` finds added tokens in a text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        steps = json.loads(tokenizer.to_str())
        split = steps["pre_tokenizer"] or {}
        if steps["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex"):
            raise ValueError(f"{path} is no plain byte-level tokenizer")
        added = tokenizer.get_added_tokens_decoder()
        if odd := [t.content for t in added.values() if t.single_word or t.lstrip or t.rstrip]:
            raise ValueError(f"added tokens that depend on the text around them: {odd}")
        self.model = tokenizer.model
        self.signs = _byte_signs()
        self.added = {t.content: np.array([i], np.uint32) for i, t in added.items()}
        # of those that begin at one place the longest
        self._added = re.compile("({})".format("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))))
        self.kept = Kept()

    def cut(self, text: str) -> list[str]:
        """Ordinary texts and, between them, added tokens."""
        return self._added.split(text) if any(a in text for a in self.added) else [text]

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words side by side, and how many each has."""
        signs = b"".join(words).decode("latin-1").translate(self.signs)
        tokenize, start = self.model.tokenize, 0
        ids: list[int] = []
        stops = []
        for word in words:
            stop = start + len(word)
            ids.extend(map(_id, tokenize(signs[start:stop])))
            stops.append(len(ids))
            start = stop
        return np.array(ids, np.uint32), np.diff(np.array(stops, np.int64), prepend=0)


class Kept:
    """Ids of short matches in arrays: a 64-bit key each, the content to check it by, places in one bank of ids.

    ``keys`` ascend and ``slots`` tell where the other facts of a key stand. Nothing is dropped; beyond
    ``KEPT`` matches new ones are encoded each time.
    """

    def __init__(self):
        self.keys, self.slots = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.content = np.empty((KEPT, SHORT // 8), np.uint64)
        self.sizes, self.begin, self.count = np.empty(KEPT, np.int8), np.empty(KEPT, np.int32), np.empty(KEPT, np.int8)
        self.bank, self.used = np.empty(1 << 16, np.uint32), 0

    def ids(self, found: Matches, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A bank of ids, and for each distinct match its first place there and the number of its ids."""
        n = len(found.starts)
        short = found.sizes <= SHORT
        content, key = _contents(found)
        held = len(self.keys)
        begin, count = np.zeros(n, np.int64), np.zeros(n, np.int64)
        hit, fresh = np.zeros(n, bool), short.copy()
        if held:
            at = np.minimum(np.searchsorted(self.keys, key), held - 1)
            slot = self.slots[at]
            same = self.keys[at] == key
            hit = short & same & (self.sizes[slot] == found.sizes) & (self.content[slot] == content).all(1)
            fresh &= ~same
            begin[hit], count[hit] = self.begin[slot[hit]], self.count[slot[hit]]
        missing = np.flatnonzero(~hit)
        # those to keep come first, so that their ids stand at the beginning of what is added
        missing = missing[np.argsort(~fresh[missing], kind="stable")]
        where = zip(found.starts[missing].tolist(), found.sizes[missing].tolist(), strict=True)
        made, counts = encode([found.data[s : s + k] for s, k in where])
        stops = np.cumsum(counts)
        if self.used + len(made) > len(self.bank):
            self.bank = np.concatenate((self.bank[: self.used], np.empty(self.used + 2 * len(made), np.uint32)))
        self.bank[self.used : self.used + len(made)] = made
        begin[missing], count[missing] = self.used + stops - counts, counts
        if kept := min(int(fresh.sum()), KEPT - held):
            new = missing[:kept]
            slots = slice(held, held + kept)
            self.content[slots], self.sizes[slots], self.begin[slots], self.count[slots] = content[new], found.sizes[new], begin[new], count[new]
            self.used += int(stops[kept - 1])
            keys = np.concatenate((self.keys, key[new]))
            order = np.argsort(keys, kind="stable")
            self.keys, self.slots = keys[order], np.concatenate((self.slots, np.arange(held, held + kept, dtype=np.int32)))[order]
        return self.bank, begin, count


def _contents(found: Matches) -> tuple[np.ndarray, np.ndarray]:
    """The first ``SHORT`` bytes of each distinct match as integers, zeros behind its end, and a key of them."""
    padded = np.frombuffer(found.data + bytes(SHORT), np.uint8)
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    out = np.empty((len(found.starts), SHORT // 8), np.uint64)
    key = mixed(found.sizes.astype(np.uint64))
    for j in range(SHORT // 8):
        left = np.clip(found.sizes - 8 * j, 0, 8).astype(np.uint64)
        keep = np.where(left == 8, ~np.uint64(0), (np.uint64(1) << (left % np.uint64(8) * np.uint64(8))) - np.uint64(1))
        out[:, j] = eight[np.minimum(found.starts + 8 * j, len(eight) - 1)] & keep
        key = mixed(key ^ out[:, j])
    return out, key


@cache
def coder(path: str) -> Coder:
    return Coder(path)


def document_ids(texts: list[str], path: str | None = None) -> list[np.ndarray]:
    """Ids of each text, as the library's ``encode`` gives them, and the end id.

    Names of added tokens in a text become those tokens, which is the library's default. Only distinct
    pattern matches go through the model.
    """
    code = coder(path or public_tokenizers.path(TOKENIZER))
    cuts = [code.cut(t) for t in texts]
    matches = Matches([part for cut in cuts for part in cut[::2]])
    ids, firsts = spread_bank(matches, *code.kept.ids(matches, code.words))
    end, out, k = np.array([END], np.uint32), [], 0
    bounds = firsts.tolist()
    for cut in cuts:
        parts = [ids[bounds[k] : bounds[k + 1]]]
        for name in cut[1::2]:
            k += 1
            parts += [code.added[name], ids[bounds[k] : bounds[k + 1]]]
        k += 1
        out.append(np.concatenate((*parts, end)))
    return out
