import base64
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings, strategies as st

from textloom.llm import bpe, token_ids
from textloom.llm.bpe_tables import decode_table, encode_table
from textloom.llm.pretokens import Matches
from textloom.llm.text import Words, chunks, shingles

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = regex.compile(public_tokenizers.PATTERN)
SIGNS = ["'", "s", "t", "re", "ve", "ll", "d", "m", " ", "  ", "\n", "\t", "a", "B", "é", "1", "²", "!", "-", "_", "漢", " ", "🙂", "'s", "\x00", " "]


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(texts):
    out = []
    for lo, hi in chunks(texts):
        ids, firsts = bpe.encode_texts(PATH, texts[lo:hi])
        out += [ids[a:b] for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
    return out


def samples():
    rnd = random.Random(1)
    return ["".join(rnd.choice(SIGNS) for _ in range(rnd.randrange(30))) for _ in range(3000)] + ["", "a" * 5000, "!" * 3000, " " * 2000, "\n" * 17, "ab'" * 300]


def test_matches_are_those_of_the_pattern():
    texts = samples()
    m = Matches(texts)
    for i, t in enumerate(texts):
        assert [m.distinct[k] for k in m.index[m.firsts[i] : m.firsts[i + 1]]] == [w.encode() for w in PATTERN.findall(t)]


def test_ids_are_those_of_the_library(reference):
    texts = samples() + ["<|endoftext|> it's"]
    for t, ids in zip(texts, encoded(texts), strict=True):
        assert ids.tolist() == reference.encode_ordinary(t)
        assert bpe.decode_ids(PATH, ids) == t.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(codec="utf-8", max_codepoint=0x3FF), max_size=40))
def test_any_text(reference, text):
    (ids,) = encoded([text])
    assert ids.tolist() == reference.encode_ordinary(text) and bpe.decode_ids(PATH, ids) == text.encode()


def test_a_full_cache_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 3)
    bpe._kept.clear()
    texts = samples()[:300]
    assert [i.tolist() for i in encoded(texts)] == [reference.encode_ordinary(t) for t in texts]
    bpe._kept.clear()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(token_ids.TOKENIZER))


def by_library(tokenizer, texts):
    return [[*e.ids, 0] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_document_ids_are_those_of_the_tokenizer_file(tokenizer):
    texts = samples()
    assert [x.tolist() for x in token_ids.document_ids(texts)] == by_library(tokenizer, texts)


def test_names_of_added_tokens_are_those_tokens(tokenizer):
    name = "<|endoftext|>"
    texts = [f"a {name} b", name, f"x{name}{name}y  ", f"{name}\n {name} ", name[:-1], "", f"é🙂{name}漢"]
    ids = [x.tolist() for x in token_ids.document_ids(texts)]
    assert ids == by_library(tokenizer, texts) and ids[1] == [50256, 0]
    assert token_ids.document_ids([]) == []


@pytest.mark.parametrize("kept", [0, 3, 700])
def test_a_full_bank_changes_nothing(tokenizer, monkeypatch, kept):
    code = token_ids.coder(public_tokenizers.path(token_ids.TOKENIZER))
    monkeypatch.setattr(token_ids, "KEPT", kept)
    monkeypatch.setattr(code, "kept", token_ids.Kept())
    texts = samples()[:300]
    for some in (texts[:100], texts[50:], texts):
        assert [x.tolist() for x in token_ids.document_ids(some)] == by_library(tokenizer, some)
    assert len(code.kept.keys) <= kept and (np.diff(code.kept.keys.astype(object)) > 0).all()


def test_contents_that_share_a_key_are_told_apart(tokenizer, monkeypatch):
    code = token_ids.coder(public_tokenizers.path(token_ids.TOKENIZER))
    monkeypatch.setattr(code, "kept", token_ids.Kept())
    monkeypatch.setattr(token_ids, "mixed", lambda x: x % np.uint64(7))
    texts = [*samples()[:60], "a", "a\0", "a\0\0", "abcdefgh", "abcdefghijklmnop", "abcdefghijklmnopq"]
    for _ in range(2):
        assert [x.tolist() for x in token_ids.document_ids(texts)] == by_library(tokenizer, texts)


def test_tables(spark, odd_docs, no_docs, reference):
    coded = encode_table(odd_docs, PATH, decode=True)
    rows = coded.collect()
    want = sorted((str(r["doc_id"]), (r["text"] or "").encode()) for r in odd_docs.collect())
    assert sorted((str(r["doc_id"]), bytes(r["decoded"])) for r in rows) == want
    assert all(np.frombuffer(r["ids"], "<u4").tolist() == reference.encode_ordinary(bytes(r["decoded"]).decode()) for r in rows)
    again = decode_table(coded, PATH).collect()
    assert sorted((str(r["doc_id"]), bytes(r["decoded"])) for r in again) == want
    assert encode_table(no_docs, PATH).count() == 0


def test_words_and_shingles():
    texts = ["The cat, the CAT!", "", "one two", "a b c d e f", "?!"]
    w = Words(texts)
    assert np.diff(w.firsts).tolist() == [4, 0, 2, 6, 0]
    assert w.hashes[0] == w.hashes[2] and w.hashes[1] == w.hashes[3] and w.hashes[0] != w.hashes[1]
    g, firsts = shingles(w, 5)
    assert np.diff(firsts).tolist() == [1, 0, 1, 2, 0]
    alone, _ = shingles(Words(["b C d E f"]), 5)
    assert alone[0] == g[firsts[3] + 1]
