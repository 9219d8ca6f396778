import random
import re
from hashlib import sha256

import numpy as np
from pyspark.sql import functions as F

from textloom.llm import rank_index
from textloom.llm.fill_middle import boundary_index, fill_in_middle, op13_fill_middle, restored
from tests.llm.conftest import SF_SMALL

TOKEN = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def plain(doc_id, text, cut=50, spm=80):
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    h = sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or h3 % 100 >= cut or any(m in text for m in ("<P>", "<S>", "<M>")):
        return (doc_id, n, "plain", None, None, text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    form = "spm" if h4 % 100 < spm else "psm"
    return (doc_id, n, form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}")


def test_odd_documents(spark, odd_docs, no_docs):
    more = [(100 + i, t) for i, t in enumerate(["<P>", "a <S> b", "x <M", "<", "a<", "<S", " \x1f\x85 b c", "\n\n", "tail  \n", "\x00 nul", "🙂 a\r\n b"] * 6)]
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id bigint, text string"))
    for cut, spm in ((50, 80), (100, 0), (100, 100)):
        got = fill_in_middle(docs, cut=cut, suffix_first=spm)
        want = [plain(r["doc_id"], r["text"], cut, spm) for r in docs.collect()]
        assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want))
        back = got.select("doc_id", restored(F.col("output"), F.col("form")).alias("text"))
        assert sorted(map(repr, (tuple(r) for r in back.collect()))) == sorted(repr((r["doc_id"], r["text"] or "")) for r in docs.collect())
    assert fill_in_middle(odd_docs).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert fill_in_middle(no_docs).count() == 0


def test_index_is_exact_and_within_its_error(spark, odd_docs):
    rnd = random.Random(1)
    for n in (0, 1, 2, 257, 5000):
        ends = np.cumsum([0] + [rnd.choice((1, 3, 7, 9000 if rnd.random() < 0.01 else 4)) for _ in range(n)]).astype(np.int64)
        for error in (1, 24, 500):
            index = rank_index.fit(ends, error)
            assert (index.lookup(np.arange(n + 1)) == ends).all() and (np.abs(index.residuals) <= error).all()
            assert len(index.ranks) <= n + 1 and (n < 5000 or error < 24 or len(index.ranks) < n / 4)
    for r in boundary_index(odd_docs).join(odd_docs.select("doc_id", F.col("text").alias("t")).dropDuplicates(), "doc_id").collect():
        index = rank_index.RankIndex(*(np.array([s[c] for s in r["segments"]]) for c in ("rank", "offset", "slope")), np.frombuffer(r["residuals"], np.int8))
        want = np.cumsum([0] + [len(t) for t in TOKEN.findall(r["t"] or "")])
        assert r["n"] == len(want) - 1 and (index.lookup(np.arange(len(want))) == want).all()


def test_query_rebuilds_every_text(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    rows = op13_fill_middle(spark, SF_SMALL).collect()
    assert {r["doc_id"]: r["restored_sha256"] for r in rows} == {i: sha256(t.encode()).hexdigest() for i, t in texts.items()}
    assert {r["form"] for r in rows} == {"plain", "spm", "psm"}
