import zlib
from collections import Counter, defaultdict

import numpy as np

from tests.llm.conftest import SF_SMALL
from textloom.llm import shards
from textloom.llm.shards import communication_matrix, shard_sizes, shuffle_into_shards


def test_matrix_sums_are_exact():
    sources, sizes = np.array([5, 0, 17, 30, 1]), shard_sizes(53, 6)
    m = communication_matrix(sources, sizes, 1)
    assert (m.sum(1) == sources).all() and (m.sum(0) == sizes).all() and sizes.max() - sizes.min() == 1
    large = shards._draw(np.random.default_rng(1), np.array([4 * 10**9, 0, 4 * 10**9]), 1000)
    assert large.sum() == 1000 and large[1] == 0 and 400 < large[0] < 600


def test_shards_of_odd_rows(odd_docs, no_docs):
    out = shuffle_into_shards(odd_docs, 4)
    assert sorted(set(out.columns) - set(odd_docs.columns)) == []  # its own shard and slot are replaced
    slots = defaultdict(list)
    for r in out.collect():
        slots[r["shard"]].append(r["slot"])
    assert sorted(map(len, slots.values())) == [3, 3, 4, 4] and all(sorted(v) == list(range(len(v))) for v in slots.values())
    count = lambda df: Counter((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())
    assert count(out) == count(odd_docs)
    assert shuffle_into_shards(no_docs, 4).count() == 0


def test_every_column_comes_back(odd_docs):
    out = shuffle_into_shards(odd_docs, 4)
    kept = [c for c in odd_docs.columns if c not in ("shard", "slot")]
    assert Counter(map(tuple, out.select(kept).collect())) == Counter(map(tuple, odd_docs.select(kept).collect()))


def test_maps_take_part(spark):
    rows = spark.sql("SELECT id, map('a', id, 'b', id % 2) AS m, array(struct(map(1, id) AS n)) AS deep, id AS _Block FROM range(50)")
    out = shuffle_into_shards(rows, 3)
    assert sorted(r["id"] for r in out.collect()) == list(range(50)) and all(r["m"]["a"] == r["deep"][0]["n"][1] == r["_Block"] == r["id"] for r in out.collect())


def test_the_query_shards_whole_documents(spark, monkeypatch):
    given, whole = [], shards.shuffle_into_shards
    monkeypatch.setattr(shards, "shuffle_into_shards", lambda df, *a, **b: given.append(df.columns) or whole(df, *a, **b))
    rows = shards.op3_shards(spark, SF_SMALL).collect()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert given == [docs.columns]
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {i: (len(t) + 8, zlib.crc32(t)) for i, t in texts.items()}
    assert sorted((r["shard"], r["slot"]) for r in rows) == [(j, k) for j, n in enumerate(shard_sizes(len(texts), 24)) for k in range(n)]


def test_every_place_is_as_likely(spark):
    rows = spark.range(40)
    firsts = Counter()
    for seed in range(12):
        firsts.update((r["shard"], r["slot"]) for r in shuffle_into_shards(rows, 3, seed).filter("id < 10").collect())
    assert len(firsts) > 35 and max(firsts.values()) <= 9
    assert shuffle_into_shards(rows, 3, 1).collect() != shuffle_into_shards(rows, 3, 2).collect()
