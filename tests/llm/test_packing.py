import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from textloom.llm.bfd_pack import best_fit_decreasing, pack_rows, write_packed
from textloom.llm.cutting_stock import best_pattern, cut_patterns, pack, pack_documents
from textloom.llm.token_ids import document_ids


def test_patterns_meet_the_demand_with_few_sequences():
    rnd = np.random.default_rng(1)
    for capacity, kinds in ((16, 9), (128, 90), (128, 1)):
        sizes = np.sort(rnd.choice(np.arange(1, capacity + 1), kinds, replace=False))
        demand = rnd.integers(1, 400, kinds)
        plan = cut_patterns(sizes, demand, capacity)
        assert (sum(c * n for c, n in plan) == demand).all() and all((c * sizes).sum() <= capacity for c, _ in plan)
        items = [int(s) for s, n in zip(sizes, demand, strict=True) for _ in range(n)]
        assert sum(n for _, n in plan) <= best_fit_decreasing(items, capacity)[1] + 2
    assert cut_patterns(np.array([], int), np.array([], int), 8) == []


def test_knapsack_is_optimal():
    rnd = random.Random(3)
    for _ in range(50):
        sizes = np.array(sorted(rnd.sample(range(1, 15), 4)))
        values = np.array([rnd.random() for _ in sizes])
        best = [0.0] * 21
        for room in range(1, 21):
            best[room] = max([best[room - 1], *(v + best[room - s] for s, v in zip(sizes, values, strict=True) if s <= room)])
        value, counts = best_pattern(values, sizes, 20)
        assert value == pytest.approx(best[20]) and counts @ values == pytest.approx(value) and counts @ sizes <= 20


def test_best_fit_decreasing_against_a_plain_search():
    rnd = random.Random(5)
    for _ in range(100):
        items = [rnd.randrange(1, 33) for _ in range(rnd.randrange(60))]
        rooms, want = [], {}
        for i in sorted(range(len(items)), key=lambda i: -items[i]):
            open_rows = [room for room in rooms if room >= items[i]]
            rooms.append(32) if not open_rows else None
            at = rooms.index(min(open_rows)) if open_rows else len(rooms) - 1
            rooms[at] -= items[i]
            want[i] = rooms[at]
        out, rows = best_fit_decreasing(items, 32)
        used = defaultdict(int)
        for i, row in enumerate(out):
            used[row] += items[i]
        assert rows == len(rooms) and sorted(32 - u for u in used.values()) == sorted(rooms)


def check_pieces(rows, docs, length):
    ids = [(d, x) for d, x in zip((r["doc_id"] for r in docs), document_ids([r["text"] or "" for r in docs]), strict=True)]
    sequences, owned = defaultdict(list), defaultdict(int)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        owned[r["doc_id"]] += r["length"]
        assert any(zlib.crc32(x[r["start"] : r["start"] + r["length"]].astype("<u4").tobytes()) == r["ids_crc32"] and len(x) == r["doc_tokens"] for d, x in ids if d == r["doc_id"])
    want = defaultdict(int)
    for d, x in ids:
        want[d] += len(x)
    assert owned == want
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return len(sequences), sum(want.values())


def test_cutting_stock_packs_all_ids(odd_docs, no_docs, spark):
    check_pieces(pack_documents(odd_docs).collect(), odd_docs.collect(), 1024)
    assert pack_documents(no_docs).count() == 0
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sequences, tokens = check_pieces(pack_documents(docs).collect(), docs.collect(), 1024)
    assert sequences * 1024 < tokens * 1.01


def test_packed_sequences_hold_the_ids(odd_docs):
    rows = pack_documents(odd_docs, 64).collect()
    docs = odd_docs.collect()
    known = [(d["doc_id"], x) for d, x in zip(docs, document_ids([d["text"] or "" for d in docs]), strict=True)]
    sequences = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4")
        assert any(d == r["doc_id"] and np.array_equal(x[r["start"] : r["start"] + r["length"]], ids) for d, x in known)
        assert len(ids) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        sequences[r["sequence_id"]].append((r["offset"], ids))
    packed = [np.concatenate([ids for _, ids in sorted(parts, key=lambda p: p[0])]) for parts in sequences.values()]
    assert max(map(len, packed)) <= 64 and sum(map(len, packed)) == sum(len(x) for _, x in known)


def test_other_columns_of_pieces_stay(spark):
    names = "_step _rank _at _block _size _start _place _group _of sequence_id offset".split()
    pieces = spark.range(40).selectExpr("id AS doc_id", "0L AS start", "id % 16 + 1 AS length", *(f"id AS {n}" for n in names))
    rows = pack(pieces, 16, 1).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(40)) and all(r[n] == r["doc_id"] for r in rows for n in names[:-2])
    used = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == used[r["sequence_id"]]
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 16


def exploded(packed):
    for r in packed.collect():
        ids, positions = np.frombuffer(r["ids"], "<u4"), np.frombuffer(r["positions"], "<u4")
        ends = [0]
        for d, p in zip(r["doc_ids"], r["pieces"], strict=True):
            cut = slice(p["offset"], p["offset"] + p["length"])
            assert positions[cut].tolist() == list(range(p["length"]))
            ends.append(cut.stop)
            yield {"doc_id": d, "sequence_id": r["sequence_id"], "ids_crc32": zlib.crc32(ids[cut].tobytes()), **p.asDict()}
        assert r["cu_seqlens"] == ends and not ids[ends[-1] :].any()


def test_bfd_rows(odd_docs, no_docs, spark, tmp_path):
    check_pieces(list(exploded(pack_rows(odd_docs, 64))), odd_docs.collect(), 64)
    assert pack_rows(no_docs).count() == 0
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    write_packed(docs, str(tmp_path / "packed"))
    sequences, tokens = check_pieces(list(exploded(spark.read.parquet(str(tmp_path / "packed")))), docs.collect(), 1024)
    assert sequences * 1024 < tokens * 1.02
