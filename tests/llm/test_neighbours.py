import math

import numpy as np
from pyspark.sql import types as T

from textloom.llm import multi_index
from textloom.llm.multi_index import nearest_neighbours, walk


def test_walk_is_in_order_of_summed_distance():
    rng = np.random.default_rng(2)
    a, b = rng.random(5), rng.random(7)
    held = np.ones(35, np.int64)
    held[3] = 0
    cells = walk(a, b, held, 1000)
    sums = [a[c // 7] + b[c % 7] for c in cells]
    assert sorted(cells) == [c for c in range(35) if c != 3] and sums == sorted(sums)
    assert walk(a, b, held, 4) == cells[:4]


def brute(x, ids, query, k):
    score = x @ x[query] / np.sqrt((x * x).sum(1) * (x[query] @ x[query]))
    score[ids == ids[query]] = -2
    return [int(ids[j]) for j in np.lexsort((ids, -score.round(12)))[:k]], score


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(6000, 16)), 3)
    rows = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>").repartition(4)
    got = nearest_neighbours(rows, rows.filter("vec_id % 50 = 0")).collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits, ids = 0, np.arange(6000)
    for q in range(0, 6000, 50):
        want, score = brute(x, ids, q, 5)
        found = sorted(by[q])
        assert [f[0] for f in found] == [1, 2, 3, 4, 5] and all(math.isclose(s, score[v], abs_tol=1e-12) for _, v, s in found)
        hits += len(set(want) & {v for _, v, _ in found})
    assert hits >= 0.9 * 600


def test_common_vectors_bad_vectors_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK", 40)
    rng = np.random.default_rng(1)
    same = [1.0, 2.0, 3.0, 4.0]
    rows = [(i, same) for i in range(0, 400)] + [(1000 + i, rng.normal(size=4).tolist()) for i in range(100)]
    rows += [(0, same), (2000, None), (2001, [0.0] * 4), (2002, [1.0, None, 1.0, 1.0]), (2003, [1.0, float("nan"), 1.0, 1.0]), (2004, [float("inf")] * 4), (2005, [1.0] * 3), (None, same)]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])
    df = spark.createDataFrame(rows, schema)
    got = {}
    for r in nearest_neighbours(df, df.filter("vec_id % 50 = 0")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert set(got) == {q for q in range(0, 400, 50)} | {1000, 1050}
    for q in range(0, 400, 50):
        assert [v for _, v in sorted(got[q])] == [v for v in range(7) if v != q][:5]
    assert nearest_neighbours(df.filter("false"), df).count() == 0
    few = df.filter("vec_id IN (1000, 1001, 1002)").dropDuplicates(["vec_id"])
    assert nearest_neighbours(few, few.filter("vec_id = 1000")).count() == 2


def test_single_components(spark):
    df = spark.createDataFrame([(i, [float(i + 1)]) for i in range(8)], "vec_id bigint, embedding array<float>")
    rows = nearest_neighbours(df, df.filter("vec_id = 0")).collect()
    assert [r["vec_id"] for r in sorted(rows, key=lambda r: r["rank"])] == [1, 2, 3, 4, 5]
