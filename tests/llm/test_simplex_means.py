import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from textloom.llm.simplex_means import Simplex, bounds, simplex_means, with_inertia
from tests.llm.conftest import CLASHING

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), *(T.StructField(c, T.StringType()) for c in CLASHING)])


def plain(rows, k, rounds, dims, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centres = [v for _, v in first]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((far(v, c), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for j, vs in groups.items():
            centres[j] = [sum(x) // len(vs) for x in zip(*vs)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in kept), key=repr), centres


def frame(spark, rows):
    return spark.createDataFrame([(i, v, *(["x"] * len(CLASHING))) for i, v in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("dims,k,spread", [(6, 4, 1.0), (16, 16, 0.2), (3, 40, 1.0), (5, 7, 2.0**22)])
def test_against_plain_integers(spark, dims, k, spread):
    rnd = random.Random(dims)
    rows = [(i, [rnd.gauss(rnd.choice((-1, 1)), 0.3) * spread for _ in range(dims)]) for i in range(120)]
    rows += [(i, list(rows[0][1])) for i in range(200, 260)]  # a hot vector
    rows += [(7, list(rows[9][1])), (7, list(rows[9][1])), (None, [0.5 * spread] * dims), (300, None), (301, []), (302, [None] * dims), (303, [float("nan")] * dims), (304, [float("inf")] + [0.0] * (dims - 1))]
    got, centres, compared = simplex_means(frame(spark, rows), k, 3, dimensions=dims)
    want, want_centres = plain(rows, k, 3, dims)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want and centres == want_centres
    assert all(len(want) <= n <= len(want) * k for n in compared) and (k > 16 or compared[0] < len(want) * k)
    if spread > 1000:  # the parts fit a long, their sum does not
        with pytest.raises(ValueError, match="larger than a long"):
            with_inertia(got, centres)
        return
    facts = with_inertia(got, centres).collect()
    assert {r["inertia"] for r in facts} == {sum(d for _, _, d in want)}
    for r in facts:
        assert r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centres[r["cluster"]])).encode()).hexdigest()


def test_few_and_no_vectors(spark):
    rows = [(3, [1.0, 2.0]), (1, [5.0, 5.0]), (3, [1.0, 2.0])]
    got, centres, _ = simplex_means(frame(spark, rows), 16, 3, dimensions=2)
    want, want_centres = plain(rows, 16, 3, 2)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want and centres == want_centres
    none, centres, compared = simplex_means(frame(spark, rows).filter("false"), 16, 3, dimensions=2)
    assert none.count() == 0 and centres == compared == [] and with_inertia(none, centres).count() == 0
    same, _, _ = simplex_means(frame(spark, [(i, [0.25, 0.25]) for i in range(50)]), 4, 3, dimensions=2)
    assert {(r["cluster"], r["distance"]) for r in same.collect()} == {(0, 0)}


def test_too_large_to_compare(spark):
    with pytest.raises(Exception, match="larger than a long"):
        simplex_means(frame(spark, [(1, [1e300, 0.0]), (2, [0.0, 0.0])]), 2, 1, dimensions=2)
    got, _, _ = simplex_means(frame(spark, [(1, [1e9, 0.0]), (2, [-1e9, 0.0]), (3, [0.0, 0.0])]), 1, 0, dimensions=2)
    with pytest.raises(Exception, match="larger than a long"):
        got.collect()


def test_bounds_hold(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(-50, 50, (200, 20))
    simplex = Simplex(x[:16])
    assert len(simplex.pivots) == 12
    low, high = bounds(simplex.project(x), simplex.project(x[:30]))
    true = ((x[:, None] - x[None, :30]) ** 2).sum(2)
    assert (low <= true * (1 + 1e-9) + 1e-6).all() and (high >= true * (1 - 1e-9) - 1e-6).all() and (low > 0.3 * true).mean() > 0.5
