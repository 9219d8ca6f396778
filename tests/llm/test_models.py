import zlib

import numpy as np
import pytest

from tests.llm.conftest import SF
from textloom.llm import quality, toxicity
from textloom.llm.queries import QUERIES


def held(rows, labels, label):
    known = {r["doc_id"]: r[label] for r in labels.collect()}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    return [(r["predicted"], known[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in known]


def test_quality_on_held_out_rows(spark):
    rows = QUERIES["op8_quality_machine"](spark, SF).collect()
    pairs = held(rows, spark.read.parquet(f"{SF}/labels.parquet"), "quality")
    assert len(rows) == 1000 and np.mean([p == y for p, y in pairs]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_toxicity_on_held_out_rows(spark):
    rows = QUERIES["op6_toxicity"](spark, SF).collect()
    pairs = held(rows, spark.read.parquet(f"{SF}/labels.parquet"), "toxic")
    assert len(rows) == 1000 and np.mean([p == y for p, y in pairs]) > 0.92
    assert all(0 <= r["severity"] <= 3 and r["grade"] in (0, 1, 2, 3) for r in rows)


def test_pairs_in_linear_time():
    rng = np.random.default_rng(1)
    x, w, v = rng.normal(size=(4, 9)), rng.normal(size=9), rng.normal(size=(9, 3))
    want = [0.5 + r @ w + sum(r[i] * r[j] * (v[i] @ v[j]) for i in range(9) for j in range(i + 1, 9)) for r in x]
    assert quality._raw(x, 0.5, w, v) == pytest.approx(want)


def test_thresholds_are_ordered_and_shared():
    rng = np.random.default_rng(2)
    owner = np.repeat(np.arange(300), 6)
    hashes = rng.integers(0, 40, 1800).astype(np.uint64)
    bad = np.array([np.isin(hashes[owner == i], (1, 2, 3)).sum() for i in range(300)])
    model = toxicity.fit(owner, hashes, np.minimum(bad, 3))
    assert (np.diff(model.thresholds) > 0).all() and set(model.words[np.argsort(-model.weights)[:3]].tolist()) == {1, 2, 3}


def test_odd_documents(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 1), (3, 0, 1), (None, 1, 1), (6, 0, 0), (6, 1, 1), (77, 1, 1), (9, 1, 0), (10, 0, 1)], "doc_id bigint, quality int, toxic int")
    for some in (labels, labels.filter("false")):
        model = quality.fit_quality(odd_docs, some)
        assert all(0 <= r["score"] <= 1 for r in quality.score_quality(odd_docs, model).collect())
        severity = toxicity.fit_severity(odd_docs, some)
        assert toxicity.score_severity(odd_docs, severity).count() == odd_docs.count()
        kept = quality.keep_good(odd_docs, some, threshold=0.0)
        assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert quality.score_quality(no_docs, model).count() == 0 and quality.keep_good(no_docs, labels).count() == 0
    assert toxicity.score_severity(no_docs, severity).count() == 0
    assert quality.score_quality(odd_docs.drop("n_chars"), quality.fit_quality(odd_docs.drop("n_chars"), labels)).count() == 14
