from tests.llm.conftest import SF_SMALL
from tests.llm.test_dedup import brute_classes
from tests.llm.test_packing import check_pieces
from tests.llm.test_secrets import brute as brute_spans

import corpus_pipeline
from textloom.llm import quality
from textloom.llm.secret_scan import masked


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    scores = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, quality.fit_quality(docs, labels)).collect()}
    rows = {r["doc_id"]: r for r in docs.collect()}
    good = {i: r["text"] for i, r in rows.items() if scores[i] >= 0.3}
    last = {}
    for i in sorted(good):
        last[good[i]] = i
    exact = {i: t for t, i in last.items()}
    classes = brute_classes(list(exact.items()))
    single = {i: t for i, t in exact.items() if classes[i][0] == i}
    clean = {i: masked(t, brute_spans(t)) for i, t in single.items()}

    expected = [good, exact, single, clean]
    for (name, stage), want in zip(corpus_pipeline.STAGES[:-1], expected, strict=True):
        docs = stage(spark, docs, SF_SMALL)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert {r["doc_id"]: r["text"] for r in docs.collect()} == want, name
    packed = corpus_pipeline.run(spark, SF_SMALL).collect()
    check_pieces(packed, docs.collect(), 1024)
    assert {r["doc_id"] for r in packed} == set(clean)
