import random

import pytest
from pyspark.sql import types as T

SF_SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

#: Names that operators use themselves.
CLASHING = "rank hash text_sha256 keep_id class_id component rep shard slot spans score label sequence_id offset length _row _gone".split()
CLASHING += "_source _at _block _place _of _group _size _start _shard_row _shard_second _step _rank _piece _placed".split()


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    rnd = random.Random(4)
    long_text = " ".join(rnd.choice("alpha beta gamma delta ünïcode 12 x-y".split()) for _ in range(60_000))
    texts = [(1, "same text of some words here"), (2, "same text of some words here"), (3, None), (4, ""), (5, "   \n"), (6, long_text), (6, long_text),
             (7, "one two"), (8, "one two"), (None, "same text of some words here"), (None, None), (9, "!!! ???"), (10, "a" * 30_000), (11, "漢字 🙂 token='abcdefghijkl'")]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                           T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), *(T.StructField(c, T.StringType()) for c in CLASHING)])
    rows = [(i, t, None, "s", None if t is None else len(t), *(["v"] * len(CLASHING))) for i, t in texts]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("false")
