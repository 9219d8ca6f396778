"""Fuzzy lookup by stored pieces of terms, against the edit distance itself."""

import random

from pyspark.sql import functions as F

from textloom.operators import fuzzy as Z
from textloom.plans import compile as plan, queries as Q
from textloom.plans.mapping import Field, Mapping
from textloom.session import new_table_path
from textloom.sources.collection import Collection
from textloom.operators.batch import batch_search


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def words(rng, n):
    return sorted({"".join(rng.choice("abü🙂") for _ in range(rng.randrange(1, 11))) for _ in range(n)})


def test_every_near_term_shares_a_key(spark):
    rng = random.Random(3)
    stored, asked = words(rng, 400), sorted({*words(rng, 60), "", "a"})
    frame = spark.createDataFrame([(w,) for w in stored], "token string")
    keys = {r["token"]: set(r["k"]) for r in frame.select("token", Z.spelling_keys(F.col("token")).alias("k")).collect()}
    assert all(len(k) <= 3 for k in keys.values())
    for edits in (0, 1, 2):
        rows = spark.createDataFrame([(w,) for w in asked], "q string").select("q", Z.lookup_key_column(F.col("q"), F.lit(edits)).alias("k")).collect()
        for r in rows:
            assert sorted(r["k"]) == Z.lookup_keys(r["q"], edits)
            for w in stored:
                assert distance(r["q"], w) > edits or keys[w] & set(r["k"]), (r["q"], w)
    spellings = frame.select("token", F.explode(Z.spelling_keys(F.col("token"))).alias("key"))
    queries = spark.createDataFrame([(w,) for w in asked if w], "q string")
    for edits in (1, 2):
        got = sorted(tuple(r) for r in Z.stored_join(queries, spellings, edits).collect())
        assert got == sorted(tuple(r) for r in Z.fuzzy_join(queries, frame, edits).collect())
        assert got == sorted((q, w, distance(q, w)) for q in asked if q for w in stored if distance(q, w) <= edits)


def test_a_collection_with_and_without_spellings_finds_the_same(spark):
    rng = random.Random(5)
    vocabulary = words(rng, 150)
    rows = [(str(i), " ".join(rng.choice(vocabulary) for _ in range(8))) for i in range(80)]
    docs = spark.createDataFrame(rows, "_id string, t string")
    plain = Collection.create(spark, new_table_path(spark, "plain"), docs, Mapping((Field("t", "text", analyzer="whitespace"),)), buckets=4)
    stored = plain.store_spellings("t")
    assert stored.version == 2 and stored.store_spellings("t") is stored
    batch = spark.createDataFrame([("3", "abababab zzzzzz"), ("new", "zzzzyz bbbbab")], "_id string, t string")
    hits = lambda ix, q: {r["_id"]: round(r["score"], 9) for r in plan.hits(ix, q).collect()}
    asked = spark.createDataFrame([(i, " ".join(rng.choice(vocabulary)[1:] + "a" for _ in range(2))) for i in range(8)], "q int, t string").select(F.col("q").alias("query_id"), F.col("t").alias("text"))
    later = stored.put(batch)
    for with_them, without in ((stored, plain), (later, None)):
        other = without or Collection.create(spark, new_table_path(spark, "other"), later.docs, plain.mapping, buckets=4)
        for q in (Q.Match("t", "abaab zzzzzz", fuzziness=2), Q.Match("t", "bbba", fuzziness="AUTO"), Q.Match("t", "aü", fuzziness=1, prefix_length=1), Q.Match("t", "qqqqqqqq", fuzziness=1)):
            assert hits(with_them, q) == hits(other, q)
        got, want = (sorted(tuple(r) for r in batch_search(ix, asked, "t", 5, fuzziness=1).collect()) for ix in (with_them, other))
        assert got == want and got
    assert set(later.near_terms("t", [("zzzzz", 1)])) == {"zzzzzz", "zzzzyz"} and set(later.near_terms("t", [("zzzzzz", 2)])) == {"zzzzzz", "zzzzyz"}
    assert set(later.compact().near_terms("t", [("zzzzzz", 2)])) == {"zzzzzz", "zzzzyz"}
    text = plan.hits(stored, Q.Match("t", max(vocabulary, key=len), fuzziness=1))._jdf.queryExecution().executedPlan().toString()
    assert "term_bucket" in text and ("In(token" in text or "EqualTo(token" in text)
