import math
import random
import re

import pytest
from pyspark.sql import functions as F

from textloom.catalog.indexes import index_for
from textloom.operators import analyzers as A, batch as B, completion as G
from textloom.plans import compile as plan, flows, queries as Q, search as R
from textloom.plans.mapping import Field, Mapping
from textloom.session import new_table_path
from textloom.sources import collection as C, ingest as I
from textloom.sources.collection import Collection


@pytest.fixture(scope="module")
def docs(spark, sf):
    return index_for(spark, sf, "documents")


@pytest.fixture(scope="module")
def orders(spark, sf):
    return index_for(spark, sf, "orders")


@pytest.mark.parametrize(
    "make",
    [
        lambda: R.Search(match_all=True, search_after=(1,)).validate(),
        lambda: R.Search(match_all=True, sort=(("a", "asc"),), search_after=(1, 2)).validate(),
        lambda: R.Search(match_all=True, sort=(("a", "asc"),), search_after=(1,), from_=5).validate(),
        lambda: R.Search(match_all=True, from_=2001).validate(),
        lambda: R.Search().validate(),
        lambda: Q.Range("a"),
        lambda: Q.MultiMatch(("a",), "x", "other"),
        lambda: Q.Script(""),
    ],
)
def test_bad_requests(make):
    with pytest.raises(ValueError):
        make()


def test_read_all_needs_a_sort(orders):
    with pytest.raises(ValueError):
        R.read_all(orders, R.Search(match_all=True))


def test_flow_guards(docs):
    with pytest.raises(ValueError):
        flows.phonetic_request(docs, "x", ("text",), ("text",), phonetic_fields=("text",))
    with pytest.raises(ValueError):
        flows.phonetic_request(docs, "x", ("text",), ("text",), search_after=(1,))
    with pytest.raises(ValueError):
        flows.typing_request(docs, "standard", "x", ("text",), ("text",), search_after=(1,))
    assert flows.typing_request(docs, "standard", "...", ("text",), ("text",)) is None
    assert flows.search_as_you_type(docs, "standard", "...", ("text",), ("text",)).count() == 0


@pytest.mark.parametrize("size,want", [(None, None), (0, 1), (50, 50), (2000, 2000)])
def test_page_size(size, want):
    assert R.Search(match_all=True, size=size).page() == want


def test_pages_join_to_read_all(orders):
    sort = (("o_orderstatus", "desc"), ("o_totalprice", "asc"))
    request = R.Search(filter=(Q.Range("o_totalprice", gte=350000.0),), sort=sort, size=40, source=("o_orderstatus", "o_totalprice"))
    whole = R.read_all(orders, request).collect()
    paged, after = [], ()
    while True:
        part = R.run(orders, R.Search(**{**request.__dict__, "search_after": after})).collect()
        if not part:
            break
        paged += part
        after = (part[-1].o_orderstatus, part[-1].o_totalprice)
    assert paged == whole and len(whole) > 80


def test_total_ignores_the_page(orders):
    request = R.Search(filter=(Q.Term("o_orderstatus", "F"),), size=3)
    assert R.total(orders, request).first()[0] == orders.docs.where("o_orderstatus = 'F'").count()


def test_bool_of_one_kind_is_a_union(docs):
    parts = [Q.Match("text", "thble"), Q.Match("text", "attion"), Q.Term("lang", "de")]
    got = {r._id: r.score for r in plan.hits(docs, Q.Bool(should=tuple(parts))).collect()}
    want = {}
    for p in parts:
        for r in plan.hits(docs, p).collect():
            want[r._id] = want.get(r._id, 0.0) + r.score
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def test_filter_and_must_match_the_same(docs):
    q = (Q.Match("text", "the of"), Q.Range("n_chars", gte=500))
    a = {r._id for r in plan.hits(docs, Q.Bool(filter=q)).collect()}
    b = {r._id for r in plan.hits(docs, Q.Bool(must=q)).collect()}
    assert a == b and a


def test_multi_match_fields_alone_equal_match(docs):
    a = {r._id: round(r.score, 9) for r in plan.hits(docs, Q.MultiMatch(("text",), "the thing")).collect()}
    b = {r._id: round(r.score, 9) for r in plan.hits(docs, Q.Match("text", "the thing")).collect()}
    assert a == b


def test_no_terms_no_hits(docs):
    for q in (Q.Match("text", "?!"), Q.Phrase("text", ""), Q.MultiMatch(("text",), "...")):
        assert plan.hits(docs, q).count() == 0


def test_unindexed_fields_raise(spark):
    raw = spark.createDataFrame([("1", "a", "x y")], "_id string, k string, t string")
    index = Collection.create(spark, new_table_path(spark, "t"), raw, Mapping((Field("k", "keyword", index=False), Field("t", "text", index_options="docs"))), buckets=2)
    with pytest.raises(ValueError):
        plan.hits(index, Q.Term("k", "a"))
    with pytest.raises(ValueError):
        plan.hits(index, Q.Phrase("t", "x y"))


def test_scan_reads_only_what_it_needs(docs):
    # the ranking runs first; the page's scan reads the columns asked for
    page = R.run(docs, R.Search(must=(Q.Match("text", "thble"),), size=5, source=("lang",)))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<_id:string,lang:string>" in page and "CartesianProduct" not in page and "NestedLoop" not in page
    text = plan.hits(docs, Q.Match("text", "thble"))._jdf.queryExecution().executedPlan().toString()
    assert "term_bucket" in text and re.search(r"PartitionFilters: \[[^]]*isnotnull\(field", text)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    ranged = plan.hits(docs, Q.Range("n_chars", gte=500))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(n_chars,500)" in ranged and "Exchange" not in ranged


def test_fuzzy_plan_has_no_cross_join(docs):
    text = plan.hits(docs, Q.Match("text", "thable", fuzziness=2))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "CartesianProduct" not in text


# --- writes


def test_upsert_in_any_split_equals_one_shot(spark):
    rng = random.Random(5)
    rows = [(str(rng.randrange(8)), i, f"v{i}") for i in range(60)]
    schema = "_id string, seq int, v string"
    one = {tuple(r) for r in C.last_per_id(spark.createDataFrame(rows, schema), ["seq"]).collect()}
    for cut in (1, 20, 45):
        base = C.last_per_id(spark.createDataFrame(rows[:cut], schema), ["seq"])
        got = C.upsert(base, C.last_per_id(spark.createDataFrame(rows[cut:], schema), ["seq"]))
        assert {tuple(r) for r in got.collect()} == one


def test_missing_id_raises(spark):
    base = spark.createDataFrame([("1", "a")], "_id string, v string")
    with pytest.raises(Exception, match="_id is required"):
        C.upsert(base, spark.createDataFrame([(None, "b")], "_id string, v string")).collect()


def test_versions(spark):
    raw = spark.createDataFrame([("1", "red fox"), ("2", "blue fox"), ("3", "red hen")], "_id string, t string")
    path = new_table_path(spark, "versions")
    index = Collection.create(spark, path, raw, Mapping((Field("t", "text"),)), buckets=2)
    found = lambda ix, w: {r._id for r in plan.hits(ix, Q.Match("t", w)).collect()}
    assert found(index, "red") == {"1", "3"}
    second = index.put(spark.createDataFrame([("3", "green hen"), ("4", "red owl")], "_id string, t string"))
    assert found(second, "red") == {"1", "4"} and second.stats["t"].n_docs == 4
    third = second.delete(spark.createDataFrame([("1",)], "_id string"))
    assert found(third, "red") == {"4"}
    fourth = third.update(F.col("_id") == "2", {"t": "concat(t, params.more)"}, {"more": " red"})
    assert found(fourth, "red") == {"2", "4"}
    reopened = Collection.open(spark, path)
    assert reopened.version == 4 and found(reopened, "red") == {"2", "4"}
    assert fourth.put_mapping(fourth.mapping) is fourth
    assert found(index, "red") == {"1", "3"}


def test_dynamic_and_hidden_fields(spark):
    from textloom.sources.ingest import ingest

    raw = spark.createDataFrame([("1", "5", "x", "h"), ("2", "oops", "y", "i")], "_id string, n string, other string, secret string")
    fields = (Field("n", "integer"), Field("secret", "keyword", enabled=False))
    good, bad = ingest(raw, Mapping(fields))
    assert [r.asDict() for r in good.collect()] == [{"_id": "1", "n": 5, "_raw": '{"secret":"h","other":"x"}'}]
    assert [r._id for r in bad.collect()] == ["2"] and bad.first()._malformed == ["n"]
    assert "other" in ingest(raw, Mapping(fields, dynamic=True))[0].columns
    strict = ingest(raw, Mapping((Field("n", "integer", coerce=False, ignore_malformed=True),)))[0]
    assert [r.n for r in strict.collect()] == [None, None]


# --- skew: a third of everything shares one key


def test_batch_search_with_hot_terms_equals_brute_force(spark):
    rng = random.Random(11)
    texts = []
    for i in range(300):
        words = [f"w{rng.randrange(120)}" for _ in range(rng.randrange(1, 12))]
        if i % 3 == 0:
            words += ["hot"] * rng.randrange(1, 4)
        texts.append((str(i), " ".join(words)))
    texts += [(f"copy{i}", "same old text hot") for i in range(100)]
    asked = [(i, f"w{i} w{i + 1} hot") for i in range(15)] + [(100 + i, "hot") for i in range(5)] + [(200 + i, "w3 w7 hot hot") for i in range(5)] + [(300, "nothing here")]
    docs = spark.createDataFrame(texts, "_id string, text string")
    index = Collection.create(spark, new_table_path(spark, "hot"), docs, Mapping((Field("text", "text"),)), buckets=4)
    queries = spark.createDataFrame(asked, "query_id int, text string")
    got = {}
    for r in B.batch_search(index, queries, "text", k=4).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r._id, r._score))
    toks = {i: t.split() for i, t in texts}
    n, avg = len(toks), sum(map(len, toks.values())) / len(toks)
    df = {}
    for ws in toks.values():
        for w in set(ws):
            df[w] = df.get(w, 0) + 1
    for qid, text in asked:
        scores = {}
        for w in text.split():
            if w not in df:
                continue
            idf = math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
            for i, ws in toks.items():
                tf = ws.count(w)
                if tf:
                    scores[i] = scores.get(i, 0) + idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ws) / avg))
        best = sorted(((i, round(s, 6)) for i, s in scores.items()), key=lambda p: (-p[1], p[0]))[:4]
        assert [(i, pytest.approx(s, abs=2e-6)) for i, s in best] == got.get(qid, [])


def test_batch_search_equals_single_searches(spark):
    rng = random.Random(5)
    texts = [(str(i), " ".join(rng.choice("alpha beta gamma delta alpine gammy beth".split()) for _ in range(6)), rng.choice("xy")) for i in range(80)]
    docs = spark.createDataFrame(texts, "_id string, text string, kind string")
    mapping = Mapping((Field("text", "text", similarity="LMJelinekMercer"), Field("kind", "keyword")))
    index = Collection.create(spark, new_table_path(spark, "single"), docs, mapping, buckets=4)
    asked = [(0, "alpha gama"), (1, "beta"), (2, "delta beth alpha")]
    queries = spark.createDataFrame(asked, "query_id int, text string")
    for operator, fuzziness in (("OR", None), ("AND", None), ("OR", "AUTO"), ("AND", 1)):
        got = {}
        for r in B.batch_search(index, queries, ["text"], 5, operator, fuzziness, Q.Term("kind", "x")).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r._id, r._score))
        for i, text in asked:
            one = R.Search(must=(Q.Match("text", text, operator=operator, fuzziness=fuzziness),), filter=(Q.Term("kind", "x"),), size=5)
            assert [(r._id, pytest.approx(r._score, abs=2e-6)) for r in R.run(index, one).collect()] == got.get(i, []), (operator, fuzziness, text)


def test_page_limit_and_lost_ids():
    with pytest.raises(ValueError):
        R.Search(match_all=True, size=2001).validate()


def test_last_row_needs_an_order(spark):
    twice = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "_id string, v int")
    with pytest.raises(Exception, match="no order"):
        C.last_per_id(twice, []).collect()
    assert {tuple(r) for r in C.last_per_id(twice, ["v"]).collect()} == {("a", 2), ("b", 3)}
    assert C.last_per_id(twice.where("v > 1"), []).count() == 2


def test_create_or_evolve_and_versions(spark):
    path = new_table_path(spark, "evolve")
    docs = spark.createDataFrame([("1", "Some Text", "K")], "_id string, text string, k string")
    first = Collection.create_or_evolve(spark, path, docs, Mapping((Field("text", "text"), Field("k", "keyword"))))
    wider = Mapping((Field("text", "text", fields=(Field("raw", "keyword", normalizer="lowercase"),)), Field("k", "keyword"), Field("n", "long")))
    second = Collection.create_or_evolve(spark, path, docs.where("false"), wider)
    assert (first.version, second.version) == (1, 2) and second.docs.count() == 1 and "n" in second.docs.columns
    assert [r._id for r in R.run(second, R.Search(filter=(Q.Term("text.raw", "SOME TEXT"),))).collect()] == ["1"]
    with pytest.raises(Exception, match="exists"):
        Collection.create(spark, path, docs, wider)
    with pytest.raises(Exception, match="exists"):
        first.delete(docs.select("_id"))


def test_addresses_sort_as_numbers(spark):
    import ipaddress

    good = ["10.0.0.2", "10.0.0.10", "255.255.255.255", "0.0.0.0", "::", "::1", "1::", "2001:db8::ff00:42:8329", "2001:0db8:0000:0000:0000:ff00:0042:8329", "::ffff:10.0.0.3", "fe80::1:2:3:4", "1:2:3:4:5:6:7:8"]
    bad = ["999.1.1.1", "1.2.3", "1:2:3", ":::", "1::2::3", "12345::", "g::", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "", "10.0.0.1x", "1:2:3:4:5:6:7:"]
    rows = spark.createDataFrame([(x,) for x in good + bad], "ip string").select("ip", I.ip_key(F.col("ip")).alias("key")).collect()

    def key(text):
        address = ipaddress.ip_address(text)
        return f"{int(address) + (0xFFFF << 32 if address.version == 4 else 0):032x}"

    assert {r.ip: r.key for r in rows} == {**{x: key(x) for x in good}, **dict.fromkeys(bad)}


def test_ingest_keeps_the_source_value(spark):
    mapping = Mapping((Field("k", "keyword", ignore_above=5, null_value="none", normalizer="lowercase"), Field("a", "ip"), Field("t", "text", fields=(Field("raw", "keyword"),))))
    raw = spark.createDataFrame([("1", "TOOLONGVALUE", "10.0.0.10", "A b"), ("2", None, "10.0.0.9", "c"), ("3", "ABC", "::1", None)], "_id string, k string, a string, t string")
    index = Collection.create(spark, new_table_path(spark, "source"), I.ingest(raw, mapping)[0], mapping, buckets=4)
    found = lambda q: sorted(r._id for r in R.run(index, R.Search(filter=(q,))).collect())
    assert {r._id: r.k for r in R.run(index, R.Search(match_all=True)).collect()} == {"1": "TOOLONGVALUE", "2": None, "3": "ABC"}
    assert found(Q.Term("k", "aBc")) == ["3"] and found(Q.Term("k", "none")) == ["2"] and found(Q.Term("k", "toolongvalue")) == []
    assert found(Q.Range("a", gte="10.0.0.2", lt="10.0.0.100")) == ["1", "2"] and found(Q.Term("t.raw", "A b")) == ["1"] and found(Q.Exists("t.raw")) == ["1", "2"]


def test_completion_with_a_hot_prefix(spark):
    rng = random.Random(3)
    inputs = [(str(i), "name", ("a" if i % 3 else "b") + "".join(rng.choice("abc") for _ in range(4)), rng.randrange(50)) for i in range(400)]
    inputs += [("long", "name", "z" * 80, 1)]
    base = spark.createDataFrame(inputs, "_id string, field string, input string, weight int")
    prefixes = ["a", "A", "ab", "bca", "c", "", "z" * 70]
    asked = spark.createDataFrame([(f"s{i}", "name", p) for i, p in enumerate(prefixes)], "suggester_id string, field string, prefix string")
    got = {}
    for r in G.completions(base, asked, 5).orderBy("suggester_id", "rank").collect():
        got.setdefault(r.suggester_id, []).append(r._id)
    for i, p in enumerate(prefixes):
        if not p:
            continue
        want = [x[0] for x in sorted((x for x in inputs if x[2].startswith(p.lower())), key=lambda x: (-x[3], x[2], x[0]))[:5]]
        assert got.get(f"s{i}", []) == want


def test_hot_key_upsert(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("_id"), F.col("id").alias("seq"))
    rows = {r._id: r.seq for r in C.last_per_id(df, ["seq"]).collect()}
    assert rows["hot"] == 2997 and len(rows) == 2001
    text = C.last_per_id(df, ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in text


def test_a_change_writes_its_batch_only(spark):
    path = new_table_path(spark, "segments")
    texts = [(str(i), f"word{i} common", i) for i in range(300)]
    index = Collection.create(spark, path, spark.createDataFrame(texts, "_id string, text string, n int"), Mapping((Field("text", "text"), Field("n", "integer"))), buckets=4)
    plain = dict((i, (t, n)) for i, t, n in texts)
    batch = [("5", "new words", 5000), ("900", "common new", 900)]
    index = index.put(spark.createDataFrame(batch, "_id string, text string, n int"))
    plain |= {i: (t, n) for i, t, n in batch}
    assert spark.read.parquet(f"{path}/docs/v=2").count() == 2 and spark.read.parquet(f"{path}/forward/v=2").count() == 2
    index = index.delete(spark.createDataFrame([("6",), ("none",)], "_id string"))
    del plain["6"]
    index = index.update(F.col("n") < 3, {"text": "concat(text, ' changed')"})
    plain |= {i: (t + " changed", n) for i, (t, n) in plain.items() if n < 3}
    index = index.put(spark.createDataFrame([("6", "back again", 6)], "_id string, text string, n int"))
    plain["6"] = ("back again", 6)
    for state in (index, Collection.open(spark, path), index.compact()):
        assert {r._id: (r.text, r.n) for r in state.docs.collect()} == plain
        count = {}
        for t, _ in plain.values():
            for w in set(t.split()):
                count[w] = count.get(w, 0) + 1
        assert {r.token: r.df for r in state.vocabulary("text").collect()} == count
        assert state.stats["text"].n_docs == len(plain) and state.stats["text"].n_tokens == sum(len(t.split()) for t, _ in plain.values())
        found = lambda w: sorted(r._id for r in plan.hits(state, Q.Match("text", w)).collect())
        for w in ("changed", "new", "word5", "word6", "back"):
            assert found(w) == sorted(i for i, (t, _) in plain.items() if w in t.split())
    assert state.base == state.version == 6


def test_texts_are_analyzed_once_and_pairs_are_not_shuffled(spark):
    docs = spark.createDataFrame([(str(i), f"alpha w{i % 7} beta") for i in range(40)] + [("none", None), ("empty", "")], "_id string, text string")
    for options in ("positions", "docs"):
        fields = C.text_fields(Mapping((Field("text", "text", index_options=options),)), A.AnalysisSettings())
        forward = C.forward_table(docs, fields)
        assert forward._jdf.queryExecution().executedPlan().toString().count("regexp_extract_all(") == 1
        found = {r["_id"]: r for r in forward.collect()}
        assert "none" not in found and found["empty"]["dl"] == 0 and found["empty"]["terms"] == [] and found["3"]["dl"] == 3 and len(found["3"]["terms"]) == 3
    index = Collection.create(spark, new_table_path(spark, "dealt"), docs, Mapping((Field("text", "text"),)), buckets=4)
    queries = spark.createDataFrame([(i, f"alpha w{i}") for i in range(9)] + [(9, "alpha w0"), (10, "nothing")], "query_id int, text string")
    found = B.batch_search(index, queries, "text", k=3)
    plan_text = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\(query_id#\d+L?, _id", plan_text)
    best = {}
    for r in found.orderBy("query_id", "rank").collect():
        best.setdefault(r["query_id"], []).append(r["_id"])
    assert sorted(best) == list(range(10)) and best[0] == best[9] == ["0", "14", "21"] and best[3] == ["10", "17", "24"]
