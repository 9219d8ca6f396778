"""Versions of a collection: publication, recovery, order of writes, and what a read touches."""

import random
import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from textloom.operators.analyzers import AnalysisSettings
from textloom.plans import compile as plan, queries as Q, search as R
from textloom.plans.mapping import Field, Mapping
from textloom.session import new_table_path
from textloom.sources import collection as C, versions
from textloom.sources.collection import Collection
from textloom.streaming import jobs

TEXT = Mapping((Field("text", "text"), Field("n", "integer")))
SCHEMA = "_id string, text string, n int"


def make(spark, rows, name="made", **options):
    return Collection.create(spark, new_table_path(spark, name), spark.createDataFrame(rows, SCHEMA), TEXT, buckets=4, **options)


def state(index):
    """Everything a reader can see, from documents and from each index table."""
    docs = {r["_id"]: (r["text"], r["n"]) for r in index.docs.collect()}
    words = {r["token"]: (r["df"], r["ttf"]) for r in index.vocabulary("text").collect()}
    postings = sorted((r["token"], r["_id"], r["tf"]) for r in index.postings("text").collect())
    forward = sorted((r["_id"], r["dl"]) for r in index.forward.where("field = 'text'").collect())
    totals = index.stats.get("text")
    return docs, words, postings, forward, (totals.n_docs, totals.n_tokens) if totals else (0, 0)


def expected(docs):
    words, postings, forward = {}, [], []
    for i, (text, _) in docs.items():
        tokens = text.split()
        forward.append((i, len(tokens)))
        for t in set(tokens):
            n = tokens.count(t)
            postings.append((t, i, n))
            words[t] = (words.get(t, (0, 0))[0] + 1, words.get(t, (0, 0))[1] + n)
    return docs, words, sorted(postings), sorted(forward), (len(docs), sum(n for _, n in forward))


def dying_after(monkeypatch, table):
    """Writes that fail once a given table has been written."""
    whole = C.Draft.write

    def write(self, rows, name, *partitions, **options):
        out = whole(self, rows, name, *partitions, **options)
        if name == table:
            raise RuntimeError("killed")
        return out

    monkeypatch.setattr(C.Draft, "write", write)


def test_a_put_killed_after_any_table_changes_nothing(spark, monkeypatch):
    plain = {"1": ("red fox", 1), "2": ("blue fox", 2)}
    index = make(spark, [(i, t, n) for i, (t, n) in plain.items()])
    ghost = spark.createDataFrame([("ghost", "red ghost", 9), ("1", "ghost", 9)], SCHEMA)
    for table in ("docs", "forward", "postings", "vocabulary", "field_stats", "gone", "marks"):
        with monkeypatch.context() as m:
            dying_after(m, table)
            with pytest.raises(RuntimeError, match="killed"):
                index.put(ghost, ["n"])
        assert Collection.open(spark, index.path).version == 1
    assert state(Collection.open(spark, index.path)) == expected(plain)
    index = Collection.open(spark, index.path).put(spark.createDataFrame([("2", "green owl", 3)], SCHEMA), ["n"])
    index = index.delete(spark.createDataFrame([("1",)], "_id string"))
    assert state(Collection.open(spark, index.path)) == expected({"2": ("green owl", 3)})
    assert state(index.compact()) == expected({"2": ("green owl", 3)}) and index.get("ghost").isEmpty()


def test_a_killed_create_or_publication_can_be_repeated(spark, monkeypatch):
    path, docs = new_table_path(spark, "again"), spark.createDataFrame([("1", "a b", 1)], SCHEMA)
    with monkeypatch.context() as m:
        dying_after(m, "vocabulary")
        with pytest.raises(RuntimeError, match="killed"):
            Collection.create(spark, path, docs, TEXT, buckets=4)
    assert not C.exists(spark, path)
    with pytest.raises(ValueError, match="no collection"):
        Collection.open(spark, path)
    index = Collection.create(spark, path, docs, TEXT, buckets=4)
    pending = index.prepare_put(spark.createDataFrame([("2", "c", 2)], SCHEMA))
    assert state(Collection.open(spark, path)) == expected({"1": ("a b", 1)})
    assert state(pending.publish()) == expected({"1": ("a b", 1), "2": ("c", 2)})
    with pytest.raises(versions.VersionExists):
        pending.publish()
    with pytest.raises(versions.VersionExists):
        Collection.create(spark, path, docs, TEXT, buckets=4)


def test_of_many_writers_of_a_version_one_succeeds(spark):
    index = make(spark, [("0", "a", 0)])
    ready = [index.prepare_put(spark.createDataFrame([(str(i), f"w{i}", i)], SCHEMA)) for i in range(1, 5)]

    def attempt(p):
        try:
            return p.publish().version
        except versions.VersionExists:
            return None

    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(attempt, ready))
    assert sorted(map(str, got)) == ["2", "None", "None", "None"]
    winner = got.index(2) + 1
    assert state(Collection.open(spark, index.path)) == expected({"0": ("a", 0), str(winner): (f"w{winner}", winner)})


def test_writers_at_one_moment_leave_a_whole_version(spark, tmp_path):
    """Many rounds: one writer wins, and the version that stands is the winner's."""

    def attempt(path, k):
        try:
            versions.publish(spark, path, 1, {"writer": k, "text": "x" * 2000 * k})
            return k
        except versions.VersionExists:
            return None

    with ThreadPoolExecutor(8) as pool:
        for turn in range(100):
            path = str(tmp_path / str(turn))
            (tmp_path / str(turn) / "meta").mkdir(parents=True)
            won = [k for k in pool.map(lambda k, path=path: attempt(path, k), range(1, 9)) if k]
            assert [versions.read(spark, path, 1)["writer"]] == won and versions.newest(spark, path) == 1


def test_bulk_put_changes_all_targets_or_none(spark, monkeypatch):
    targets = {n: make(spark, [], n) for n in ("a", "b")}
    batch = spark.createDataFrame([("a", "1", "x", 1), ("b", "2", "y", 2)], "_index string, " + SCHEMA)
    real, calls = Collection.prepare_put, []

    def second_fails(self, *args, **options):
        calls.append(self)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return real(self, *args, **options)

    with monkeypatch.context() as m:
        m.setattr(Collection, "prepare_put", second_fails)
        with pytest.raises(RuntimeError, match="killed"):
            C.bulk_put(targets, batch)
    assert all(Collection.open(spark, c.path).version == 1 for c in targets.values())
    targets["b"].put(spark.createDataFrame([("9", "other", 9)], SCHEMA))
    with pytest.raises(versions.VersionExists, match="no target"):
        C.bulk_put(targets, batch)
    assert Collection.open(spark, targets["a"].path).version == 1
    done = C.bulk_put({n: Collection.open(spark, c.path) for n, c in targets.items()}, batch)
    assert {n: sorted(r["_id"] for r in c.docs.collect()) for n, c in done.items()} == {"a": ["1"], "b": ["2", "9"]}


# --- the order of writes


def test_ordered_writes_in_any_delivery_equal_the_last_of_all(spark):
    rng = random.Random(4)
    rows = [(str(rng.randrange(9)), f"word{i} {rng.choice('abc')}", i) for i in range(60)]
    rng.shuffle(rows)
    plain = {}
    for i, t, n in sorted(rows, key=lambda r: r[2]):
        plain[i] = (t, n)
    index = make(spark, [])
    for k in range(4):
        index = index.put(spark.createDataFrame(rows[15 * k : 15 * k + 15], SCHEMA), ["n"])
        if k == 1:
            index = index.compact()
    assert state(index) == expected(plain)
    version = index.version
    assert index.put(spark.createDataFrame(rows, SCHEMA), ["n"]).version == version


def test_late_rows_after_deletions_and_plain_writes(spark):
    put = lambda ix, i, t, n: ix.put(spark.createDataFrame([(i, t, n)], SCHEMA), ["n"])
    ids = lambda i, n: spark.createDataFrame([(i, n)], "_id string, n int")
    index = put(make(spark, [("a", "start", 0)]), "a", "five", 5)
    index = index.delete(ids("a", 3), ["n"])
    assert state(index) == expected({"a": ("five", 5)})  # a late deletion
    index = index.delete(ids("a", 7), ["n"])
    assert state(put(index, "a", "six", 6)) == expected({})  # older than the deletion
    assert put(index, "a", "six", 6) is index
    index = put(index, "a", "eight", 8)
    assert state(index) == expected({"a": ("eight", 8)})
    index = index.put(spark.createDataFrame([("a", "plain", 1)], SCHEMA))  # counts, and forgets the order
    index = put(index, "a", "two", 2)
    assert state(index) == expected({"a": ("two", 2)})
    with pytest.raises(ValueError, match="ordered by"):
        index.put(spark.createDataFrame([("a", "x", 1)], SCHEMA), ["text"])


def test_a_batch_of_a_feed_is_put_once(spark):
    index = make(spark, [])
    batch = spark.createDataFrame([("a", "one", 1)], SCHEMA)
    index = index.put(batch, ["n"], source="feed", number=0)
    assert index.put(spark.createDataFrame([("a", "other", 9)], SCHEMA), ["n"], source="feed", number=0) is index
    late = index.put(spark.createDataFrame([("a", "late", 0)], SCHEMA), ["n"], source="feed", number=1)
    assert late.version == index.version + 1 and late.meta["parts"] == index.meta["parts"]
    again = Collection.open(spark, index.path)
    assert again.put(batch, ["n"], source="feed", number=1) is again and state(again) == expected({"a": ("one", 1)})
    assert again.put(batch.withColumn("n", F.lit(4)), ["n"], source="second", number=0).version == again.version + 1


def test_stream_restart_after_a_dead_batch(spark, monkeypatch):
    feed, log = new_table_path(spark, "feed"), new_table_path(spark, "feed-log")
    events = [("a", "new", 9), ("b", "b1", 1)], [("a", "old", 5), ("b", "b2", 2)], [("a", "older", 1), ("c", "c1", 3)]
    for rows in events:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(feed)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(feed)
    index = make(spark, [])
    with monkeypatch.context() as m:
        dying_after(m, "gone")
        with pytest.raises(Exception, match="killed"):
            jobs.upsert_index_stream(stream, index.path, log, ["n"]).awaitTermination()
    assert Collection.open(spark, index.path).version == 1
    jobs.upsert_index_stream(stream, index.path, log, ["n"]).awaitTermination()
    assert state(Collection.open(spark, index.path)) == expected({"a": ("new", 9), "b": ("b2", 2), "c": ("c1", 3)})


# --- what a read touches


def scans(df):
    """``(table, rows read)`` of every file scan of a frame that is run to its end."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if name.startswith("Scan parquet"):
            place = node.relation().location().rootPaths().apply(0).toString()
            found.append((place.split("/v=")[0].rsplit("/", 1)[1], node.metrics().get("numOutputRows").get().value()))
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


@pytest.fixture(scope="module")
def large(spark):
    """30,000 documents in many row groups, with terms of a common and of rare prefixes."""
    word = F.concat(F.lit("w"), F.lpad((F.col("id") * 7919 % 30_000).cast("string"), 5, "0"))
    docs = spark.range(30_000).select(F.sha1(F.col("id").cast("string")).alias("_id"), F.concat(word, F.lit(" common")).alias("text"), F.col("id").cast("int").alias("n"))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", str(64 * 1024))
    conf.set("parquet.page.size", str(8 * 1024))
    conf.set("parquet.block.size.row.check.min", "10")
    try:
        return Collection.create(spark, new_table_path(spark, "large"), docs.repartition(4), TEXT, buckets=4)
    finally:
        for k in ("parquet.block.size", "parquet.page.size", "parquet.block.size.row.check.min"):
            conf.unset(k)


def test_a_page_reads_its_documents_only(spark, large):
    got = R.run(large, R.Search(must=(Q.Match("text", "w00042 w00043"),), size=5))
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(_id" in text or "In(_id" in text.split("PushedFilters")[1]
    assert got.count() == 2 and sum(n for t, n in scans(got) if t == "docs") < 3000
    by_column = R.run(large, R.Search(filter=(Q.Range("n", lt=20_000),), sort=(("n", "desc"),), size=3))
    assert [r["n"] for r in by_column.collect()] == [19_999, 19_998, 19_997]
    assert sum(n for t, n in scans(by_column) if t == "docs") < 6000
    assert R.run(large, R.Search(must=(Q.Match("text", "nothing"),))).count() == 0


def test_a_prefix_reads_its_terms_only(spark, large):
    assert sum(n for t, n in scans(large.vocabulary("text", prefix="w0004")) if t == "vocabulary") < 6000
    for query in (Q.Prefix("text", "w0004"), Q.PhrasePrefix("text", "w00042 com"), Q.MultiMatch(("text",), "common w0004", "bool_prefix")):
        text = plan.hits(large, query)._jdf.queryExecution().executedPlan().toString()
        reads = [line for line in text.split("\n") if "FileScan" in line and "term_bucket#" in line and "_id#" in line]
        assert reads and all(re.search(r"PartitionFilters: \[[^]]*term_bucket", line) for line in reads)
    rows = [n for t, n in scans(large.prefix_postings("text", "w0004")) if t == "postings"]
    assert sum(rows) < 12_000
    assert plan.hits(large, Q.Prefix("text", "w0004")).count() == 10
    # more terms than are named one by one
    assert plan.hits(large, Q.Prefix("text", "w0")).count() == 10_000 and plan.hits(large, Q.Prefix("text", "x")).count() == 0


def test_a_transformed_read_stops_when_it_is_filled(spark, large):
    seen = spark.sparkContext.accumulator(0)

    def odd(df):
        def count(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b

        return df.mapInArrow(count, df.schema).where("n % 2 = 1").select("_id", "n")

    request = R.Search(filter=(Q.Range("n", gte=0),), sort=(("n", "desc"),))
    assert [r["n"] for r in R.transformed(large, request, odd, 5).collect()] == [29_999, 29_997, 29_995, 29_993, 29_991]
    assert seen.value <= 25  # a step of 5 and one of 20
    rare = lambda df: df.where("n % 10000 = 7").select("_id", F.explode(F.array("n", F.lit(1))).alias("n"))
    assert [r["n"] for r in R.transformed(large, request, rare, 4).collect()] == [1, 20_007, 1, 10_007]
    assert [r["n"] for r in R.transformed(large, request, rare, 50).collect()] == [1, 20_007, 1, 10_007, 1, 7]
    none = R.transformed(large, R.Search(filter=(Q.Range("n", lt=0),), sort=(("n", "asc"),)), odd, 5)
    assert none.columns == ["_id", "n"] and none.isEmpty()
    third = R.Search(filter=(Q.Range("n", lt=9),), sort=(("n", "asc"),), from_=3)
    assert [r["n"] for r in R.transformed(large, third, odd, 2).collect()] == [3, 5]


def test_a_change_reads_the_terms_of_its_documents_only(spark, large, monkeypatch):
    read = []
    real = C.P.vocabulary
    monkeypatch.setattr(C.P, "vocabulary", lambda forward, buckets: (read.append(forward), real(forward, buckets))[1])
    large.prepare_put(large.docs.orderBy("n").limit(2))
    assert sum(n for t, n in scans(read[0]) if t == "forward") < 6000


def test_a_new_field_writes_its_own_tables_only(spark):
    index = make(spark, [("1", "red fox", 1), ("2", "blue fox", 2)]).delete(spark.createDataFrame([("2",)], "_id string"))
    settings = AnalysisSettings(analyzer={"back": {"type": "custom", "tokenizer": "standard", "filter": ["lowercase", "reverse"]}})
    wider = Mapping((Field("text", "text", fields=(Field("back", "text", analyzer="back"),)), Field("n", "integer"), Field("note", "keyword")))
    evolved = index.put_mapping(wider, settings)
    made = lambda t: evolved.meta["parts"][t][len(index.meta["parts"][t]) :]
    assert not made("docs") and not made("gone") and len(made("postings")) == len(made("forward")) == 1
    new = spark.read.parquet(f"{index.path}/postings/v={evolved.version}")
    assert {(r["field"], r["token"]) for r in new.collect()} == {("text.back", "der"), ("text.back", "xof")}
    assert state(evolved) == expected({"1": ("red fox", 1)}) and evolved.docs.columns == ["_id", "text", "n", "note"]
    found = lambda ix, f, w: sorted(r["_id"] for r in plan.hits(ix, Q.Match(f, w, analyzer="back" if f != "text" else None)).collect())
    later = evolved.put(spark.createDataFrame([("3", "red hen", 3), ("1", "red cat", 4)], SCHEMA))
    assert found(later, "text.back", "red") == ["1", "3"] and found(later, "text.back", "fox") == [] and found(later, "text", "hen") == ["3"]
    # another analysis of the same field: rows from before no longer count
    other = AnalysisSettings(analyzer={"back": {"type": "custom", "tokenizer": "standard", "filter": ["lowercase"]}})
    again = later.put_settings(other)
    for reader in (again, again.compact()):
        assert {r["token"]: r["df"] for r in reader.vocabulary("text.back").collect()} == {"red": 2, "hen": 1, "cat": 1}
        assert reader.stats["text.back"].n_docs == 2 and sorted(r["token"] for r in reader.postings("text.back").collect()) == ["cat", "hen", "red", "red"]
        assert state(reader) == expected({"3": ("red hen", 3), "1": ("red cat", 4)})


def test_values_of_any_spelling_are_looked_up(spark):
    odd = ["it's", 'a "b"', "back\\slash", "ü🙂", "", "x y", "%_", "\n"]
    index = make(spark, [(v, f"word{i}", i) for i, v in enumerate(odd)])
    assert sorted(r["_id"] for r in index.fetch(odd + ["none"]).collect()) == sorted(odd) and index.fetch([]).isEmpty()
    assert [r["_id"] for r in R.run(index, R.Search(match_all=True, size=20, sort=(("n", "asc"),))).collect()] == odd
