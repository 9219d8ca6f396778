"""Streaming jobs, each run to the end of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textloom.catalog.common import STD_LOW, register, table
from textloom.operators import analyzers as A
from textloom.operators.scoring import union_all
from textloom.plans import queries as Q, search as R
from textloom.plans.mapping import Field, Mapping
from textloom.session import new_table_path
from textloom.sources.collection import Collection
from textloom.streaming import jobs, percolate

SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def feed(spark, sf, name: str, parts: int, late: bool = False) -> DataFrame:
    """The events as a stream that arrives in several deliveries, one after the other.

    With ``late`` each delivery holds events of all times, so most of a later one are old.
    """
    path = new_table_path(spark, name)
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    step = -(-(events.agg(F.max("event_id")).first()[0] + 1) // parts)
    for i in range(parts):
        here = F.col("event_id") % parts == i if late else (F.col("event_id") >= i * step) & (F.col("event_id") < (i + 1) * step)
        events.where(here).write.mode("append").parquet(path)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


_LAST = "SELECT CAST(user_id AS VARCHAR) AS _id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) x WHERE r = 1"


@register("stream_upsert", _LAST)
def stream_upsert(spark, sf):
    stream = feed(spark, sf, "feed", 3).withColumn("_id", F.col("user_id").cast("string"))
    path, log = new_table_path(spark, "changes"), new_table_path(spark, "changes-log")
    jobs.upsert_stream(stream, path, log, ["ts", "event_id"]).awaitTermination()
    state = jobs.current_state(spark.read.parquet(path), ["ts", "event_id"])
    return state.select("_id", "event_id", "event_type", "value")


def _to_table(spark, df: DataFrame, name: str) -> DataFrame:
    """Run a stream to its end into a table."""
    path, log = new_table_path(spark, name), new_table_path(spark, name + "-log")
    df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", log).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


@register(
    "stream_tokens",
    """WITH t AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS start, unnest(regexp_extract_all(event_type || ' ' || props, '[\\p{L}\\p{N}]+')) AS token FROM events)
    SELECT start, token, count(*) AS n FROM t WHERE start + INTERVAL '1 hour' <= (SELECT max(ts) - INTERVAL '10 minutes' FROM events) GROUP BY 1, 2""",
)
def stream_tokens(spark, sf):
    """Windows that the watermark has closed; the last ones stay open."""
    stream = feed(spark, sf, "tokens", 3).withColumn("text", F.concat_ws(" ", "event_type", "props"))
    counts = jobs.token_counts(stream, "text", A.standard(), "ts")
    return _to_table(spark, counts, "token-counts").select(F.col("start").cast("timestamp_ntz").alias("start"), "token", "n")


@register("stream_match", "SELECT event_id, event_type, value FROM events WHERE event_type IN ('error', 'click') AND value >= 5 AND value < 50 AND NOT starts_with(props, '{\"k\": 1')")
def stream_match(spark, sf):
    query = Q.Bool(filter=(Q.Term("event_type", ["error", "click"]), Q.Range("value", gte=5.0, lt=50.0)), must_not=(Q.Prefix("props", '{"k": 1'),))
    found = jobs.standing_query(feed(spark, sf, "match", 3), query)
    return _to_table(spark, found.select("event_id", "event_type", "value"), "matches")


@register("stream_upsert_index", f"SELECT _id, event_id, event_type FROM ({_LAST}) l WHERE event_type = 'click'")
def stream_upsert_index(spark, sf):
    """A stream of documents into a collection, which is then searched. Each delivery brings late events."""
    start = table(spark, sf, "events").limit(0).select(F.lit("").alias("_id"), "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    mapping = Mapping((Field("event_id", "long"), Field("ts", "date"), Field("event_type", "text")))
    path = new_table_path(spark, "fed-index")
    Collection.create(spark, path, start, mapping, buckets=4)
    stream = feed(spark, sf, "index-feed", 3, late=True).select(F.col("user_id").cast("string").alias("_id"), "event_id", "ts", "event_type")
    jobs.upsert_index_stream(stream, path, new_table_path(spark, "fed-log"), ["ts", "event_id"]).awaitTermination()
    found = R.matched(Collection.open(spark, path), R.Search(must=(Q.Match("event_type", "click"),)))
    return found.select("_id", "event_id", "event_type")


@register(
    "stream_replay",
    f"SELECT _id, event_id, event_type, n FROM ({_LAST}) l JOIN (SELECT event_type AS t, count(*) AS n FROM ({_LAST}) m GROUP BY 1) c ON l.event_type = c.t",
)
def stream_replay(spark, sf):
    """The same feed twice, the second time without the memory of its first run: nothing is added."""
    start = table(spark, sf, "events").limit(0).select(F.lit("").alias("_id"), "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    mapping = Mapping((Field("event_id", "long"), Field("ts", "date"), Field("event_type", "text")))
    path = new_table_path(spark, "replayed")
    Collection.create(spark, path, start, mapping, buckets=4)
    stream = feed(spark, sf, "replay-feed", 2, late=True).select(F.col("user_id").cast("string").alias("_id"), "event_id", "ts", "event_type")
    seen = []
    for log in ("replay-a", "replay-b"):
        jobs.upsert_index_stream(stream, path, new_table_path(spark, log), ["ts", "event_id"], source="events").awaitTermination()
        seen.append(Collection.open(spark, path).version)
    if seen[0] != seen[1]:
        raise AssertionError(f"the second run wrote versions: {seen}")
    index = Collection.open(spark, path)
    # the frequency of a word tells whether any replaced document still counts
    words = index.vocabulary("event_type").select(F.col("token"), F.col("df").alias("n"))
    return index.docs.join(words, F.col("event_type") == F.col("token")).select("_id", "event_id", "event_type", "n")


# words 1 to 3 in a row; 4 and 5 both; 6 or 7 in English documents of some length without word 2; 8 to 10 together or word 11
_STORED = f"""w AS (SELECT item_id, {STD_LOW} AS l FROM benchmark),
  d AS (SELECT CAST(doc_id AS VARCHAR) AS _id, lang, n_chars, {STD_LOW} AS l FROM documents),
  t AS (SELECT _id, unnest(l) AS token, generate_subscripts(l, 1) AS p FROM d),
  h AS (SELECT DISTINCT _id, token FROM t),
  k AS (SELECT item_id, generate_subscripts(l, 1) AS i, unnest(l) AS token FROM w),
  m AS (SELECT DISTINCT k.item_id, k.i, h._id FROM k JOIN h USING (token) WHERE k.i <= 11),
  ph AS (SELECT DISTINCT a.item_id, x._id FROM k a JOIN k b ON b.item_id = a.item_id AND b.i = 2 JOIN k c ON c.item_id = a.item_id AND c.i = 3
         JOIN t x ON x.token = a.token JOIN t y ON y._id = x._id AND y.p = x.p + 1 AND y.token = b.token JOIN t z ON z._id = x._id AND z.p = x.p + 2 AND z.token = c.token WHERE a.i = 1)"""


@register(
    "stream_percolate",
    f"""WITH {_STORED}
    SELECT _id, 'phrase' || item_id AS query_id FROM ph
    UNION ALL SELECT _id, 'both' || item_id FROM m WHERE i IN (4, 5) GROUP BY _id, item_id HAVING count(*) = 2
    UNION ALL SELECT DISTINCT m._id, 'bool' || item_id FROM m JOIN d USING (_id) WHERE i IN (6, 7) AND lang = 'en' AND n_chars >= 400 AND n_chars < 4000 AND (item_id, _id) NOT IN (SELECT (item_id, _id) FROM m WHERE i = 2)
    UNION ALL SELECT _id, 'either' || item_id FROM m WHERE i BETWEEN 8 AND 11 GROUP BY _id, item_id HAVING count(*) FILTER (WHERE i <= 10) = 3 OR count(*) FILTER (WHERE i = 11) = 1""",
)
def stream_percolate(spark, sf):
    """Four stored queries for each benchmark text, met by a stream of all documents."""
    words = F.transform(A.standard().array(F.col("text")), lambda t: t["token"])
    some = lambda first, last: F.array_join(F.slice("l", first, last - first + 1), " ")
    c = percolate.clause
    asked = {
        "phrase": [c("must", "phrase", "text", some(1, 3))],
        "both": [c("must", "match", "text", some(4, 5), every=True)],
        "bool": [c("must", "match", "text", some(6, 7)), c("must", "term", "lang", "en"), c("must", "range", "n_chars", gte=400.0, lt=4000.0), c("must_not", "match", "text", some(2, 2))],
        "either": [c("should", "match", "text", some(8, 10), every=True), c("should", "match", "text", some(11, 11))],
    }
    items = table(spark, sf, "benchmark").select("item_id", words.alias("l"))
    rows = [items.select(F.concat(F.lit(name), "item_id").alias("query_id"), F.array(*clauses).alias("clauses")) for name, clauses in asked.items()]
    mapping = Mapping((Field("text", "text"), Field("lang", "keyword"), Field("n_chars", "long")))
    standing = percolate.store(union_all(rows), mapping)
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("_id"), "text", "lang", "n_chars")
    path = new_table_path(spark, "documents-feed")
    docs.repartition(3, "_id").write.parquet(path)
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(path)
    found = new_table_path(spark, "percolated")
    percolate.percolate_stream(stream, standing, found, new_table_path(spark, "percolated-log")).awaitTermination()
    return spark.read.schema("_id string, query_id string, batch int").parquet(found).drop("batch")
