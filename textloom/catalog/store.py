"""Writes, schema evolution and typed ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.catalog import sqlscore as S
from textloom.catalog.common import STD_LOW, q, register, sql_tokens, table
from textloom.catalog.indexes import DOCUMENTS, ORDERS, index_for, orders
from textloom.functions.dates import parse_date
from textloom.operators.analyzers import AnalysisSettings
from textloom.plans import compile as plan, queries as Q, search as R
from textloom.plans.mapping import Field, Mapping
from textloom.session import new_table_path, spread
from textloom.sources import collection as C, ingest as I
from textloom.sources.collection import Collection

_EVENT = "SELECT CAST(user_id AS VARCHAR) AS _id, event_id, event_type, value, ts FROM events"


def events(spark, sf):
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("_id"), "event_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts")
    )


def latest(df):
    return C.last_per_id(df, ["ts", "event_id"])


@register("get_by_id", f"WITH {S.DOCS} SELECT _id, lang, source, n_chars, weight FROM wd WHERE _id IN ('17', '170', '99') OR _id IN (SELECT CAST(item_id * 7 AS VARCHAR) FROM benchmark)")
def get_by_id(spark, sf):
    index = index_for(spark, sf, "documents")
    cols = ["_id", "lang", "source", "n_chars", "weight"]
    one = [index.get(i).select(*cols) for i in ("17", "170", "99")]
    many = index.get_many(table(spark, sf, "benchmark").select((F.col("item_id") * 7).cast("string").alias("_id"))).select(*cols)
    return one[0].union(one[1]).union(one[2]).union(many).distinct()


_PUT = "SELECT _id, o_custkey, o_orderstatus, o_totalprice FROM (SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_custkey, o_orderstatus, o_totalprice FROM orders) o WHERE _id <> '7' UNION ALL SELECT '7', 1, 'X', 0.5"


@register("put_document", _PUT)
def put_document(spark, sf):
    one = spark.sql("SELECT '7' AS _id, 1L AS o_custkey, 'X' AS o_orderstatus, 0.5D AS o_totalprice, TIMESTAMP '2000-01-01' AS o_orderdate, 'x' AS o_orderpriority")
    changed = _copy(spark, sf, index_for(spark, sf, "orders"), "put").put(one)
    return changed.docs.select("_id", "o_custkey", "o_orderstatus", "o_totalprice")


_LAST = "SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY _id ORDER BY ts DESC, event_id DESC) AS r FROM ({src}) e) x WHERE r = 1"


@register(
    "bulk_upsert",
    f"""WITH e AS ({_EVENT}), base AS ({_LAST.format(src='SELECT * FROM e WHERE event_id % 3 = 0')}), batch AS ({_LAST.format(src='SELECT * FROM e WHERE event_id % 3 <> 0')})
    SELECT 'events_' || (CAST(_id AS BIGINT) % 2) AS _index, * FROM (SELECT * FROM base WHERE _id NOT IN (SELECT _id FROM batch) UNION ALL SELECT * FROM batch) u""",
)
def bulk_upsert(spark, sf):
    """Documents of several indexes at once: the target is a column and part of the key."""
    df = events(spark, sf).withColumn("_index", F.concat(F.lit("events_"), (F.col("_id").cast("bigint") % 2).cast("string")))
    keys = ("_index", "_id")
    last = lambda part: C.last_per_id(df.where(part), ["ts", "event_id"], keys)
    return C.upsert(last(F.col("event_id") % 3 == 0), last(F.col("event_id") % 3 != 0), keys)


@register("bulk_upsert_collection", f"WITH {S.field('f')}, b AS (SELECT CAST(item_id * 11 AS VARCHAR) AS _id, text FROM benchmark), u AS (SELECT _id, text FROM b UNION ALL SELECT CAST(doc_id AS VARCHAR), text FROM documents WHERE CAST(doc_id AS VARCHAR) NOT IN (SELECT _id FROM b)), {S.field('g', source='u', _id='_id')} {S.hits(S.match('g', ['thble', 'the']))}")
def bulk_upsert_collection(spark, sf):
    """Search after a bulk write: only the batch is analyzed again."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("_id"), "text")
    index = Collection.create(spark, new_table_path(spark, "upsert"), docs, Mapping((Field("text", "text"),)), buckets=4)
    batch = table(spark, sf, "benchmark").select((F.col("item_id") * 11).cast("string").alias("_id"), "text")
    return plan.hits(index.put(batch), Q.Match("text", "thble the")).select("_id", F.round("score", 6).alias("_score"))


@register(
    "interrupted_write",
    f"WITH {S.field('f')}, b AS (SELECT CAST(item_id * 11 AS VARCHAR) AS _id, text FROM benchmark), u AS (SELECT _id, text FROM b UNION ALL SELECT CAST(doc_id AS VARCHAR), text FROM documents WHERE CAST(doc_id AS VARCHAR) NOT IN (SELECT _id FROM b)), "
    f"v AS (SELECT * FROM u WHERE _id NOT IN (SELECT CAST(item_id * 13 AS VARCHAR) FROM benchmark)), {S.field('g', source='v', _id='_id')} {S.hits(S.match('g', ['thble', 'the']))}",
)
def interrupted_write(spark, sf):
    """A put that dies before its last table, then a put and a delete: nothing of the dead one is seen."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("_id"), "text")
    index = Collection.create(spark, new_table_path(spark, "interrupted"), docs, Mapping((Field("text", "text"),)), buckets=4)
    items = table(spark, sf, "benchmark")
    ghosts = items.select(F.concat(F.lit("ghost"), "item_id").alias("_id"), F.lit("thble the thble").alias("text"))
    index.prepare_put(ghosts)  # all tables are written, and no version is published
    batch = items.select((F.col("item_id") * 11).cast("string").alias("_id"), "text")
    gone = items.select((F.col("item_id") * 13).cast("string").alias("_id"))
    after = Collection.open(spark, index.path).put(batch).delete(gone)
    return plan.hits(after, Q.Match("text", "thble the")).select("_id", F.round("score", 6).alias("_score"))


@register("scripted_update", "SELECT CAST(o_orderkey AS VARCHAR) AS _id, CASE WHEN o_orderstatus = 'P' THEN round(o_totalprice * 1.25, 4) ELSE o_totalprice END AS o_totalprice, CASE WHEN o_orderstatus = 'P' THEN concat(o_orderpriority, '!') ELSE o_orderpriority END AS o_orderpriority FROM orders")
def scripted_update(spark, sf):
    changed = _copy(spark, sf, index_for(spark, sf, "orders"), "update").update(
        F.col("o_orderstatus") == "P",
        {"o_totalprice": "round(o_totalprice * params.factor, 4)", "o_orderpriority": "concat(o_orderpriority, params.mark)"}, {"factor": 1.25, "mark": "!"},
    )
    return changed.docs.select("_id", "o_totalprice", "o_orderpriority")


@register("delete_docs", "SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_totalprice FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')")
def delete_docs(spark, sf):
    """Delete by a table of keys, here the orders of one market segment."""
    segment = table(spark, sf, "customer").where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("o_custkey"))
    index = index_for(spark, sf, "orders")
    gone = index.docs.join(segment, "o_custkey", "left_semi").select("_id")
    return _copy(spark, sf, index, "delete").delete(gone).docs.select("_id", "o_totalprice")


@register("create_sorted", "SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_totalprice FROM orders WHERE o_orderdate >= DATE '1996-03-01' AND o_orderdate < DATE '1996-04-01'")
def create_sorted(spark, sf):
    """A collection sorted by date on disk; the range skips row groups."""
    return index_for(spark, sf, "orders").docs.where("o_orderdate >= '1996-03-01' AND o_orderdate < '1996-04-01'").select("_id", "o_totalprice")


_PART_FIELDS = (
    ("p_name", "text", None, "p_name"), ("p_name.sound", "text", "sounds", None), ("p_name.typing", "search_as_you_type", None, None),
    ("p_type", "text", None, "p_type"), ("p_type.raw", "keyword", None, None), ("p_brand", "text", None, "p_brand"), ("brand", "keyword", None, "p_brand"),
    ("p_size", "integer", None, "p_size"), ("p_retailprice", "double", None, "p_retailprice"),
    ("weight", "integer", None, "CASE WHEN p_partkey % 5 <> 0 THEN p_size END"), ("sizes", "integer_range", None, "p_partkey"),
)
_ROWS = " UNION ALL ".join(
    f"SELECT 'part' AS \"index\", '{path}' AS path, '{kind}' AS type, {f"'{a}'" if a else 'NULL::VARCHAR'} AS analyzer, "
    f"{q('{"analyzer": "' + a + '"}') if a else q('{}')} AS options, {f'(SELECT count({c}) FROM part)' if c else 'NULL::BIGINT'} AS filled"
    for path, kind, a, c in _PART_FIELDS
)


@register("describe_mapping", _ROWS)
def describe_mapping(spark, sf):
    index = index_for(spark, sf, "part")
    # how often each mapped top-level field is filled
    filled = index.docs.agg(*[F.count(f.name).alias(f.name) for f in index.mapping.fields])
    counts = filled.select(F.explode(F.create_map(*[x for f in index.mapping.fields for x in (F.lit(f.name), F.col(f.name))])).alias("path", "filled"))
    return index.mapping.describe(spark, "part").join(counts, "path", "left")


_REV = f"SELECT _id, reverse(token) AS token, position FROM ({sql_tokens(STD_LOW, 'conversations', '''conv_id || '-' || turn''')}) r0"


@register(
    "evolve_mapping",
    f"WITH tok AS ({_REV}) SELECT 'text.reversed' AS field, count(*) AS n_docs, CAST(sum(c) AS BIGINT) AS n_tokens, CAST(sum(length(w)) AS BIGINT) AS chars FROM (SELECT _id, count(*) AS c, string_agg(DISTINCT token, '') AS w FROM tok GROUP BY _id) x",
)
def evolve_mapping(spark, sf):
    """Add a multi-field; only the new field is analyzed."""
    index = index_for(spark, sf, "conversations")
    settings = AnalysisSettings(analyzer={"reversed": {"type": "custom", "tokenizer": "standard", "filter": ["lowercase", "reverse"]}})
    new = Mapping((Field("text", "text", fields=(Field("reversed", "text", analyzer="reversed"),)), Field("role", "keyword"), Field("turn", "integer"), Field("note", "keyword")))
    evolved = _copy(spark, sf, index, "evolve").put_mapping(new, settings)
    assert "note" in evolved.docs.columns
    forward = evolved.forward.where(F.col("field") == "text.reversed")
    chars = F.aggregate("terms", F.lit(0), lambda acc, t: acc + F.length(t["token"]))
    return forward.groupBy("field").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("dl").alias("n_tokens"), F.sum(chars).alias("chars"))


def _copy(spark, sf, index: Collection, name: str) -> Collection:
    return Collection.create(spark, new_table_path(spark, name), index.docs, index.mapping, index.settings, buckets=4)


@register(
    "reanalyze",
    f"SELECT token, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ttf FROM (SELECT _id, token, count(*) AS tf FROM ({sql_tokens(STD_LOW, 'conversations', '''conv_id || '-' || turn''')}) x WHERE length(token) >= 4 GROUP BY 1, 2) y GROUP BY 1",
)
def reanalyze(spark, sf):
    """New settings for an index-time analyzer analyze its fields again."""
    docs = index_for(spark, sf, "conversations").docs
    before = AnalysisSettings(analyzer={"words": {"type": "standard"}})
    after = AnalysisSettings(filter={"long": {"type": "length", "min": 4}}, analyzer={"words": {"type": "custom", "tokenizer": "standard", "filter": ["lowercase", "long"]}})
    mapping = Mapping((Field("text", "text", analyzer="words"), Field("role", "keyword"), Field("turn", "integer")))
    index = Collection.create(spark, new_table_path(spark, "reanalyze"), docs, mapping, before, buckets=4)
    return index.put_settings(after).vocabulary("text").select("token", "df", "ttf")


# --- typed ingest

_RAW = "SELECT CAST(event_id AS VARCHAR) AS _id, CASE WHEN event_id % 10 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS value, CAST(user_id AS VARCHAR) AS user_id, CASE WHEN event_id % 7 <> 0 THEN event_type END AS event_type, props FROM events"
_INGEST = Mapping((
    Field("value", "double", ignore_malformed=True), Field("user_id", "integer"), Field("event_type", "keyword", null_value="none", ignore_above=5),
    Field("k", "long"), Field("hidden", "keyword", enabled=False),
))


def raw_events(spark, sf):
    e = table(spark, sf, "events")
    return e.select(
        F.col("event_id").cast("string").alias("_id"),
        F.when(F.col("event_id") % 10 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
        F.when(F.col("event_id") % 13 == 0, F.lit("?")).otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("event_type"), "props",
    )


_ET = "CASE WHEN event_id % 7 <> 0 THEN event_type ELSE 'none' END"


@register(
    "typed_ingest",
    f"SELECT CAST(event_id AS VARCHAR) AS _id, CASE WHEN event_id % 10 <> 0 THEN value END AS value, CAST(user_id AS INTEGER) AS user_id, CASE WHEN event_id % 7 <> 0 THEN event_type END AS source_type, CASE WHEN length({_ET}) <= 5 THEN {_ET} END AS event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_id % 13 = 0 AS rejected FROM events WHERE event_id % 13 <> 0 "
    "UNION ALL SELECT CAST(event_id AS VARCHAR), NULL, NULL, NULL, NULL, NULL, true FROM events WHERE event_id % 13 = 0",
)
def typed_ingest(spark, sf):
    """Coercion, missing values, length limit and a JSON body; malformed keys go to the rejects."""
    raw = I.from_json_lines(raw_events(spark, sf), "props", Mapping((Field("k", "long"),))).drop("_index", "props")
    docs, rejects = I.ingest(raw, _INGEST)
    kept = docs.select("_id", "value", "user_id", F.col("event_type").alias("source_type"), F.col("event_type__search").alias("event_type"), "k", F.lit(False).alias("rejected"))
    nothing = lambda t: F.lit(None).cast(t)
    return kept.unionByName(rejects.select("_id", nothing("double").alias("value"), nothing("int").alias("user_id"), nothing("string").alias("source_type"), nothing("string").alias("event_type"), nothing("bigint").alias("k"), F.lit(True).alias("rejected")))


@register("copy_to", "SELECT CAST(p_partkey AS VARCHAR) AS _id, p_name, p_brand, p_name || ' ' || p_brand || ' ' || p_size AS everything FROM part")
def copy_to(spark, sf):
    mapping = Mapping((Field("p_name", "text", copy_to=("everything",)), Field("p_brand", "keyword", copy_to=("everything",)), Field("p_size", "integer", copy_to=("everything",)), Field("everything", "text")))
    raw = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("_id"), "p_name", "p_brand", "p_size")
    return I.ingest(raw, mapping)[0].select("_id", "p_name", "p_brand", "everything")


@register("multi_field", "SELECT CAST(c_custkey AS VARCHAR) AS _id, c_name, CASE WHEN length(c_name) <= 18 THEN lower(c_name) END AS c_name__folded, CAST(c_acctbal AS BIGINT) AS c_acctbal__whole FROM (SELECT *, trunc(c_acctbal) AS w FROM customer) c".replace("CAST(c_acctbal AS BIGINT)", "CAST(w AS BIGINT)"))
def multi_field(spark, sf):
    mapping = Mapping((
        Field("c_name", "text", fields=(Field("folded", "keyword", normalizer="lowercase", ignore_above=18),)),
        Field("c_acctbal", "double", fields=(Field("whole", "long"),)),
    ))
    raw = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("_id"), "c_name", "c_acctbal")
    return I.ingest(raw, mapping)[0].select("_id", "c_name", "c_name__folded", "c_acctbal__whole")


@register("create_or_evolve", "SELECT CAST(p_partkey AS VARCHAR) AS _id, p_name, lower(p_brand) AS brand FROM part WHERE lower(p_brand) = 'brand#14'")
def create_or_evolve(spark, sf):
    """The first call creates the collection, the second adds a keyword multi-field to it."""
    docs = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("_id"), "p_name", "p_brand")
    path = new_table_path(spark, "evolving")
    Collection.create_or_evolve(spark, path, docs, Mapping((Field("p_name", "text"), Field("p_brand", "text"))), buckets=4)
    wider = Mapping((Field("p_name", "text"), Field("p_brand", "text", fields=(Field("key", "keyword", normalizer="lowercase"),))))
    index = Collection.create_or_evolve(spark, path, docs, wider)
    found = R.matched(index, R.Search(filter=(Q.Term("p_brand.key", "BRAND#14"),)))
    return found.select("_id", "p_name", F.col("p_brand__key").alias("brand"))


@register("bulk_route", f"SELECT 'events_' || (CAST(_id AS BIGINT) % 2) AS _index, _id, event_id, event_type FROM ({_LAST.format(src='SELECT * FROM (' + _EVENT + ') e0')}) x WHERE event_type = 'view' OR event_type = 'click'")
def bulk_route(spark, sf):
    """One batch for two collections, then a search in each."""
    df = events(spark, sf).select("_id", "event_id", "event_type", "ts").withColumn("_index", F.concat(F.lit("events_"), (F.col("_id").cast("bigint") % 2).cast("string")))
    mapping = Mapping((Field("event_id", "long"), Field("event_type", "text"), Field("ts", "date")))
    empty = df.drop("_index").limit(0)
    targets = {n: Collection.create(spark, new_table_path(spark, n), empty, mapping, buckets=4) for n in ("events_0", "events_1")}
    found = [
        R.matched(c, R.Search(must=(Q.Match("event_type", "view click"),))).select(F.lit(n).alias("_index"), "_id", "event_id", "event_type")
        for n, c in C.bulk_put(targets, df, ["ts", "event_id"]).items()
    ]
    return found[0].unionByName(found[1])


_IP = "'10.' || (user_id % 256) || '.' || (event_id % 256) || '.1'"
_IP_NUMBER = "((user_id % 256) * 65536 + (event_id % 256) * 256 + 1)"


def addresses(spark, sf):
    """Events with an address and a range of addresses, typed and indexed."""
    part = lambda c: (F.col(c) % 256).cast("string")
    first = F.concat(F.lit("10."), part("user_id"), F.lit("."), part("event_id"))
    raw = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("_id"), F.concat(first, F.lit(".1")).alias("ip"),
        F.struct(F.concat(first, F.lit(".0")).alias("gte"), F.concat(first, F.lit(".99")).alias("lte")).alias("net"),
    )
    mapping = Mapping((Field("ip", "ip"), Field("net", "ip_range")))
    return Collection.create(spark, new_table_path(spark, "addresses"), I.ingest(raw, mapping)[0], mapping, buckets=4)


@register("q_range_ip", f"SELECT CAST(event_id AS VARCHAR) AS _id, {_IP} AS ip FROM events WHERE {_IP_NUMBER} >= 9 * 65536 AND {_IP_NUMBER} < 100 * 65536 + 10 * 256")
def q_range_ip(spark, sf):
    return R.matched(addresses(spark, sf), R.Search(filter=(Q.Range("ip", gte="10.9.0.0", lt="10.100.10.0"),))).select("_id", "ip")


@register("q_ip_range_overlap", f"SELECT CAST(event_id AS VARCHAR) AS _id FROM events WHERE {_IP_NUMBER} + 98 >= 3 * 65536 + 50 AND {_IP_NUMBER} - 1 <= 9 * 65536 + 7 * 256 + 5")
def q_ip_range_overlap(spark, sf):
    return R.matched(addresses(spark, sf), R.Search(filter=(Q.Range("net", gte="10.3.0.50", lte="::ffff:10.9.7.5"),))).select("_id")


@register("date_nanos", "SELECT CAST(event_id AS VARCHAR) AS _id, CAST(ts AS TIMESTAMP) + to_microseconds(event_id % 1000000) AS d9, date_trunc('second', CAST(ts AS TIMESTAMP)) + to_milliseconds((event_id % 10) * 100) AS d1, date_trunc('minute', CAST(ts AS TIMESTAMP)) AS d0 FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events) e")
def date_nanos(spark, sf):
    """Nine digits of a second, one digit, and none with a zone."""
    e = table(spark, sf, "events").select(F.col("event_id").alias("n"), F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("t"))
    nine = F.concat("t", F.lit("."), F.lpad((F.col("n") % 1000000).cast("string"), 6, "0"), F.lit("789Z"))
    texts_ = e.select(F.col("n").cast("string").alias("_id"), nine.alias("d9"), F.concat("t", F.lit("."), (F.col("n") % 10).cast("string")).alias("d1"), F.concat(F.substring("t", 1, 16), F.lit("Z")).alias("d0"))
    mapping = Mapping((Field("d9", "date_nanos"), Field("d1", "date"), Field("d0", "date")))
    docs = I.ingest(texts_, mapping)[0]
    return docs.select("_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("d9", "d1", "d0")])


_KEYED = Mapping((Field("c_name", "text", fields=(Field("raw", "keyword"),)), Field("segment", "keyword", normalizer="lowercase"), Field("note", "keyword", ignore_above=18)))


def customers(spark, sf):
    raw = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("_id"), "c_name", F.col("c_mktsegment").alias("segment"), F.concat("c_name", F.repeat(F.lit("!"), (F.col("c_custkey") % 3).cast("int"))).alias("note"))
    return Collection.create(spark, new_table_path(spark, "customers"), I.ingest(raw, _KEYED)[0], _KEYED, buckets=4)


@register("q_term_multi_field", "SELECT CAST(c_custkey AS VARCHAR) AS _id FROM customer WHERE c_name = 'Customer#000000007' OR starts_with(c_name, 'Customer#00000001')")
def q_term_multi_field(spark, sf):
    request = R.Search(should=(Q.Term("c_name.raw", "Customer#000000007"), Q.Prefix("c_name.raw", "Customer#00000001")))
    return R.matched(customers(spark, sf), request).select("_id")


@register("q_term_normalized", "SELECT CAST(c_custkey AS VARCHAR) AS _id, c_mktsegment AS segment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def q_term_normalized(spark, sf):
    return R.matched(customers(spark, sf), R.Search(filter=(Q.Term("segment", ["Building", "machinery"]),))).select("_id", "segment")


@register("ignore_above_source", "SELECT CAST(c_custkey AS VARCHAR) AS _id, c_name || repeat('!', CAST(c_custkey % 3 AS INTEGER)) AS note, c_custkey % 3 = 0 AS found FROM customer")
def ignore_above_source(spark, sf):
    """A value over the length limit is not found, and stays in the source."""
    index = customers(spark, sf)
    found = R.matched(index, R.Search(filter=(Q.Prefix("note", "Customer"),))).select("_id", F.lit(True).alias("hit"))
    return index.docs.join(found, "_id", "left").select("_id", "note", F.coalesce("hit", F.lit(False)).alias("found"))


_DATE_FORMATS = {
    # name: (Spark text, DuckDB value as a date or time expression)
    "basic_date": ("date_format(d, 'yyyyMMdd')", "d"),
    "basic_date_time": ("concat(date_format(d, 'yyyyMMdd'), 'T101112.345Z')", "d + INTERVAL '10 hours 11 minutes 12.345 seconds'"),
    "basic_ordinal_date": ("date_format(d, 'yyyyDDD')", "d"),
    "ordinal_date": ("date_format(d, 'yyyy-DDD')", "d"),
    "date": ("date_format(d, 'yyyy-MM-dd')", "d"),
    "date_hour_minute": ("concat(date_format(d, 'yyyy-MM-dd'), 'T10:11')", "d + INTERVAL '10 hours 11 minutes'"),
    "strict_date_time_no_millis": ("concat(date_format(d, 'yyyy-MM-dd'), 'T10:11:12+02:00')", "d + INTERVAL '8 hours 11 minutes 12 seconds'"),
    "date_optional_time": ("date_format(d, 'yyyy-MM')", "date_trunc('month', d)"),
    "epoch_millis": ("cast(unix_millis(d) as string)", "d"),
    "epoch_second": ("cast(unix_seconds(d) as string)", "d"),
    "week_date": ("concat(extract(YEAROFWEEK from d), '-W', lpad(weekofyear(d), 2, '0'), '-', weekday(d) + 1)", "d"),
    "basic_week_date": ("concat(extract(YEAROFWEEK from d), 'W', lpad(weekofyear(d), 2, '0'), weekday(d) + 1)", "d"),
    "strict_weekyear_week": ("concat(extract(YEAROFWEEK from d), '-W', lpad(weekofyear(d), 2, '0'))", "date_trunc('week', d)"),
    "year": ("date_format(d, 'yyyy')", "date_trunc('year', d)"),
    "year_month": ("date_format(d, 'yyyy-MM')", "date_trunc('month', d)"),
    "hour_minute_second": ("date_format(d + make_dt_interval(0, day(d) % 24, 5, 6), 'HH:mm:ss')", "TIMESTAMP '1970-01-01' + to_hours(CAST(day(d) % 24 AS INTEGER)) + INTERVAL '5 minutes 6 seconds'"),
    "dd/MM/yyyy": ("date_format(d, 'dd/MM/yyyy')", "d"),
}


@register("date_formats", "SELECT CAST(o_orderkey AS VARCHAR) AS _id, " + ", ".join(f"CAST({duck} AS TIMESTAMP) AS d{i}" for i, (_, duck) in enumerate(_DATE_FORMATS.values())) + " FROM (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS d FROM orders) o")
def date_formats(spark, sf):
    df = spread(orders(spark, sf).select("_id", F.col("o_orderdate").alias("d")))
    cols = [parse_date(F.expr(text), name).cast("timestamp_ntz").alias(f"d{i}") for i, (name, (text, _)) in enumerate(_DATE_FORMATS.items())]
    return df.select("_id", *cols)


@register("ip_parse", "SELECT CAST(event_id AS VARCHAR) AS _id, CASE WHEN event_id % 9 <> 0 THEN 10 * 16777216 + (user_id % 256) * 65536 + (event_id % 256) * 256 + 1 END AS ip FROM events")
def ip_parse(spark, sf):
    text = F.concat(F.lit("10."), (F.col("user_id") % 256).cast("string"), F.lit("."), (F.col("event_id") % 256).cast("string"), F.when(F.col("event_id") % 9 != 0, F.lit(".1")).otherwise(F.lit(".x")))
    return table(spark, sf, "events").select(F.col("event_id").cast("string").alias("_id"), I.ip_number(text).alias("ip"))
