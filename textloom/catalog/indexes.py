"""Collections that several registered queries read, built once per session and folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from textloom.catalog.common import documents, table
from textloom.operators.analyzers import AnalysisSettings
from textloom.plans.mapping import Field, Mapping
from textloom.session import new_table_path
from textloom.sources.collection import Collection

_built: dict[tuple[str, str, str], Collection] = {}


def weighted_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The documents with a weight from their labels and a partly missing field."""
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return documents(spark, sf).join(labels, "doc_id", "left").select(
        "_id", "text", "lang", "source", "n_chars",
        F.when(F.col("doc_id") % 7 != 0, F.col("source")).alias("origin"),
        (F.coalesce("quality", F.lit(0)) * 10 + 1).cast("int").alias("weight"),
        F.transform(F.split("text", "\n"), lambda line, i: F.struct(i.alias("no"), F.length(line).alias("chars"))).alias("lines"),
    )


DOCUMENTS = Mapping((
    Field("text", "text"), Field("lang", "keyword"), Field("source", "keyword"), Field("n_chars", "long"),
    Field("origin", "keyword"), Field("weight", "integer"),
    Field("lines", "nested", properties=(Field("no", "integer"), Field("chars", "integer"))),
))

PART_SETTINGS = AnalysisSettings(
    filter={"sound": {"type": "phonetic", "encoder": "soundex"}},
    analyzer={"sounds": {"type": "custom", "tokenizer": "standard", "filter": ["sound", "lowercase"]}},
)
PARTS = Mapping((
    Field("p_name", "text", fields=(Field("sound", "text", analyzer="sounds"), Field("typing", "search_as_you_type"))),
    Field("p_type", "text", fields=(Field("raw", "keyword"),)),
    Field("p_brand", "text"), Field("brand", "keyword"), Field("p_size", "integer"), Field("p_retailprice", "double"),
    Field("weight", "integer"), Field("sizes", "integer_range"),
))


def parts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("_id"), "p_name", "p_type", "p_brand", F.col("p_brand").alias("brand"), "p_size", "p_retailprice",
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_size")).alias("weight"),
        F.struct(F.col("p_size").alias("gte"), (F.col("p_size") + 10).alias("lte")).alias("sizes"),
    )


MINHASH_SETTINGS = AnalysisSettings(
    filter={
        "pairs": {"type": "shingle", "min_shingle_size": 3, "max_shingle_size": 3, "output_unigrams": False},
        "signature": {"type": "min_hash", "hash_count": 16, "bucket_count": 1},
    },
    analyzer={"similar": {"type": "custom", "tokenizer": "standard", "filter": ["lowercase", "pairs", "signature"]}},
)
MINHASH = Mapping((Field("text", "text", analyzer="similar", index_options="docs"),))


def turns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("_id"), "text", "role", F.col("turn").cast("int").alias("turn")
    )


def threads(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations with their turns inside."""
    each = table(spark, sf, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    return each.select(F.col("conv_id").cast("string").alias("_id"), F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


TURNS_LM = Mapping((Field("text", "text", similarity="LMJelinekMercer"), Field("role", "keyword"), Field("turn", "integer")))
TURNS_DOCS = Mapping((Field("text", "text", index_options="docs"), Field("role", "keyword"), Field("turn", "integer")))
THREADS = Mapping((Field("turns", "nested", properties=(Field("role", "keyword"), Field("text", "text"))),))
TURNS = Mapping((Field("text", "text"), Field("role", "keyword"), Field("turn", "integer")))



def orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("_id"), "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"), "o_orderpriority"
    )


ORDERS = Mapping((
    Field("o_custkey", "long"), Field("o_orderstatus", "keyword"), Field("o_totalprice", "double"), Field("o_orderdate", "date"), Field("o_orderpriority", "keyword"),
))


def suppliers(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    point = F.struct((k * 37 % 180 - 90).cast("double").alias("lat"), (k * 53 % 360 - 180).cast("double").alias("lon"))
    return table(spark, sf, "supplier").select(k.cast("string").alias("_id"), "s_name", "s_acctbal", point.alias("location"))


SUPPLIERS = Mapping((Field("s_name", "keyword"), Field("s_acctbal", "double"), Field("location", "geo_point")))

# name: (documents, mapping, settings, index sort)
_SPECS = {
    "documents": (weighted_documents, DOCUMENTS, AnalysisSettings(), ()),
    "part": (parts, PARTS, PART_SETTINGS, ()),
    "minhash": (lambda spark, sf: documents(spark, sf).select("_id", "text"), MINHASH, MINHASH_SETTINGS, ()),
    "conversations": (turns, TURNS, AnalysisSettings(), ()),
    "turns_lm": (turns, TURNS_LM, AnalysisSettings(), ()),
    "turns_docs": (turns, TURNS_DOCS, AnalysisSettings(), ()),
    "threads": (threads, THREADS, AnalysisSettings(), ()),
    "orders": (orders, ORDERS, AnalysisSettings(), (("o_orderdate", "asc"),)),
    "supplier": (suppliers, SUPPLIERS, AnalysisSettings(), ()),
}


#: Fields that are searched with edits.
_SPELLED = {"documents": ("text",), "part": ("p_name", "p_type", "p_name.sound")}


def index_for(spark: SparkSession, sf: str, name: str) -> Collection:
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _built:
        docs, mapping, settings, sort = _SPECS[name]
        made = Collection.create(spark, new_table_path(spark, name), docs(spark, sf), mapping, settings, list(sort), buckets=4)
        _built[key] = made.store_spellings(*_SPELLED.get(name, ()))
    return _built[key]
