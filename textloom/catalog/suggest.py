"""Completion suggestions and search-as-you-type fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.catalog import sqlscore as S
from textloom.catalog.common import register, sql_tokens, table
from textloom.catalog.indexes import index_for
from textloom.operators import completion as G
from textloom.plans import compile as plan, queries as Q
from textloom.plans.mapping import Field, Mapping, SuggestContext
from textloom.session import new_table_path
from textloom.sources.collection import Collection


def suggestions(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("_id"), F.lit("name").alias("field"), F.col("p_name").alias("input"), F.col("p_size").alias("weight"), "p_brand"
    )


def asked(spark, sf, step: int):
    """Prefixes of every ``step``-th kind of name: one suggester per distinct name and length."""
    names = table(spark, sf, "part").select("p_name").distinct()
    lengths = F.explode(F.sequence(F.lit(1), F.length("p_name"), F.lit(step)))
    prefixes = names.select("p_name", lengths.alias("n"))
    return prefixes.select(F.concat_ws("/", "p_name", F.col("n").cast("string")).alias("suggester_id"), F.lit("name").alias("field"), F.expr("upper(substring(p_name, 1, n))").alias("prefix"))


_ASKED = "SELECT p_name || '/' || n AS suggester_id, lower(substr(p_name, 1, n)) AS prefix FROM (SELECT p_name, unnest(range(1, length(p_name) + 1, {step})) AS n FROM (SELECT DISTINCT p_name FROM part) d) e"
_BEST = "SELECT suggester_id, rank, _id, input, weight FROM (SELECT *, row_number() OVER (PARTITION BY suggester_id ORDER BY weight DESC, input, _id) AS rank FROM ({inner}) x) y WHERE rank <= {k}"


@register("completion", f"WITH a AS ({_ASKED.format(step=2)}) " + _BEST.format(inner="SELECT suggester_id, CAST(p_partkey AS VARCHAR) AS _id, p_name AS input, p_size AS weight FROM a JOIN part ON starts_with(lower(p_name), prefix)", k=5))
def completion(spark, sf):
    found = G.completions(suggestions(spark, sf), asked(spark, sf, 2), size=5)
    return found.withColumn("rank", F.col("rank").cast("bigint"))


@register("completion_context", f"WITH a AS ({_ASKED.format(step=3)}) " + _BEST.format(inner="SELECT DISTINCT suggester_id, CAST(p_partkey AS VARCHAR) AS _id, p_name AS input, p_size AS weight FROM a JOIN part ON starts_with(lower(p_name), prefix) WHERE p_brand IN ('Brand#14', 'Brand#2')", k=5))
def completion_context(spark, sf):
    base = suggestions(spark, sf).withColumn("context", F.array("p_brand"))
    queries = asked(spark, sf, 3).withColumn("context", F.array(F.lit("Brand#14"), F.lit("Brand#2")))
    return G.completions_in_context(base, queries, size=5).withColumn("rank", F.col("rank").cast("bigint"))


def _suggested(spark, sf):
    """Parts with a completion field: name and brand as inputs, the brand as a context."""
    docs = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("_id"),
        F.struct(F.array("p_name", "p_brand").alias("input"), F.col("p_size").alias("weight"), F.create_map(F.lit("brand"), F.array("p_brand")).alias("contexts")).alias("typed"),
    )
    mapping = Mapping((Field("typed", "completion", contexts=(SuggestContext("brand"),)),))
    return Collection.create(spark, new_table_path(spark, "suggested"), docs, mapping, buckets=4).docs


@register("completion_field", "WITH i AS (SELECT CAST(p_partkey AS VARCHAR) AS _id, unnest([p_name, p_brand]) AS input, p_size AS weight, p_brand FROM part), a AS (SELECT DISTINCT 'all' AS suggester_id, lower(substr(p_name, 1, 2)) AS prefix, NULL AS brand FROM part UNION ALL SELECT 'Brand#14', 'b', 'Brand#14') " + _BEST.format(inner="SELECT coalesce(brand, prefix) AS suggester_id, _id, input, weight FROM a JOIN i ON starts_with(lower(input), prefix) AND (brand IS NULL OR brand = p_brand)", k=4))
def completion_field(spark, sf):
    """Suggestions from a collection's own completion field, without and with a context."""
    docs = _suggested(spark, sf)
    prefixes = table(spark, sf, "part").select(F.lower(F.substring("p_name", 1, 2)).alias("prefix")).distinct().withColumn("suggester_id", F.col("prefix"))
    one = spark.sql("SELECT 'Brand#14' AS suggester_id, 'B' AS prefix, map('brand', array('Brand#14')) AS contexts")
    found = G.suggest(docs, "typed", prefixes, 4).unionByName(G.suggest(docs, "typed", one, 4))
    return found.withColumn("rank", F.col("rank").cast("bigint"))


_LONG = "repeat(p_name || ' ', 1 + CAST(floor(100 / length(p_name)) AS INTEGER))"
_LONG_ASKED = f"SELECT DISTINCT p_name || '/' || n AS suggester_id, lower(substr({_LONG}, 1, n)) AS prefix FROM part, (VALUES (60), (80), (100)) v(n)"


@register("completion_context_long", f"WITH a AS ({_LONG_ASKED}) " + _BEST.format(inner=f"SELECT DISTINCT suggester_id, CAST(p_partkey AS VARCHAR) AS _id, {_LONG} AS input, p_size AS weight FROM a JOIN part ON starts_with(lower({_LONG}), prefix) WHERE p_brand = 'Brand#14'", k=5))
def completion_context_long(spark, sf):
    """Prefixes of 60 to 100 letters."""
    long = F.expr("repeat(p_name || ' ', 1 + cast(floor(100 / length(p_name)) as int))")
    base = suggestions(spark, sf).withColumn("input", F.expr("repeat(input || ' ', 1 + cast(floor(100 / length(input)) as int))")).withColumn("context", F.array("p_brand"))
    n = F.explode(F.array(F.lit(60), F.lit(80), F.lit(100)))
    prefixes = table(spark, sf, "part").select("p_name", long.alias("long")).distinct().withColumn("n", n)
    asked = prefixes.select(F.concat_ws("/", "p_name", "n").alias("suggester_id"), F.lit("name").alias("field"), F.expr("upper(substring(long, 1, n))").alias("prefix"), F.array(F.lit("Brand#14")).alias("context"))
    return G.completions_in_context(base, asked, size=5).withColumn("rank", F.col("rank").cast("bigint"))


_CELL = "floor(({lat}) / 30.0) || '/' || floor(({lon}) / 30.0)"
_SUP = "SELECT CAST(s_suppkey AS VARCHAR) AS _id, s_name AS input, CAST(floor(s_acctbal) AS INTEGER) AS weight, CAST(CAST(floor((s_suppkey * 37 % 180 - 90) / 30.0) AS BIGINT) AS VARCHAR) || '/' || CAST(CAST(floor((s_suppkey * 53 % 360 - 180) / 30.0) AS BIGINT) AS VARCHAR) AS cell FROM supplier"


@register("completion_geo", f"WITH s AS ({_SUP}) " + _BEST.format(inner="SELECT c.cell AS suggester_id, s._id, s.input, s.weight FROM (SELECT DISTINCT cell FROM s) c JOIN s ON s.cell = c.cell WHERE starts_with(lower(s.input), 'supplier#0')", k=3))
def completion_geo(spark, sf):
    """The best suppliers of every grid cell."""
    k = F.col("s_suppkey")
    cell = G.geo_cell((k * 37 % 180 - 90).cast("double"), (k * 53 % 360 - 180).cast("double"), 30.0)
    base = table(spark, sf, "supplier").select(
        k.cast("string").alias("_id"), F.lit("name").alias("field"), F.col("s_name").alias("input"), F.floor("s_acctbal").cast("int").alias("weight"), F.array(cell).alias("context")
    )
    queries = base.select("context").distinct().select(F.col("context")[0].alias("suggester_id"), F.lit("name").alias("field"), F.lit("Supplier#0").alias("prefix"), "context")
    return G.completions_in_context(base, queries, size=3).withColumn("rank", F.col("rank").cast("bigint"))


_PLACES = "SELECT CAST(s_suppkey AS VARCHAR) AS _id, s_name AS input, CAST(floor(s_acctbal) AS INTEGER) AS weight, CAST(floor((s_suppkey * 37 % 180 - 90) / 30.0) AS BIGINT) AS i, CAST(floor((s_suppkey * 53 % 360 - 180) / 30.0) AS BIGINT) AS j FROM supplier"


@register(
    "completion_geo_near",
    f"WITH s AS ({_PLACES}) "
    + _BEST.format(
        inner="SELECT c.i || '/' || c.j AS suggester_id, s._id, s.input, s.weight FROM (SELECT DISTINCT i, j FROM s) c JOIN s ON abs(s.i - c.i) <= 1 AND least(abs(s.j - c.j), 12 - abs(s.j - c.j)) <= 1 WHERE starts_with(lower(s.input), 'supplier#0')", k=3
    ),
)
def completion_geo_near(spark, sf):
    """The best suppliers of every grid cell and the cells around it, over the date line as well."""
    k = F.col("s_suppkey")
    lat, lon = (k * 37 % 180 - 90).cast("double"), (k * 53 % 360 - 180).cast("double")
    base = table(spark, sf, "supplier").select(
        k.cast("string").alias("_id"), F.lit("name").alias("field"), F.col("s_name").alias("input"), F.floor("s_acctbal").cast("int").alias("weight"),
        F.array(G.geo_cell(lat, lon, 30.0)).alias("context"), G.near_cells(lat, lon, 30.0).alias("around"),
    )
    queries = base.select(F.col("context")[0].alias("suggester_id"), F.lit("name").alias("field"), F.lit("Supplier#0").alias("prefix"), F.col("around").alias("context")).distinct()
    return G.completions_in_context(base.drop("around"), queries, size=3).withColumn("rank", F.col("rank").cast("bigint"))


_WORDS = "list_transform(regexp_extract_all(p_name, '[\\p{L}\\p{N}]+'), lambda x: lower(x))"
_TWO = f"CASE WHEN len({_WORDS}) >= 2 THEN list_transform(range(1, len({_WORDS})), lambda i: ({_WORDS})[i] || ' ' || ({_WORDS})[i + 1]) ELSE [] END"


@register(
    "sayt_field",
    f"WITH {S.field('a', _WORDS, 'part', S.PART_ID)}, {S.field('g', _TWO, 'part', S.PART_ID)} SELECT _id, round(sum(score), 6) AS _score FROM ({S.match('a', ['old'])} UNION ALL SELECT DISTINCT _id, 1::DOUBLE FROM a_tok WHERE starts_with(token, 'ro') UNION ALL SELECT DISTINCT _id, 1::DOUBLE FROM g_tok WHERE starts_with(token, 'old ro')) u GROUP BY _id",
)
def sayt_field(spark, sf):
    """Words, word pairs and unfinished words of a search-as-you-type field."""
    index = index_for(spark, sf, "part")
    q = Q.MultiMatch(("p_name.typing", "p_name.typing._2gram"), "old ro", "bool_prefix")
    return plan.hits(index, q).select("_id", F.round("score", 6).alias("_score"))
