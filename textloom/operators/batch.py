"""A table of queries against the collection: the best k documents of each.

The postings of all asked terms are dealt out by document, and meet the query terms in one join there, so
that a small table of queries needs no shuffle of the pairs: they are summed per (query, document) and the
best k per query kept in each task before they are ranked. There is no other way for common terms: a plan
that spared them cost more than it saved. Queries of equal content are answered once. A term that very
many queries and documents share is a skewed join, which adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from textloom.operators.analyzers import Analyzer
from textloom.operators.fuzzy import fuzzy_join, max_edits, stored_join
from textloom.operators.postings import terms_of
from textloom.operators.similarity import SIMILARITY
from textloom.plans import queries as Q
from textloom.plans.compile import hits
from textloom.plans.search import SCORE_DIGITS
from textloom.session import materialize
from textloom.sources.collection import Collection


def ranked(df: DataFrame, k: int) -> DataFrame:
    """Best k per query by rounded score; each task keeps k rows per query before the shuffle."""
    order = Window.partitionBy("query_id").orderBy(F.round("score", SCORE_DIGITS).desc(), F.asc("_id"))
    best = df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "_id", F.round("score", SCORE_DIGITS).alias("_score"))


def distinct_queries(queries: DataFrame, analyzers: Sequence[Analyzer]) -> tuple[DataFrame, DataFrame]:
    """``(terms, members)``: the terms of each distinct content by analyzer, and which queries have it."""
    each = [terms_of(a.array(F.col("text")), positions=False) for a in analyzers]
    keyed = queries.select("query_id", F.array(*[F.transform(t, lambda t: F.struct(t["token"].alias("token"), t["tf"].alias("qtf"))) for t in each]).alias("terms"))
    # many branches read the terms; the texts are analyzed once
    keyed = materialize(keyed.withColumn("key", F.sha2(F.to_json("terms"), 256)), "query-terms")
    # equal content has equal terms: the first of each key, combined before the shuffle
    content = keyed.groupBy("key").agg(F.first("terms").alias("terms")).withColumn("number", F.monotonically_increasing_id())
    # written down with their numbers, which stand for the long keys in every pair
    content = materialize(content, "query-contents")
    rows = content.select(F.col("number").alias("query_id"), F.posexplode("terms").alias("no", "terms"))
    members = keyed.select("query_id", "key").join(content.select("key", "number"), "key").select("query_id", F.col("number").alias("key"))
    return rows.select("query_id", "no", F.explode("terms").alias("t")).select("query_id", "no", "t.*"), members


def expand_members(result: DataFrame, members: DataFrame) -> DataFrame:
    """Give every query the result of its content."""
    return members.join(result.withColumnRenamed("query_id", "key"), "key").drop("key").select("query_id", "rank", "_id", "_score")


def _spelled(terms: DataFrame, vocab: DataFrame, fuzziness: int | str | None, spellings: DataFrame | None = None) -> DataFrame:
    """Query terms with the vocabulary terms they stand for, and the weight of each."""
    if fuzziness in (None, 0, "0"):
        return terms.join(vocab, "token").withColumns({"term": F.col("token"), "weight": F.lit(1.0)})
    edits = 2 if str(fuzziness).upper() == "AUTO" else int(fuzziness)
    asked = terms.select(F.col("token").alias("q"))
    near = fuzzy_join(asked, vocab.select("token"), edits) if spellings is None else stored_join(asked, spellings, edits)
    weight = F.lit(1.0) - F.col("d") / F.least(F.length("q"), F.length("token"))
    near = near.where(F.col("d") <= max_edits(F.col("q"), fuzziness)).withColumn("weight", weight).where("weight > 0").drop("d")
    return terms.withColumnRenamed("token", "term").join(near, F.col("term") == F.col("q")).drop("q").join(vocab, "token")


def batch_search(
    index: Collection, queries: DataFrame, fields: str | Sequence[str], k: int = 10, operator: str = "OR", fuzziness: int | str | None = None,
    filter: Q.Query | None = None,
) -> DataFrame:
    """The best ``k`` documents of each ``(query_id, text)``: ``(query_id, rank, _id, _score)``.

    Every field scores by its own similarity; of several fields the best one counts. ``operator``
    "AND" asks for all terms within a field, ``fuzziness`` (1, 2 or "AUTO") for near spellings, and
    ``filter`` limits the documents.
    """
    names = [fields] if isinstance(fields, str) else list(fields)
    terms, members = distinct_queries(queries, [index.text[n].search_analyzer for n in names])
    parts = []
    for no, name in enumerate(names):
        spec, stats = index.text[name], index.stats[name]
        own = terms.where(F.col("no") == no).drop("no")
        wanted = _spelled(own, index.vocabulary(name).select("token", "df", "ttf"), fuzziness, index.spellings(name))
        wanted = materialize(wanted.select("query_id", "token", "term", "qtf", "weight", "df", "ttf"), "query-words")
        met = index.postings(name).select("token", "_id", "tf", "dl").join(wanted.select("token").distinct(), "token", "left_semi")
        # the number is fixed: the pairs are the work, not the postings that are dealt out
        rows = met.repartition(int(index.spark.conf.get("spark.sql.shuffle.partitions")), "_id").join(wanted, "token")
        score = SIMILARITY[spec.similarity](F.col("tf"), F.col("dl"), F.col("df"), F.col("ttf"), stats, spec.norms)
        rows = rows.select("query_id", "_id", "term", (F.col("qtf") * F.lit(spec.boost) * F.col("weight") * score).alias("score"))
        if operator.upper() == "AND":
            needed = own.groupBy("query_id").agg(F.count(F.lit(1)).alias("needed"))
            # at most the query's own terms
            found = rows.groupBy("query_id", "_id").agg(F.sum("score").alias("score"), F.size(F.collect_set("term")).alias("n"))
            found = found.join(needed, "query_id").where("n = needed").select("query_id", "_id", "score")
        else:
            found = rows.groupBy("query_id", "_id").agg(F.sum("score").alias("score"))
        parts.append(found)
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    if len(parts) > 1:
        found = found.groupBy("query_id", "_id").agg(F.max("score").alias("score"))
    if filter is not None:
        found = found.join(hits(index, filter).select("_id"), "_id", "left_semi")
    return expand_members(ranked(found, k), members)


def similar_documents(index: Collection, queries: DataFrame, field: str, k: int = 10) -> DataFrame:
    """Documents that share min-hash tokens with each query text, by the share of equal tokens.

    ``field`` is indexed with an analyzer that ends in ``min_hash``; the share
    estimates the overlap of the two sets of shingles.
    """
    terms, members = distinct_queries(queries, [index.text[field].analyzer])
    size = terms.groupBy("query_id").agg(F.count(F.lit(1)).alias("size"))
    wanted = materialize(terms.join(size, "query_id").select("query_id", "token", (F.lit(1.0) / F.col("size")).alias("share")), "query-words")
    found = index.postings(field).select("token", "_id").join(wanted, "token").groupBy("query_id", "_id").agg(F.sum("share").alias("score"))
    return expand_members(ranked(found, k), members)
