"""Scored matching on postings: terms, phrases, and their combination per document.

Every function returns at most one row per document after one shuffle on ``_id``.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textloom.operators.analyzers import Analyzer
from textloom.operators.fuzzy import edits_of, expand_terms
from textloom.operators.similarity import K1, B, SIMILARITY, idf, saturation
from textloom.sources.collection import Collection


def query_terms(spark: SparkSession, analyzer: Analyzer, text: str) -> list[tuple[int, str]]:
    """``(position, token)`` of a query text, by the same expressions as documents.

    The text is the caller's own query, so the result is small by nature.
    """
    row = spark.sql("SELECT 1").select(analyzer.array(F.lit(text)).alias("t")).collect()[0]
    return [(t["position"], t["token"]) for t in row["t"] or []]


def _terms_frame(spark: SparkSession, terms: list[tuple[int, str, float]]) -> DataFrame:
    """The query's own terms as a local relation."""
    table = pa.table(
        {
            "term_idx": pa.array([i for i, _, _ in terms], pa.int32()),
            "token": pa.array([t for _, t, _ in terms], pa.string()),
            "weight": pa.array([float(w) for _, _, w in terms], pa.float64()),
        }
    )
    return spark.createDataFrame(table)


def term_scores(
    index: Collection, field: str, terms: list[tuple[int, str, float]], fuzziness: int | str | None = None,
    prefix_length: int = 0, max_expansions: int | None = None,
) -> DataFrame:
    """``(_id, term_idx, score)`` for each query term and each document that has it."""
    spec = index.text[field]
    stats = index.stats[field]
    formula = SIMILARITY[spec.similarity]
    fuzzy = fuzziness not in (None, 0, "0")
    # with stored spellings the terms near a word are few literal ones, too
    tokens = index.near_terms(field, [(t, edits_of(t, fuzziness)) for _, t, _ in terms]) if fuzzy else [t for _, t, _ in terms]
    vocab = index.vocabulary(field, tokens).select("token", "df", "ttf", "term_bucket")
    if fuzzy:
        wanted = expand_terms(vocab, terms, fuzziness, prefix_length, max_expansions)
        # any number of rows: Spark decides by size how to join them
    else:
        # one row per literal query term
        wanted = F.broadcast(vocab.join(F.broadcast(_terms_frame(index.spark, terms)), "token"))
    rows = index.postings(field, tokens).select("token", "_id", "tf", "dl").join(wanted, "token")
    score = formula(F.col("tf"), F.col("dl"), F.col("df"), F.col("ttf"), stats, spec.norms)
    return rows.select("_id", "term_idx", (F.lit(spec.boost) * F.col("weight") * score).alias("score"))


def match_scores(index: Collection, field: str, text: str, analyzer: Analyzer | None = None, boost: float = 1.0, operator: str = "OR", **fuzzy) -> DataFrame:
    """``(_id, score)`` of a match query."""
    tokens = query_terms(index.spark, analyzer or index.text[field].search_analyzer, text)
    terms = [(i, t, boost) for i, (_, t) in enumerate(tokens)]
    if not terms:
        return no_hits(index.spark)
    rows = term_scores(index, field, terms, **fuzzy)
    if operator.upper() == "AND":
        found = rows.groupBy("_id").agg(F.sum("score").alias("score"), F.size(F.collect_set("term_idx")).alias("n"))
        return found.where(F.col("n") == len(terms)).select("_id", "score")
    return rows.groupBy("_id").agg(F.sum("score").alias("score"))


def no_hits(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT CAST(NULL AS STRING) AS _id, CAST(NULL AS DOUBLE) AS score WHERE false")


def phrase_scores(index: Collection, field: str, text: str, analyzer: Analyzer | None = None, boost: float = 1.0, last_is_prefix: bool = False) -> DataFrame:
    """``(_id, score)`` of documents in which the words stand next to each other.

    Each word's positions are shifted back by its place in the phrase; a document
    matches where all shifted lists meet. Only the phrase's postings are read.
    """
    spec, stats = index.text[field], index.stats[field]
    if spec.options not in ("positions", "offsets"):
        raise ValueError(f"{field} was indexed without positions")
    tokens = query_terms(index.spark, analyzer or spec.quote_analyzer, text)
    if not tokens:
        return no_hits(index.spark)
    n, first = len(tokens), tokens[0][0]
    exact = tokens[:-1] if last_is_prefix else tokens
    parts = []
    if exact:
        literal = [t for _, t in exact]
        terms = _terms_frame(index.spark, [(i, t, float(p - first)) for i, (p, t) in enumerate(exact)])
        wanted = F.broadcast(index.vocabulary(field, literal).select("token", "df").join(F.broadcast(terms), "token"))
        parts.append(index.postings(field, literal).select("token", "_id", "dl", "positions").join(wanted, "token"))
    if last_is_prefix:
        p, t = tokens[-1]
        # the unfinished word counts as its most frequent completion
        top = index.vocabulary(field, prefix=t).agg(F.max("df").alias("df")).scalar()
        rows = index.prefix_postings(field, t).select("token", "_id", "dl", "positions")
        parts.append(rows.select("*", top.alias("df"), F.lit(n - 1).alias("term_idx"), F.lit(float(p - first)).alias("weight")))
    rows = parts[0].select("_id", "dl", "df", "term_idx", "weight", "positions")
    for more in parts[1:]:
        rows = rows.unionByName(more.select(*rows.columns))
    shifted = rows.select(
        "_id", "dl", "term_idx", idf(F.col("df"), stats).alias("idf"),
        F.transform("positions", lambda x: x - F.col("weight").cast("int")).alias("bases"),
    )
    per_doc = shifted.groupBy("_id").agg(
        F.first("dl").alias("dl"),
        # one entry per phrase word (or per completion of the last one) of this one document
        F.collect_list(F.struct("term_idx", "idf", "bases")).alias("words"),
    )

    def bases_of(i: int) -> Column:
        return F.array_distinct(F.flatten(F.transform(F.filter("words", lambda w: w["term_idx"] == i), lambda w: w["bases"])))

    def idf_of(i: int) -> Column:
        return F.element_at(F.transform(F.filter("words", lambda w: w["term_idx"] == i), lambda w: w["idf"]), 1)

    meet = bases_of(0)
    for i in range(1, n):
        meet = F.array_intersect(meet, bases_of(i))
    complete = F.size(F.array_distinct(F.transform("words", lambda w: w["term_idx"]))) == n
    found = per_doc.where(complete).select("_id", "dl", F.size(meet).alias("tf"), sum((idf_of(i) for i in range(1, n)), idf_of(0)).alias("idf"))
    score = F.lit(boost * spec.boost) * F.col("idf") * saturation(F.col("tf"), F.col("dl"), stats, spec.norms)
    return found.where(F.col("tf") > 0).select("_id", score.alias("score"))


def multi_match_scores(index: Collection, fields: list[tuple[str, float]], text: str, analyzer: Analyzer | None, kind: str, operator: str, **fuzzy) -> DataFrame:
    """``(_id, score)`` over several fields; one shuffle for all fields together."""
    if kind in ("phrase", "phrase_prefix"):
        parts = [phrase_scores(index, f, text, analyzer, b, kind == "phrase_prefix") for f, b in fields]
        return union_all(parts).groupBy("_id").agg(F.max("score").alias("score"))
    rows, counts = [], {}
    for no, (field, boost) in enumerate(fields):
        tokens = [t for _, t in query_terms(index.spark, analyzer or index.text[field].search_analyzer, text)]
        head = tokens[:-1] if kind == "bool_prefix" else tokens
        counts[no] = len(tokens)
        if head:
            part = term_scores(index, field, [(i, t, boost) for i, t in enumerate(head)], **fuzzy)
            rows.append(part.select("_id", F.lit(no).alias("field_no"), "term_idx", "score"))
        if kind == "bool_prefix" and tokens:
            some = index.prefix_postings(field, tokens[-1]).select("_id").distinct()
            rows.append(some.select("_id", F.lit(no).alias("field_no"), F.lit(len(tokens) - 1).alias("term_idx"), F.lit(boost).alias("score")))
    if not rows:
        return no_hits(index.spark)
    hits = union_all(rows)
    every = operator.upper() == "AND"
    if kind == "cross_fields":
        best = hits.groupBy("_id", "term_idx").agg(F.max("score").alias("score"))
        per_doc = best.groupBy("_id").agg(F.sum("score").alias("score"), F.count(F.lit(1)).alias("n"))
        return (per_doc.where(F.col("n") == max(counts.values())) if every else per_doc).select("_id", "score")
    aggs = []
    for no in counts:
        here = F.col("field_no") == no
        aggs.append(F.sum(F.when(here, F.col("score"))).alias(f"s{no}"))
        if every:
            aggs.append(F.size(F.collect_set(F.when(here, F.col("term_idx")))).alias(f"n{no}"))
    per_doc = hits.groupBy("_id").agg(*aggs)
    scores = [F.when(F.col(f"n{no}") == counts[no], F.col(f"s{no}")) if every else F.col(f"s{no}") for no in counts]
    if kind == "best_fields":
        total = F.greatest(*scores) if len(scores) > 1 else scores[0]
    else:
        total = sum((F.coalesce(s, F.lit(0.0)) for s in scores[1:]), F.coalesce(scores[0], F.lit(0.0)))
    some = scores[0].isNotNull()
    for s in scores[1:]:
        some = some | s.isNotNull()
    return per_doc.where(some).select("_id", total.alias("score"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
