"""Query operators, paging, sorting and projection over whole collections."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textloom.catalog import sqlscore as S
from textloom.catalog.common import q, register, table
from textloom.catalog.indexes import index_for
from textloom.operators.batch import batch_search
from textloom.plans import compile as plan, queries as Q, search as R

TEXT = S.field("f")


def scored(key: str, query: Q.Query, sql: str, index: str = "documents") -> None:
    """Register all hits of a query as ``(_id, _score)``."""

    def run(spark, sf) -> DataFrame:
        return plan.hits(index_for(spark, sf, index), query).select("_id", F.round("score", 6).alias("_score"))

    register(key, sql)(run)


def page(key: str, request: R.Search, sql: str, index: str = "documents") -> None:
    register(key, sql)(lambda spark, sf: R.run(index_for(spark, sf, index), request))


def on_docs(where: str, score: str = "1::DOUBLE") -> str:
    return f"WITH {S.DOCS} SELECT _id, {score} AS _score FROM wd WHERE {where}"


# --- queries on stored columns

scored("q_match_all", Q.MatchAll(), on_docs("true"))
scored("q_exists", Q.Exists("origin"), on_docs("origin IS NOT NULL"))
scored("q_term", Q.Term("lang", "de"), on_docs("lang = 'de'"))
scored("q_terms", Q.Term("source", ["src1", "src3", "src5"]), on_docs("source IN ('src1', 'src3', 'src5')"))
scored("q_prefix", Q.Prefix("source", "src1"), on_docs("starts_with(source, 'src1')"))
scored("q_prefix_text", Q.Prefix("text", "nich"), f"WITH {TEXT} SELECT DISTINCT _id, 1::DOUBLE AS _score FROM f_tok WHERE starts_with(token, 'nich')")
scored("q_range", Q.Range("n_chars", gte=500, lt=1500), on_docs("n_chars >= 500 AND n_chars < 1500"))
scored(
    "q_range_date", Q.Range("o_orderdate", gte="1996-010", lt="1996-200", format="ordinal_date"),
    "SELECT CAST(o_orderkey AS VARCHAR) AS _id, 1::DOUBLE AS _score FROM orders WHERE o_orderdate >= DATE '1996-01-01' + 9 AND o_orderdate < DATE '1996-01-01' + 199", "orders",
)
scored("q_range_overlap", Q.Range("sizes", gte=12, lt=15), f"SELECT {S.PART_ID} AS _id, 1::DOUBLE AS _score FROM part WHERE p_size < 15 AND p_size + 10 >= 12", "part")
_A = "pow(sin(radians({lat} - 48.5::DOUBLE) / 2), 2) + cos(radians(48.5::DOUBLE)) * cos(radians({lat})) * pow(sin(radians({lon} - 2.25::DOUBLE) / 2), 2)"
_A = _A.format(lat="lat", lon="lon")
scored(
    "q_geo_distance", Q.GeoDistance("location", "4500km", 48.5, 2.25),
    f"SELECT _id, 1::DOUBLE AS _score FROM (SELECT CAST(s_suppkey AS VARCHAR) AS _id, CAST(s_suppkey * 37 % 180 - 90 AS DOUBLE) AS lat, CAST(s_suppkey * 53 % 360 - 180 AS DOUBLE) AS lon FROM supplier) s WHERE 2 * 6371008.7714::DOUBLE * asin(sqrt(least(1::DOUBLE, {_A}))) <= 4500000", "supplier",
)
scored(
    "q_nested", Q.Nested("lines", Q.Bool(must=(Q.Range("lines.chars", gte=300),), must_not=(Q.Term("lines.no", 0),))),
    f"SELECT CAST(doc_id AS VARCHAR) AS _id, 1::DOUBLE AS _score FROM documents WHERE len(list_filter(string_split(text, chr(10))[2:], lambda x: length(x) >= 300)) > 0",
)

# --- queries on text

scored("q_match_or", Q.Match("text", "thble Attion the nicht"), f"WITH {TEXT} {S.hits(S.match('f', ['thble', 'attion', 'the', 'nicht']))}")
scored("q_match_and", Q.Match("text", "thing ering of", operator="AND"), f"WITH {TEXT} {S.hits(S.match('f', ['thing', 'ering', 'of'], every=True))}")
scored("q_match_boost", Q.Match("text", "thing oning thing", boost=2.5), f"WITH {TEXT} {S.hits(S.match('f', ['thing', 'oning', 'thing'], '2.5::DOUBLE'))}")
scored(
    "q_match_fuzzy", Q.Match("text", "thable nichd", fuzziness=1, prefix_length=2),
    f"WITH {TEXT} SELECT _id, round(sum(score), 6) AS _score FROM ({S.fuzzy_rows('f', ['thable', 'nichd'], '1', 2)}) x GROUP BY _id",
)
scored(
    "q_fuzzy_auto", Q.Match("text", "attoin nichd er", fuzziness="AUTO"),
    f"WITH {TEXT} SELECT _id, round(sum(score), 6) AS _score FROM ({S.fuzzy_rows('f', ['attoin', 'nichd', 'er'], S.AUTO)}) x GROUP BY _id",
)
scored("q_fuzzy_all_terms", Q.Match("text", "attoin nichd", fuzziness=2, operator="AND"),
       f"WITH {TEXT} SELECT _id, round(sum(score), 6) AS _score FROM ({S.fuzzy_rows('f', ['attoin', 'nichd'], '2')}) x GROUP BY _id HAVING count(DISTINCT i) = 2")
scored("q_phrase", Q.Phrase("text", "of the"), f"WITH {TEXT} {S.hits(S.phrase('f', ['of', 'the']))}")
scored("q_phrase_repeat", Q.Phrase("text", "the the of"), f"WITH {TEXT} {S.hits(S.phrase('f', ['the', 'the', 'of']))}")
scored("q_phrase_prefix", Q.PhrasePrefix("text", "of th"), f"WITH {TEXT} {S.hits(S.phrase('f', ['of', 'th'], True))}")
scored("q_phrase_turns", Q.Phrase("text", "of the"), f"WITH {S.field('f', source='conversations', _id='''conv_id || '-' || turn''')} {S.hits(S.phrase('f', ['of', 'the']))}", "conversations")

# --- several fields

PARTS = ", ".join([S.part_field("a", "p_name"), S.part_field("b", "p_type"), S.part_field("c", "p_brand")])
_FIELDS = ("p_name^2", "p_type", "p_brand")


def _per_field(terms: list[str], select: str, every: bool = False) -> str:
    parts = " UNION ALL ".join(
        f"SELECT _id, {i} AS fno, score * {b}::DOUBLE AS score FROM ({S.match(n, terms, every=every)}) m{i}" for i, (n, b) in enumerate((("a", 2), ("b", 1), ("c", 1)))
    )
    return f"WITH {PARTS} SELECT _id, round({select}(score), 6) AS _score FROM ({parts}) u GROUP BY _id"


scored("q_mm_best", Q.MultiMatch(_FIELDS, "large widget brand 14"), _per_field(["large", "widget", "brand", "14"], "max"), "part")
scored("q_mm_best_and", Q.MultiMatch(_FIELDS, "large widget", operator="AND"), _per_field(["large", "widget"], "max", True), "part")
scored("q_mm_most", Q.MultiMatch(_FIELDS, "large widget promo", "most_fields"), _per_field(["large", "widget", "promo"], "sum"), "part")
_CROSS = " UNION ALL ".join(
    f"SELECT s._id, w.i, s.score * {b}::DOUBLE AS score FROM {n}_s s JOIN (VALUES (0, 'large'), (1, 'widget'), (2, '14')) w(i, token) ON w.token = s.token" for n, b in (("a", 2), ("b", 1), ("c", 1))
)
scored(
    "q_mm_cross", Q.MultiMatch(_FIELDS, "large widget 14", "cross_fields", operator="AND"),
    f"WITH {PARTS} SELECT _id, round(sum(score), 6) AS _score FROM (SELECT _id, i, max(score) AS score FROM ({_CROSS}) u GROUP BY 1, 2) v GROUP BY _id HAVING count(*) = 3", "part",
)
scored(
    "q_mm_phrase", Q.MultiMatch(_FIELDS, "brand 14", "phrase"),
    f"WITH {PARTS} SELECT _id, round(max(score), 6) AS _score FROM (SELECT _id, 2 * score AS score FROM ({S.phrase('a', ['brand', '14'])}) x UNION ALL {S.phrase('b', ['brand', '14'])} UNION ALL {S.phrase('c', ['brand', '14'])}) u GROUP BY _id", "part",
)
scored(
    "q_mm_phrase_prefix", Q.MultiMatch(("p_name^2", "p_brand"), "large w", "phrase_prefix"),
    f"WITH {PARTS} SELECT _id, round(max(score), 6) AS _score FROM (SELECT _id, 2 * score AS score FROM ({S.phrase('a', ['large', 'w'], True)}) x UNION ALL {S.phrase('c', ['large', 'w'], True)}) u GROUP BY _id", "part",
)
scored(
    "q_mm_bool_prefix", Q.MultiMatch(("p_name", "p_type"), "large wi", "bool_prefix"),
    f"WITH {PARTS} SELECT _id, round(sum(score), 6) AS _score FROM ({S.match('a', ['large'])} UNION ALL {S.match('b', ['large'])} UNION ALL SELECT DISTINCT _id, 1::DOUBLE FROM a_tok WHERE starts_with(token, 'wi') UNION ALL SELECT DISTINCT _id, 1::DOUBLE FROM b_tok WHERE starts_with(token, 'wi')) u GROUP BY _id", "part",
)
scored(
    "q_mm_fuzzy", Q.MultiMatch(("p_name", "p_type"), "lrge widgt", fuzziness="AUTO"),
    f"WITH {PARTS} SELECT _id, round(max(score), 6) AS _score FROM (SELECT _id, 0 AS fno, sum(score) AS score FROM ({S.fuzzy_rows('a', ['lrge', 'widgt'], S.AUTO)}) x GROUP BY 1 UNION ALL SELECT _id, 1, sum(score) FROM ({S.fuzzy_rows('b', ['lrge', 'widgt'], S.AUTO)}) y GROUP BY 1) u GROUP BY _id", "part",
)

# --- boolean combinations

_BOOL = Q.Bool(must=(Q.Match("text", "thble attion"),), filter=(Q.Term("lang", "en"), Q.Range("n_chars", gte=800)), should=(Q.Match("text", "thing"), Q.Term("source", "src1")), must_not=(Q.Prefix("source", "src2"),))
_BOOL_SQL = f"""SELECT m._id, m.score + coalesce(t.score, 0) + CASE WHEN d.source = 'src1' THEN 1::DOUBLE ELSE 0 END AS score
  FROM ({S.match('f', ['thble', 'attion'])}) m JOIN wd d ON d._id = m._id LEFT JOIN ({S.match('f', ['thing'])}) t ON t._id = m._id
  WHERE lang = 'en' AND n_chars >= 800 AND NOT starts_with(source, 'src2')"""
scored("q_bool", _BOOL, f"WITH {S.DOCS}, {TEXT} {S.hits(_BOOL_SQL)}")
scored(
    "q_bool_nested", Q.Bool(should=(Q.Bool(must=(Q.Match("text", "thble"), Q.Term("lang", "en"))), Q.Bool(must=(Q.Match("text", "nicht"),), must_not=(Q.Exists("origin"),)))),
    f"""WITH {S.DOCS}, {TEXT} SELECT _id, round(sum(score), 6) AS _score FROM (
      SELECT m._id, m.score + 1 AS score FROM ({S.match('f', ['thble'])}) m JOIN wd d ON d._id = m._id WHERE lang = 'en'
      UNION ALL SELECT m._id, m.score FROM ({S.match('f', ['nicht'])}) m JOIN wd d ON d._id = m._id WHERE origin IS NULL) u GROUP BY _id""",
)
scored(
    "q_bool_must_not", Q.Bool(must_not=(Q.Match("text", "the"), Q.Term("lang", "fr"))),
    f"WITH {S.DOCS}, {TEXT} SELECT _id, 0::DOUBLE AS _score FROM wd WHERE lang <> 'fr' AND _id NOT IN (SELECT _id FROM f_tok WHERE token = 'the')",
)
scored(
    "q_bool_columns", Q.Bool(filter=(Q.Term("lang", ["en", "fr"]),), should=(Q.Range("n_chars", gte=1000), Q.Exists("origin")), must_not=(Q.Term("source", "src0"),)),
    on_docs("lang IN ('en', 'fr') AND source <> 'src0'", "CAST((n_chars >= 1000)::INT + (origin IS NOT NULL)::INT AS DOUBLE)"),
)


@register("q_script_score", f"WITH {S.DOCS}, {TEXT} SELECT m._id, round(d.weight * m.score / 3::DOUBLE + ln(d.n_chars), 6) AS _score FROM ({S.match('f', ['thble', 'thing'])}) m JOIN wd d ON d._id = m._id")
def q_script_score(spark, sf):
    request = R.Search(must=(Q.Match("text", "thble thing"),), score_script=Q.Script("weight * _score / params.by + ln(n_chars)", {"by": 3.0}))
    return R.matched(index_for(spark, sf, "documents"), request).select("_id", "_score")


# --- requests: projection, paging, sorting

page("bm25_topk", R.Search(must=(Q.Match("text", "the thble attion nicht"),), size=10, source=("lang", "source")), f"WITH {S.DOCS}, {TEXT} {S.top(S.match('f', ['the', 'thble', 'attion', 'nicht']), 'lang, source', 'wd', 10)}")
page("source_filter", R.Search(match_all=True, size=None, source=("la*", "n_*"), sort=(("n_chars", "desc"),)), f"WITH {S.DOCS} SELECT _id, NULL::DOUBLE AS _score, lang, n_chars FROM wd")
page("search_limit", R.Search(match_all=True, size=2000, sort=(("o_totalprice", "desc"),), source=("o_totalprice",)), "SELECT CAST(o_orderkey AS VARCHAR) AS _id, NULL::DOUBLE AS _score, o_totalprice FROM orders ORDER BY o_totalprice DESC, _id LIMIT 2000", "orders")
page("search_from", R.Search(must=(Q.Match("text", "thing oning"),), from_=20, size=15, source=("lang",)), f"WITH {S.DOCS}, {TEXT} {S.top(S.match('f', ['thing', 'oning']), 'lang', 'wd', 15, 20)}")
page(
    "search_after", R.Search(filter=(Q.Term("o_orderstatus", "F"),), sort=(("o_orderpriority", "desc"), ("o_totalprice", "asc")), search_after=("3-MEDIUM", 200000.0), size=40, source=("o_orderpriority", "o_totalprice")),
    "SELECT CAST(o_orderkey AS VARCHAR) AS _id, NULL::DOUBLE AS _score, o_orderpriority, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND (o_orderpriority < '3-MEDIUM' OR (o_orderpriority = '3-MEDIUM' AND o_totalprice > 200000)) ORDER BY o_orderpriority DESC, o_totalprice, _id LIMIT 40", "orders",
)
page("sort_fields", R.Search(filter=(Q.Range("n_chars", gte=400),), sort=(("origin", "asc"), ("n_chars", "desc")), size=100, source=("origin", "n_chars")), f"WITH {S.DOCS} SELECT _id, NULL::DOUBLE AS _score, origin, n_chars FROM wd WHERE n_chars >= 400 ORDER BY origin ASC NULLS LAST, n_chars DESC, _id LIMIT 100")
page("sort_script", R.Search(match_all=True, sort_script=(Q.Script("n_chars * params.f % 1000", {"f": 7}), "desc", "number"), size=60, source=("n_chars",)), f"WITH {S.DOCS} SELECT _id, NULL::DOUBLE AS _score, n_chars FROM wd ORDER BY n_chars * 7 % 1000 DESC, _id LIMIT 60")
page("track_scores", R.Search(must=(Q.Match("text", "thble"),), sort=(("n_chars", "asc"),), track_scores=True, size=30, source=("n_chars",)), f"WITH {S.DOCS}, {TEXT} SELECT d._id, round(score, 6) AS _score, n_chars FROM ({S.match('f', ['thble'])}) m JOIN wd d ON d._id = m._id ORDER BY n_chars, d._id LIMIT 30")


@register("read_all", "SELECT CAST(o_orderkey AS VARCHAR) AS _id, NULL::DOUBLE AS _score, o_totalprice FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def read_all(spark, sf):
    request = R.Search(filter=(Q.Term("o_orderpriority", ["1-URGENT", "2-HIGH"]),), sort=(("o_totalprice", "desc"),), source=("o_totalprice",))
    return R.read_all(index_for(spark, sf, "orders"), request)


@register("transform_limit", "SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_totalprice, o_custkey % 10 AS digit FROM orders WHERE o_custkey % 3 = 0 AND o_orderstatus = 'O' ORDER BY o_totalprice DESC, _id LIMIT 70")
def transform_limit(spark, sf):
    request = R.Search(filter=(Q.Term("o_orderstatus", "O"),), sort=(("o_totalprice", "desc"),))
    fn = lambda df: df.where("o_custkey % 3 = 0").select("_id", "o_totalprice", (F.col("o_custkey") % 10).alias("digit"))
    return R.transformed(index_for(spark, sf, "orders"), request, fn, 70)


@register("transform_expand", f"SELECT CAST(o_orderkey AS VARCHAR) AS _id, part FROM (SELECT o_orderkey, unnest(string_split(o_orderpriority, '-')) AS part, o_totalprice FROM orders WHERE o_orderstatus = 'P') x ORDER BY o_totalprice DESC, _id, part LIMIT 75")
def transform_expand(spark, sf):
    """A function that makes two rows of each hit."""
    request = R.Search(filter=(Q.Term("o_orderstatus", "P"),), sort=(("o_totalprice", "desc"),))
    fn = lambda df: df.select("_id", F.explode(F.split("o_orderpriority", "-")).alias("part"))
    return R.transformed(index_for(spark, sf, "orders"), request, fn, 75)


@register("total_hits", f"WITH {S.DOCS}, {TEXT} SELECT count(*) AS total FROM ({S.match('f', ['the', 'nicht'])}) m JOIN wd d ON d._id = m._id WHERE n_chars < 5000")
def total_hits(spark, sf):
    return R.total(index_for(spark, sf, "documents"), R.Search(must=(Q.Match("text", "the nicht"),), filter=(Q.Range("n_chars", lt=5000),)))


page("search_full", R.Search(must=_BOOL.must, filter=_BOOL.filter, should=_BOOL.should, must_not=_BOOL.must_not, from_=5, size=25, source=("lang", "n_chars")), f"WITH {S.DOCS}, {TEXT} {S.top(_BOOL_SQL, 'lang, n_chars', 'wd', 25, 5)}")


@register(
    "batch_search",
    f"""WITH {TEXT}, qt AS (SELECT item_id AS query_id, unnest({S.STD_LOW}) AS token FROM benchmark)
    SELECT query_id, rank, _id, _score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY _score DESC, _id) AS rank FROM (
      SELECT query_id, s._id, round(sum(score), 6) AS _score FROM qt JOIN f_s s ON s.token = qt.token GROUP BY 1, 2) x) y WHERE rank <= 10""",
)
def batch(spark, sf):
    queries = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    found = batch_search(index_for(spark, sf, "documents"), queries, "text", k=10)
    return found.withColumn("rank", F.col("rank").cast("bigint"))


def _asked(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


_QT = "SELECT item_id AS query_id, unnest({words}) AS token FROM benchmark"
_BEST = "SELECT query_id, rank, _id, _score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY _score DESC, _id) AS rank FROM ({inner}) x) y WHERE rank <= {k}"


@register(
    "batch_search_lm",
    f"WITH {S.field('t', source='conversations', _id=S.TURN_ID, formula='LMJelinekMercer')}, qt AS ({_QT.format(words=S.STD_LOW)}) "
    + _BEST.format(inner="SELECT query_id, s._id, round(sum(score), 6) AS _score FROM qt JOIN t_s s ON s.token = qt.token GROUP BY 1, 2", k=5),
)
def batch_lm(spark, sf):
    """Many queries on a field with another similarity."""
    index = index_for(spark, sf, "turns_lm")
    return batch_search(index, _asked(spark, sf), "text", k=5).withColumn("rank", F.col("rank").cast("bigint"))


_NAMES = "SELECT DISTINCT p_name AS query_id, unnest(list_transform(regexp_extract_all(p_name, '[\\p{L}\\p{N}]+'), lambda x: lower(substr(x, 2)))) AS token FROM part"


@register(
    "batch_fuzzy",
    f"""WITH {S.part_field('a', 'p_name')}, qt AS ({_NAMES}), need AS (SELECT query_id, count(*) AS n FROM qt GROUP BY 1),
    near AS (SELECT q.query_id, q.token AS term, f.token, 1::DOUBLE - levenshtein(q.token, f.token) / least(length(q.token), length(f.token))::DOUBLE AS w FROM qt q JOIN a_df f ON levenshtein(q.token, f.token) <= 1)
    """
    + _BEST.format(inner="SELECT query_id, _id, _score FROM (SELECT e.query_id, s._id, round(sum(e.w * s.score), 6) AS _score, count(DISTINCT e.term) AS c FROM near e JOIN a_s s ON s.token = e.token WHERE e.w > 0 GROUP BY 1, 2) x JOIN need USING (query_id) WHERE c = n", k=5),
)
def batch_fuzzy(spark, sf):
    """Names without the first letter of each word, all words asked for, one edit allowed."""
    words = F.transform(F.regexp_extract_all("p_name", F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)), lambda x: F.substring(x, F.lit(2), F.length(x)))
    asked = table(spark, sf, "part").select(F.col("p_name").alias("query_id"), F.array_join(words, " ").alias("text")).distinct()
    return batch_search(index_for(spark, sf, "part"), asked, "p_name", k=5, operator="AND", fuzziness=1).withColumn("rank", F.col("rank").cast("bigint"))


@register(
    "q_match_docs_only",
    f"WITH {S.field('t', source='conversations', _id=S.TURN_ID)}, u AS (SELECT t._id, ln(1::DOUBLE + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * 2.2::DOUBLE / (1::DOUBLE + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / (c::DOUBLE / n))) AS score FROM t_tf t JOIN t_dl d ON d._id = t._id JOIN t_df f ON f.token = t.token, t_st WHERE t.token IN ('the', 'and')) "
    "SELECT _id, round(sum(score), 6) AS _score FROM u GROUP BY _id",
)
def q_match_docs_only(spark, sf):
    """Without frequencies a word counts once, and the length is still that of the text."""
    return plan.hits(index_for(spark, sf, "turns_docs"), Q.Match("text", "the and")).select("_id", F.round("score", 6).alias("_score"))


@register(
    "q_nested_text",
    f"SELECT CAST(conv_id AS VARCHAR) AS _id, 1::DOUBLE AS _score FROM (SELECT conv_id, bool_or(role = 'user' AND list_contains({S.STD_LOW}, 'the') AND list_contains({S.STD_LOW}, 'of')) AS hit FROM conversations GROUP BY 1) c WHERE hit",
)
def q_nested_text(spark, sf):
    """Some turn of the user holds both words."""
    inner = Q.Bool(must=(Q.Match("turns.text", "Of the", operator="AND"), Q.Term("turns.role", "user")))
    return plan.hits(index_for(spark, sf, "threads"), Q.Nested("turns", inner)).select("_id", F.round("score", 6).alias("_score"))
