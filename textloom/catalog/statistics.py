"""Index tables, similarities and document signatures."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.catalog import sqlscore as S
from textloom.catalog.common import STD_LOW, q, register, sql_tokens, table, texts
from textloom.catalog.indexes import index_for
from textloom.operators import analyzers as A
from textloom.operators.batch import similar_documents
from textloom.operators.similarity import SIMILARITY

_TOK = f"tok AS ({sql_tokens(STD_LOW)})"


@register(
    "postings",
    f"WITH {_TOK}, dl AS (SELECT _id, count(*) AS dl FROM tok GROUP BY 1) SELECT token, t._id, count(*) AS tf, any_value(dl) AS dl, string_agg(position, ',' ORDER BY position) AS positions FROM tok t JOIN dl ON dl._id = t._id GROUP BY 1, 2",
)
def postings(spark, sf):
    return index_for(spark, sf, "documents").postings("text").select("token", "_id", "tf", "dl", F.array_join("positions", ",").alias("positions"))


@register("doc_stats", f"WITH {_TOK} SELECT 'text' AS field, _id, count(*) AS dl, count(DISTINCT token) AS n_terms FROM tok GROUP BY _id")
def doc_stats(spark, sf):
    return index_for(spark, sf, "documents").forward.select("field", "_id", "dl", F.size("terms").cast("bigint").alias("n_terms"))


@register("field_stats", f"WITH {_TOK} SELECT 'text' AS field, (SELECT count(*) FROM documents) AS n_docs, (SELECT count(*) FROM tok) AS n_tokens")
def field_stats(spark, sf):
    from textloom.operators.postings import field_stats as stats

    return stats(index_for(spark, sf, "documents").forward)


@register("vocabulary", f"WITH {_TOK} SELECT token, count(DISTINCT _id) AS df, count(*) AS ttf FROM tok GROUP BY 1")
def vocabulary(spark, sf):
    return index_for(spark, sf, "documents").vocabulary("text").select("token", "df", "ttf")


_TERMS = ("thble", "attion", "the", "nicht")


def _similarity(key: str, name: str) -> None:
    """All documents with any of the terms, scored by one formula."""

    @register(key, f"WITH {S.field('f', formula=name)} {S.hits(S.match('f', list(_TERMS)))}")
    def run(spark, sf):
        index = index_for(spark, sf, "documents")
        vocab = index.vocabulary("text", list(_TERMS)).select("token", "df", "ttf")
        rows = index.postings("text", list(_TERMS)).join(vocab, "token")
        score = SIMILARITY[name](F.col("tf"), F.col("dl"), F.col("df"), F.col("ttf"), index.stats["text"])
        return rows.groupBy("_id").agg(F.round(F.sum(score), 6).alias("_score"))


for _key, _name in (("sim_bm25", "BM25"), ("sim_lm_dirichlet", "LMDirichlet"), ("sim_lm_jm", "LMJelinekMercer"), ("sim_dfr", "DFR"), ("sim_dfi", "DFI"), ("sim_ib", "IB")):
    _similarity(_key, _name)


def _trigrams(source: str, _id: str) -> str:
    lead = lambda k: f"lead(token, {k}) OVER (PARTITION BY _id ORDER BY position)"
    return f"SELECT DISTINCT _id, token || ' ' || a || ' ' || b AS s FROM (SELECT _id, token, {lead(1)} AS a, {lead(2)} AS b FROM ({sql_tokens(STD_LOW, source, _id)}) t0) t1 WHERE b IS NOT NULL"


def _signature(source: str, _id: str) -> str:
    return f"SELECT _id, seed, min(CAST('0x' || substr(md5((seed // 4) || ':' || s), 1 + 8 * (seed % 4), 8) AS BIGINT)) AS h FROM ({_trigrams(source, _id)}) g, (SELECT unnest(range(0, 16)) AS seed) k GROUP BY 1, 2"


@register(
    "near_dups",
    f"""WITH d AS ({_signature('documents', 'CAST(doc_id AS VARCHAR)')}), b AS ({_signature('benchmark', 'item_id')}),
    n AS (SELECT _id, count(*) AS size FROM b GROUP BY 1)
    SELECT query_id, rank, _id, _score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY _score DESC, _id) AS rank FROM (
      SELECT b._id AS query_id, d._id, round(count(*) * 1::DOUBLE / any_value(n.size), 6) AS _score FROM b JOIN d ON d.seed = b.seed AND d.h = b.h JOIN n ON n._id = b._id GROUP BY 1, 2) x) y WHERE rank <= 5""",
)
def near_dups(spark, sf):
    """Documents that share min-hash tokens with a text, the nearest five of each."""
    queries = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    found = similar_documents(index_for(spark, sf, "minhash"), queries, "text", k=5)
    return found.withColumn("rank", F.col("rank").cast("bigint"))


@register(
    "dup_clusters",
    f"SELECT md5(fp) AS fingerprint, count(*) AS n, min(_id) AS first_id FROM (SELECT _id, string_agg(DISTINCT token, ' ' ORDER BY token) AS fp FROM ({sql_tokens(STD_LOW)}) t GROUP BY _id) x GROUP BY fp HAVING count(*) > 1",
)
def dup_clusters(spark, sf):
    """Texts with the same set of words; a digest stands for the fingerprint in the shuffle."""
    from textloom.operators.tokenfilters import Fingerprint, Lowercase
    from textloom.operators.tokenizers import Standard

    an = A.Analyzer(Standard(), filters=(Lowercase(), Fingerprint(max_output_size=2**31 - 1)))
    fp = A.analyze(texts(spark, sf), "text", an).select("_id", F.md5("token").alias("fingerprint"))
    clusters = fp.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("first_id"))
    return clusters.where(F.col("n") > 1)
