"""Exact duplicates: group by a 128-bit content hash, compare bytes within groups, keep one id.

The bytes are compared by the shuffle itself: one aggregation on (hash, text) leaves the distinct
texts, whose partial step reduces a hot text to one row per task. A hash with more than one text is
a collision; only for such hashes the text becomes part of the key. All later steps carry ids and
hashes, not texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textloom.llm.catalog import id_and_text, register, table
from textloom.session import materialize


def content_hash(text: Column) -> Column:
    """128 bits of the text's bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``keep`` names which id of equal texts stays, "smallest" or "largest". Null texts are empty
    texts. Rows repeated with the same id and text count once; the same id with two texts gives two
    rows. A null id never stays unless all ids of its group are null. An empty table gives no rows.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep={keep!r}; use 'smallest' or 'largest'")
    source = id_and_text(docs, id_col, text_col).withColumn("hash", hashed(F.col("text")))
    distinct_texts = source.select("hash", "text").distinct()
    collided = materialize(distinct_texts.groupBy("hash").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("hash"), "collisions")
    source = source.withColumn("variant", F.lit("").cast("binary"))
    if not collided.isEmpty():
        clash = collided.withColumnRenamed("hash", "clash")
        source = (
            source.join(clash, source["hash"] == clash["clash"], "left")
            .withColumn("variant", F.when(F.col("clash").isNotNull(), F.col("text").cast("binary")).otherwise(F.col("variant")))
            .drop("clash")
        )
    rows = source.select("doc_id", "hash", "variant", F.unhex(F.sha2("text", 256)).alias("sha")).distinct()
    kept = F.min("doc_id") if keep == "smallest" else F.max("doc_id")
    # written, so that the join below has a shuffle of its own on both sides and a hot group can be split
    groups = materialize(rows.groupBy("hash", "variant").agg(kept.alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "exact-groups")
    return rows.join(groups, ["hash", "variant"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )


def drop_exact(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """The documents that stay, with all their columns; repeated rows stay once.

    Id and text digest make one key, so the join and the removal of repeats share one shuffle.
    """
    name = "_row"
    while name in docs.columns:
        name += "_"
    row = lambda digest: F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), digest)
    staying = exact_groups(docs, keep=keep).filter("kept").select(row(F.col("text_sha256")).alias(name))
    keyed = docs.withColumn(name, row(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)))
    return keyed.join(staying, name, "left_semi").dropDuplicates([name]).drop(name)


@register(
    "op9_exact_dedup",
    """SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
              doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
       FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"), keep="largest")
