"""Bounded samples of labelled rows, for models that are fitted on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textloom.llm.catalog import held_out, id_and_text


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, limit: int) -> DataFrame:
    """``doc_id, label, text`` of at most ``limit`` labelled rows that are not held out.

    The rows are the first by a hash of the id, so the sample does not depend on the order of the
    tables. Rows without a label are left out; of several labels of an id the largest counts, of
    several texts one.
    """
    ids = (
        labels.select(F.col("doc_id").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .filter(F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    # the limit bounds the broadcast side
    return id_and_text(docs).join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("label").alias("label"), F.min("text").alias("text"))
