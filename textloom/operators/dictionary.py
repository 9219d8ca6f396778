"""Token filters driven by word *tables*, over an exploded token table.

The table side carries no broadcast hint: Spark broadcasts it when its measured
size is below the session's threshold and shuffles otherwise, and adaptive
execution splits the partitions of very common tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def stop_by_table(tokens: DataFrame, words: DataFrame, on: tuple[str, ...] = ("lang", "token")) -> DataFrame:
    """Drop tokens that the table lists."""
    return tokens.join(words, list(on), "left_anti")


def keep_by_table(tokens: DataFrame, words: DataFrame, on: tuple[str, ...] = ("token",)) -> DataFrame:
    """Keep only tokens that the table lists."""
    return tokens.join(words, list(on), "left_semi")


def stem_by_table(tokens: DataFrame, stems: DataFrame, on: tuple[str, ...] = ("lang", "token"), exclusions: DataFrame | None = None) -> DataFrame:
    """Replace tokens by the table's stem; excluded words stay."""
    if exclusions is not None:
        stems = stems.join(exclusions, list(on), "left_anti")
    return (
        tokens.join(stems, list(on), "left")
        .withColumn("token", F.coalesce("stem", "token"))
        .drop("stem")
    )


def synonyms_by_table(tokens: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Keep every token and add its targets ``(from_term, to_term)`` at the same position."""
    added = tokens.join(synonyms, tokens["token"] == synonyms["from_term"]).select(
        *[F.col("to_term").alias("token") if c == "token" else F.col(c) for c in tokens.columns], F.lit("SYNONYM").alias("type")
    )
    return tokens.withColumn("type", F.lit("word")).unionByName(added)


def frequent_words(tokens: DataFrame, k: int, by: str = "lang") -> DataFrame:
    """Stop word candidates: the k words of highest document frequency per language.

    ``tokens`` holds each word once per document. Counts are combined before the
    shuffle and the ranking keeps k rows per language in every task.
    """
    from pyspark.sql import Window

    df = tokens.groupBy(by, "token").agg(F.count(F.lit(1)).alias("df"))
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("df"), F.asc("token")))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)
