"""Index tables of a text field, each one declarative job.

``terms_of`` groups the tokens of a document inside its own row by sorting, so
building postings needs no shuffle at all; document length and frequencies ride
along and no query has to join them back.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, functions as F

from textloom.functions.arrays import let, run_starts

TERMS = "array<struct<token:string,tf:int,positions:array<int>>>"


def terms_of(tokens: Column, positions: bool = True, freqs: bool = True) -> Column:
    """Token array to ``array<struct<token, tf, positions>>``, one entry per distinct token."""
    # structs sort by token, then by position
    def build(a: Column) -> Column:
        end = F.size(a) + 1

        def entries(starts: Column) -> Column:
            def one(s: Column, k: Column) -> Column:
                n = F.coalesce(F.get(starts, k + 1), end) - s
                where = F.transform(F.slice(a, s, n), lambda p: p["position"]) if positions else F.lit(None).cast("array<int>")
                return F.struct(
                    F.element_at(a, s)["token"].alias("token"), (n if freqs else F.lit(1)).alias("tf"), where.alias("positions")
                )

            return F.transform(starts, one)

        return F.when(F.size(a) > 0, let(run_starts(a, lambda p: p["token"]), entries)).otherwise(F.array().cast(TERMS))

    return let(F.sort_array(tokens), build)


def term_bucket(token: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(token.cast("binary")), F.lit(buckets)).cast("int")


def bucket_of(token: str, buckets: int) -> int:
    """The bucket of a literal token, so that queries name their partitions."""
    return zlib.crc32(token.encode("utf-8")) % buckets


def postings(forward: DataFrame, buckets: int) -> DataFrame:
    """One row per (field, token, document); ``forward`` has one row per (field, document)."""
    return (
        forward.select("field", "_id", "dl", F.explode("terms").alias("t"))
        .select("field", "t.token", "_id", F.col("t.tf").cast("bigint").alias("tf"), "dl", "t.positions")
        .withColumn("term_bucket", term_bucket(F.col("token"), buckets))
    )


def vocabulary(forward: DataFrame, buckets: int) -> DataFrame:
    """Document frequency and total frequency per term; counts combine before the shuffle."""
    return (
        forward.select("field", F.explode("terms").alias("t"))
        .groupBy("field", F.col("t.token").alias("token"))
        .agg(F.count(F.lit(1)).alias("df"), F.sum("t.tf").cast("bigint").alias("ttf"))
        .withColumn("term_bucket", term_bucket(F.col("token"), buckets))
    )


def field_stats(forward: DataFrame) -> DataFrame:
    return forward.groupBy("field").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("dl").cast("bigint").alias("n_tokens"))
