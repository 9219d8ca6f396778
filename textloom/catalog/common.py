"""Shared pieces of the registered queries: table access and SQL fragments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textloom.operators.analyzers import Analyzer
from textloom.operators.tokenizers import STANDARD
from textloom.session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Add a query and, where there is one, its SQL twin."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").withColumn("_id", F.col("doc_id").cast("string"))


def texts(spark: SparkSession, sf: str, text: Column | None = None, *more: str) -> DataFrame:
    """``_id`` and a text, spread over the cores for analysis; only these columns are read."""
    df = documents(spark, sf).select("_id", "text", *more)
    df = spread(df)
    return df if text is None else df.withColumn("text", text)


def census(df: DataFrame, analyzer: Analyzer, *extra: str, types: bool = False) -> DataFrame:
    """Analyze and count: per token (and extra fields) the number and the sum of positions."""
    ts = analyzer.tokens(F.col("text"), types=types)
    return (
        df.select(F.explode(ts.array()).alias("t"))
        .groupBy(F.col("t.token").alias("token"), *[F.col(f"t.{e}").alias(e) for e in extra])
        .agg(F.count(F.lit(1)).alias("n"), F.sum("t.position").cast("bigint").alias("pos_sum"))
    )


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


STD = f"regexp_extract_all(text, {q(STANDARD)})"
STD_LOW = f"list_transform({STD}, lambda x: lower(x))"


def sql_tokens(words: str, source: str = "documents", _id: str = "CAST(doc_id AS VARCHAR)", more: str = "") -> str:
    """SQL of a token table ``(_id, token, position)`` from a list expression."""
    extra = f", {more}" if more else ""
    return (
        f"SELECT _id, unnest(l) AS token, generate_subscripts(l, 1) - 1 AS position{extra} "
        f"FROM (SELECT {_id} AS _id, {words} AS l{extra} FROM {source}) s0"
    )


def sql_census(tokens: str, *extra: str) -> str:
    keys = ", ".join(("token", *extra))
    return f"SELECT {keys}, count(*) AS n, CAST(sum(position) AS BIGINT) AS pos_sum FROM ({tokens}) s1 GROUP BY {keys}"


def sql_map(expr: str, words: str = STD_LOW) -> str:
    """Census of the standard tokens with an expression in place of the token."""
    return sql_census(f"SELECT {expr} AS token, position FROM ({sql_tokens(words)}) s2")


def sql_where(cond: str, words: str = STD_LOW) -> str:
    return sql_census(f"SELECT token, position FROM ({sql_tokens(words)}) s2 WHERE {cond}")


def sql_expand(list_expr: str, words: str = STD_LOW) -> str:
    """Census with each token replaced by a list of tokens at its position."""
    return sql_census(f"SELECT unnest({list_expr}) AS token, position FROM ({sql_tokens(words)}) s2")


def sql_table(expr: str, mapping: dict[str, str]) -> str:
    """The character table as translate and replace calls."""
    from textloom.functions.charmaps import split_map

    src, dst, longer = split_map(mapping)
    out = expr
    for k, v in longer:
        out = f"replace({out}, {q(k)}, {q(v)})"
    if src:
        out = f"translate({out}, {q(src)}, {q(dst)})"
    if any(k.isascii() for k in mapping):
        return out
    return f"(CASE WHEN regexp_matches({expr}, '[^\\x00-\\x7F]') THEN {out} ELSE {expr} END)"
