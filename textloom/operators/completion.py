"""Completion: many (suggester, prefix) queries against a table of suggestions.

Only the best ``size`` inputs of a prefix can be an answer, so each prefix is
reduced to them before anything is joined; a one-letter prefix that covers a
third of all inputs leaves each task as ``size`` rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F


def _best(df: DataFrame, keys: list[str], size: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("weight"), F.asc("input"), F.asc("_id"))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def _prefixes(suggestions: DataFrame, asked: DataFrame, keys: list[str]) -> DataFrame:
    """Every suggestion once per prefix of it that some query has, of whatever length."""
    lengths = asked.agg(F.collect_set(F.length("prefix"))).scalar()  # numbers up to the longest prefix
    n = F.explode(F.filter("ns", lambda n: (n > 0) & (n <= F.length("input"))))
    each = suggestions.withColumn("ns", lengths).withColumn("n", n).drop("ns").withColumn("prefix", F.lower(F.substring(F.col("input"), F.lit(1), F.col("n")))).drop("n")
    # only prefixes that are asked for reach the ranking
    return each.join(asked.select(*keys).distinct(), keys, "left_semi")


def completions(suggestions: DataFrame, queries: DataFrame, size: int = 5) -> DataFrame:
    """``(suggester_id, rank, _id, input, weight)``.

    ``suggestions``: (_id, field, input, weight); ``queries``: (suggester_id, field, prefix).
    Suggesters without a result have no rows.
    """
    asked = queries.withColumn("prefix", F.lower("prefix"))
    keys = ["field", "prefix"]
    best = _best(_prefixes(suggestions.select("_id", "field", "input", "weight"), asked, keys), keys, size)
    return asked.join(best, keys).select("suggester_id", "rank", "_id", "input", "weight")


def completions_in_context(suggestions: DataFrame, queries: DataFrame, size: int = 5) -> DataFrame:
    """As ``completions``, limited to suggestions with one of the query's context values.

    ``suggestions`` has ``context`` (array of values), ``queries`` has ``context``
    (array of accepted values). A geo context is a category whose value is a cell.
    """
    asked = queries.withColumn("prefix", F.lower("prefix")).withColumn("value", F.explode(F.array_distinct("context")))
    keys = ["field", "prefix", "value"]
    per_value = suggestions.withColumn("value", F.explode(F.array_distinct("context"))).select("_id", "field", "input", "weight", "value")
    best = _best(_prefixes(per_value, asked, keys), keys, size).drop("rank")
    merged = asked.join(best, keys).select("suggester_id", "_id", "input", "weight").distinct()
    return _best(merged, ["suggester_id"], size).select("suggester_id", "rank", "_id", "input", "weight")


def suggest(docs: DataFrame, field: str, queries: DataFrame, size: int = 5) -> DataFrame:
    """Completions from a ``completion`` column: a struct of inputs, a weight and contexts by name.

    ``queries``: (suggester_id, prefix) and, to limit the answers, ``contexts``: a map of the same
    form, of which one value has to fit.
    """
    named = lambda m: F.flatten(F.transform(F.map_entries(m), lambda e: F.transform(e["value"], lambda v: F.concat_ws("=", e["key"], v))))
    rows = docs.where(F.col(field).isNotNull()).select("_id", F.lit(field).alias("field"), F.explode(f"{field}.input").alias("input"), F.col(f"{field}.weight").alias("weight"), F.col(f"{field}.contexts").alias("contexts"))
    asked = queries.withColumn("field", F.lit(field))
    if "contexts" not in queries.columns:
        return completions(rows.drop("contexts"), asked, size)
    rows = rows.where(F.col("contexts").isNotNull()).withColumn("context", named(F.col("contexts")))
    return completions_in_context(rows, asked.withColumn("context", named(F.col("contexts"))), size)


def geo_cell(lat: Column, lon: Column, precision: float) -> Column:
    """Name of the grid cell of a point; ``precision`` is the cell size in degrees."""
    cell = lambda x: F.floor(x / F.lit(float(precision))).cast("string")
    return F.concat_ws("/", cell(lat), cell(lon))


def near_cells(lat: Column, lon: Column, precision: float) -> Column:
    """Names of the grid cells around a point, its own included, as accepted values of a geo context.

    They hold every point whose latitude and longitude differ by at most ``precision`` degrees from
    the given ones, over the date line as well. Null where the point lacks a coordinate.
    """
    size = float(precision)
    south, north, west, east = (math.floor(x / size) for x in (-90, 90, -180, 180))
    i, j = (F.floor(x / F.lit(size)) for x in (lat, lon))
    rows = F.filter(F.sequence(i - 1, i + 1), lambda x: x.between(south, north))
    # the cells on both sides of the date line can be narrower than the others
    over = lambda here, *there: F.when(here, F.array(*(F.lit(c).cast("bigint") for c in there))).otherwise(F.array().cast("array<bigint>"))
    wrapped = F.concat(over(j <= west + 1, east), over(j == west, east - 1), over(j >= east - 1, west), over(j == east, west + 1))
    columns = F.array_distinct(F.concat(F.filter(F.sequence(j - 1, j + 1), lambda x: x.between(west, east)), wrapped))
    return F.flatten(F.transform(rows, lambda x: F.transform(columns, lambda y: F.concat_ws("/", x.cast("string"), y.cast("string")))))
