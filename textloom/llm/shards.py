"""Sharding: a uniform shuffle with exact shard sizes.

Rows lie in sources (the partitions of the input). How many rows each source gives to each shard is
drawn exactly as in a uniform permutation: row by row of the communication matrix, from the
multivariate hypergeometric distribution over what is left of each shard. Each source is written in
random order and gives its first rows to the first shard, and so on; whole rows are then exchanged
once, and each shard puts its rows in random order again. All randomness comes from hashes of the
row and the seed, and the written order stays, so a repeated task gives the same rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from textloom.llm.catalog import free_names, register, table
from textloom.llm.numbering import number_rows
from textloom.session import materialize

#: Entries of the matrix, at most; it fits the driver and a broadcast.
MATRIX = 20_000_000


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    """Exact sizes, at most one apart."""
    return np.array([rows // shards + (j < rows % shards) for j in range(shards)], np.int64)


def communication_matrix(sources: np.ndarray, shards: np.ndarray, seed: int) -> np.ndarray:
    """Rows that each source gives to each shard; row sums and column sums are exact."""
    rng = np.random.default_rng(seed)
    left = shards.copy()
    out = np.zeros((len(sources), len(shards)), np.int64)
    for i, n in enumerate(sources.tolist()):
        # the generator's own draw is limited to 10**9 rows
        out[i] = rng.multivariate_hypergeometric(left, n, method="marginals") if left.sum() < 10**9 else _draw(rng, left, n)
        left -= out[i]
    return out


def _draw(rng: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """The same draw for any number of rows: n distinct positions, counted by shard."""
    stops = np.cumsum(left)
    positions = rng.choice(int(stops[-1]), n, replace=False, shuffle=False)
    return np.bincount(np.searchsorted(stops, positions, "right"), minlength=len(left))


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """The rows of ``df`` with ``shard`` and ``slot`` (gapless from 0 within the shard).

    Every column takes part in the order, so equal rows are the only ties and may be exchanged. Nulls
    are values like others; an empty table gives no rows. Columns of the input named ``shard`` or
    ``slot`` are replaced; any other names are free. Columns that hold maps take part as JSON. The
    order depends on the seed and on the partitions of ``df``.
    """
    spark = df.sparkSession
    held = df.drop("shard", "slot")
    row_, second_, source_, at_ = free_names(held, "_shard_row", "_shard_second", "_source", "_at")
    columns = [_comparable(f) for f in held.schema]
    first = [F.xxhash64(*columns, F.lit(seed), F.lit("first")), *columns]
    laid = held.coalesce(max(1, MATRIX // shards)).sortWithinPartitions(*first)
    # the number of the partition, and below it the place in the partition
    numbered = laid.withColumn(row_, F.monotonically_increasing_id()).withColumn(second_, F.xxhash64(*columns, F.lit(seed), F.lit("second")))
    source = materialize(numbered, "to-shard").withColumns({source_: F.shiftright(row_, 33).cast("int"), at_: F.col(row_).bitwiseAND((1 << 33) - 1)})
    found = source.groupBy(F.col(source_).alias("source")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per partition
    counts = np.zeros(max((r["source"] + 1 for r in found), default=0), np.int64)
    for r in found:
        counts[r["source"]] = r["n"]
    rows = int(counts.sum())
    matrix = communication_matrix(counts, shard_sizes(rows, shards), seed)
    bounds = spark.sparkContext.broadcast(np.cumsum(matrix, axis=1))

    @F.pandas_udf("int")
    def shard_of(block: pd.Series, place: pd.Series) -> pd.Series:
        return pd.Series((bounds.value[block.to_numpy()] <= place.to_numpy()[:, None]).sum(1).astype(np.int32))

    dealt = source.withColumn("shard", shard_of(source_, at_)).drop(source_, at_)
    return number_rows(dealt, "shard", [F.col(second_), F.col(row_)], "slot", rows).drop(row_, second_)


def _comparable(field: T.StructField) -> Column:
    """The column, or its JSON where it holds a map, which can be neither hashed nor sorted."""
    column = F.col(f"`{field.name}`")
    return F.to_json(F.struct(column)) if "map<" in field.dataType.simpleString() else column


@register("op3_shards")
def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents go into shards with their texts; size and checksum are those of the sharded rows."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return shuffle_into_shards(table(spark, sf_dir, "documents"), 24).select(
        "doc_id", (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
