"""The row-wise operators on streams: bulk writes, token counts, standing queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from textloom.operators.analyzers import Analyzer
from textloom.plans.compile import row_test
from textloom.plans.queries import Query
from textloom.sources.collection import Collection, last_per_id


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, order: list[str], keys: tuple[str, ...] = ("_id",)) -> StreamingQuery:
    """Feed a bulk stream into a change table; each micro-batch is one partition.

    A batch writes only its own latest row per key, under its batch number, so a
    replayed batch overwrites itself and its cost does not grow with the table.
    ``current_state`` reads the newest row of each key.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        last_per_id(batch, order, keys).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_index_stream(stream: DataFrame, path: str, checkpoint: str, order: list[str], source: str | None = None) -> StreamingQuery:
    """Feed a bulk stream into a collection; each micro-batch becomes one version of it.

    A row counts only if it comes after the last ordered write of its id, so late rows of later batches
    are left out. The version notes the number of its batch under ``source`` (by default the checkpoint,
    which numbers the batches): a batch that is replayed after it was published adds nothing, and one
    that failed before is put as if for the first time.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        Collection.open(batch.sparkSession, path).put(batch, order, source or checkpoint, batch_id)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_state(changes: DataFrame, order: list[str], keys: tuple[str, ...] = ("_id",)) -> DataFrame:
    """The newest row of each key over all batches; combined before the shuffle."""
    return last_per_id(changes.drop("batch"), order, keys)


def compact(changes: DataFrame, path: str, order: list[str], keys: tuple[str, ...] = ("_id",)) -> None:
    """Write the current state as a new table, to start the next run of batches from."""
    current_state(changes, order, keys).write.mode("overwrite").parquet(path)


def token_counts(stream: DataFrame, text: str, analyzer: Analyzer, time: str, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Tokens per time window; rows later than the watermark are dropped."""
    tokens = stream.select(F.col(time).cast("timestamp").alias("at"), F.explode(analyzer.array(F.col(text))).alias("t"))
    return (
        tokens.withWatermark("at", late).groupBy(F.window("at", window).alias("w"), F.col("t.token").alias("token"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("start"), "token", "n")
    )


def standing_query(stream: DataFrame, query: Query | Column) -> DataFrame:
    """Rows that a query on their columns matches; stateless, so it holds for any volume."""
    return stream.where(query if isinstance(query, Column) else row_test(query, stream.schema))
