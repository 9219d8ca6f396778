"""Gapless numbers within groups, without a task that sees a whole group."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from textloom.llm.catalog import free_names


def number_rows(df: DataFrame, group: str, order: list[Column], name: str, rows: int) -> DataFrame:
    """Adds ``name``: 0, 1, 2, ... within each value of ``group``.

    Rows of a group are dealt to about the square root of ``rows`` (the number of rows of ``df``)
    blocks by a hash of ``order``; a row's number is the size of the blocks before its own plus its
    place, by ``order``, within the block. So a task sorts one block of a group, and the table of
    block sizes is small. Rows that agree in all of ``order`` stand in any order; they should be
    alike. ``df`` is read twice: pass a written table, in which ``group`` is never null and no
    column is called ``name``. Its columns may have any other names.
    """
    block_, size_, start_, place_, group_, of_ = free_names(df, "_block", "_size", "_start", "_place", "_group", "_of")
    blocks = max(1, math.isqrt(max(rows, 1)))
    dealt = df.withColumn(block_, F.pmod(F.xxhash64(*order, F.lit(11)), F.lit(blocks)))
    sizes = dealt.groupBy(group, block_).agg(F.count(F.lit(1)).alias(size_))
    before = Window.partitionBy(group).orderBy(block_).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn(start_, F.coalesce(F.sum(size_).over(before), F.lit(0))).drop(size_)
    place = F.row_number().over(Window.partitionBy(group, block_).orderBy(*order)) - 1
    starts = starts.withColumnsRenamed({group: group_, block_: of_})
    ranked = dealt.withColumn(place_, place)
    # plain equality, so that the join finds the rows as the numbering has dealt them
    same = (ranked[group] == starts[group_]) & (ranked[block_] == starts[of_])
    return ranked.join(starts, same).withColumn(name, (F.col(start_) + F.col(place_)).cast("long")).drop(start_, place_, block_, group_, of_)
