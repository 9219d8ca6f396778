"""Packing as a cutting-stock problem, solved by column generation.

Documents are cut into full sequences and one rest. The rests' lengths, in steps of ``GRAIN``
tokens, form a histogram that does not grow with the data. A linear program chooses how often each
pattern of lengths is used; new patterns are priced by a knapsack over the dual values, and the
rounded patterns give every length a list of places. The n-th piece of a length takes the n-th place.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from textloom.llm.catalog import free_names, id_and_text, register, table
from textloom.llm.numbering import number_rows
from textloom.llm.text import chunks, slices, texts_of
from textloom.llm.token_ids import document_ids
from textloom.session import materialize

LENGTH = 1024
#: Tokens of one step of the histogram.
GRAIN = 8


def best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Knapsack with repetition by dynamic programming: the most valuable counts that fit."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = np.searchsorted(sizes, room, "right")
        best[room] = best[room - 1]
        if fits:
            tries = values[:fits] + best[room - sizes[:fits]]
            k = int(tries.argmax())
            if tries[k] > best[room] + 1e-12:
                best[room], choice[room] = tries[k], k
    counts, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= int(sizes[choice[room]])
    return float(best[capacity]), counts


def cut_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 3000) -> list[tuple[np.ndarray, int]]:
    """Patterns (counts by size) with how often each is used; every demand is met exactly.

    ``sizes`` ascend. The simplex method starts from patterns of one size; after ``rounds`` columns
    it stops with the plan it has, which is feasible.
    """
    n = len(sizes)
    if not n:
        return []
    basis = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / (capacity // sizes))
    used = demand * inverse.diagonal()
    for _ in range(rounds):
        value, column = best_pattern(inverse.sum(0), sizes, capacity)
        if value <= 1 + 1e-7:
            break
        step = inverse @ column
        ratio = np.where(step > 1e-9, used / np.maximum(step, 1e-12), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        used -= ratio[out] * step
        used[out] = ratio[out]
        used = np.maximum(used, 0)
        basis[:, out] = column
        inverse[out] /= step[out]
        others = np.arange(n) != out
        inverse[others] -= step[others, None] * inverse[out]
    plan: list[tuple[np.ndarray, int]] = []
    left = demand.astype(np.int64).copy()
    for k in np.argsort(-used, kind="stable").tolist():
        counts = np.rint(basis[:, k]).astype(np.int64)
        if (need := counts > 0).any() and (times := min(int(used[k] + 1e-6), int((left[need] // counts[need]).min()))) > 0:
            plan.append((counts, times))
            left -= times * counts
    return plan + _rest(sizes, left, capacity)


def _rest(sizes: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """What rounding left over, a number of pieces that depends on the patterns only: first fit, longest first."""
    rooms: list[int] = []
    bins: list[np.ndarray] = []
    for k in range(len(sizes) - 1, -1, -1):
        for _ in range(int(left[k])):
            at = next((i for i, room in enumerate(rooms) if room >= sizes[k]), None)
            if at is None:
                at = len(rooms)
                rooms.append(capacity)
                bins.append(np.zeros(len(sizes), np.int64))
            rooms[at] -= int(sizes[k])
            bins[at][k] += 1
    return [(b, 1) for b in bins]


class Places(NamedTuple):
    """For each step of the histogram: first ranks of the runs of places, and what each run means."""

    firsts: dict[int, np.ndarray]
    base: dict[int, np.ndarray]  # first sequence of the run
    copies: dict[int, np.ndarray]  # pieces of this size in each of its sequences
    before: dict[int, np.ndarray]  # pieces of larger sizes in each of its sequences


def places(sizes: np.ndarray, plan: list[tuple[np.ndarray, int]]) -> Places:
    out = Places({}, {}, {}, {})
    held: dict[int, list[tuple[int, int, int, int]]] = {int(s): [] for s in sizes}
    ranks = dict.fromkeys(held, 0)
    base = 0
    for counts, times in plan:
        before = 0
        for k in np.flatnonzero(counts)[::-1].tolist():
            s, c = int(sizes[k]), int(counts[k])
            held[s].append((ranks[s], base, c, before))
            ranks[s] += c * times
            before += c
        base += times
    for s, runs in held.items():
        for field, column in zip(out, zip(*runs, strict=True), strict=True):
            field[s] = np.array(column, np.int64)
    return out


def pieces_of(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens``: full pieces of each document and its rest.

    ``ids`` holds little-endian unsigned 32-bit integers.
    """
    source = id_and_text(docs, id_col, text_col)

    def cut(batches):
        for batch in slices(batches):
            texts = texts_of(batch.column(1))
            for lo, hi in chunks(texts):
                owner, starts, sizes, held, totals = [], [], [], [], []
                for i, ids in enumerate(document_ids(texts[lo:hi])):
                    data = ids.astype("<u4").tobytes()
                    for start in range(0, len(ids), length):
                        owner.append(lo + i)
                        starts.append(start)
                        sizes.append(min(length, len(ids) - start))
                        held.append(data[4 * start : 4 * (start + length)])
                        totals.append(len(ids))
                columns = [batch.column(0).take(pa.array(owner, pa.int64())), *(pa.array(x, pa.int64()) for x in (starts, sizes)), pa.array(held, pa.binary()), pa.array(totals, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids", "doc_tokens"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(cut, f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint")


def pack(pieces: DataFrame, length: int = LENGTH, grain: int = GRAIN) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of 1 to ``length`` tokens.

    ``pieces`` is read several times: pass a written table. Any other columns stay, but for those that
    have the names of the two. Equal rows may exchange their places. An empty table gives no rows.
    """
    pieces = pieces.drop("sequence_id", "offset")
    step_, rank_, at_ = free_names(pieces, "_step", "_rank", "_at")
    stepped = pieces.withColumn(step_, F.ceil(F.col("length") / grain).cast("int"))
    # at most length / grain rows
    histogram = sorted((r["step"], r["n"]) for r in stepped.groupBy(F.col(step_).alias("step")).agg(F.count(F.lit(1)).alias("n")).collect())
    sizes, demand = np.array([s for s, _ in histogram], np.int64), np.array([n for _, n in histogram], np.int64)
    where = places(sizes, cut_patterns(sizes, demand, length // grain))
    order = [F.col(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "_piece") if c in pieces.columns]
    ranked = number_rows(stepped, step_, order, rank_, int(demand.sum()))

    def place(batches):
        for batch in batches:
            step = batch.column(batch.schema.get_field_index(step_)).to_numpy()
            rank = batch.column(batch.schema.get_field_index(rank_)).to_numpy()
            sequence, at = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for s in np.unique(step).tolist():
                rows = np.flatnonzero(step == s)
                run = np.searchsorted(where.firsts[s], rank[rows], "right") - 1
                k = rank[rows] - where.firsts[s][run]
                sequence[rows] = where.base[s][run] + k // where.copies[s][run]
                at[rows] = where.before[s][run] + k % where.copies[s][run]
            kept = [i for i, n in enumerate(batch.schema.names) if n not in (step_, rank_)]
            columns = [*(batch.column(i) for i in kept), pa.array(sequence), pa.array(at)]
            yield pa.RecordBatch.from_arrays(columns, names=[*(batch.schema.names[i] for i in kept), "sequence_id", at_])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    placed = ranked.mapInArrow(place, f"{kept}, sequence_id bigint, `{at_}` bigint")
    # a sequence holds at most length / grain pieces
    before = Window.partitionBy("sequence_id").orderBy(at_).rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).drop(at_)


def pack_documents(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset, ids_crc32``.

    A sequence is the ``ids`` of its pieces by ``offset``; the checksum is that of the packed ids. A null or empty text is its end id alone. Repeated rows are packed each; other columns of
    ``docs`` do not matter.
    """
    pieces = materialize(pieces_of(docs, length).withColumn("_piece", F.monotonically_increasing_id()), "pieces", "zstd")
    # places are found without the ids, which are then exchanged once, by the number of their piece
    placed = pack(pieces.drop("ids"), length).withColumnRenamed("_piece", "_placed")
    whole = pieces.select("_piece", "ids").join(placed, F.col("_piece") == F.col("_placed"))
    return whole.select("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", F.crc32("ids").alias("ids_crc32"))


@register("op10_cutting_stock")
def op10_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
