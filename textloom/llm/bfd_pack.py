"""Token-id output: best-fit-decreasing packing into rows of an id matrix.

Documents longer than a row are split without loss. Within a window of documents the rests are taken
longest first, each into the fullest row that still has room; a segment tree over the free capacities
finds that row in logarithmic time. Every task packs its own documents, window by window, so nothing
is shuffled and memory follows the window. A row is written with its ids, the cumulative lengths of
its segments and positions that start anew with each segment.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from textloom.llm.catalog import id_and_text, register, table
from textloom.llm.text import chunks, slices, texts_of
from textloom.llm.token_ids import document_ids

LENGTH = 1024
#: Tokens packed together by one task.
WINDOW = 1 << 21
PAD = 0

_PIECE = pa.struct([(n, pa.int64()) for n in ("start", "length", "offset", "doc_tokens")])


class Capacities:
    """Segment tree over capacities 0 to ``top``: which of them some open row has."""

    def __init__(self, top: int):
        self.leaves = 1 << top.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(top + 1)]

    def put(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        node = self.leaves + capacity
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The row with the least capacity of ``need`` or more, and that capacity; it is no longer open."""
        node = self.leaves + need
        if not self.any[node]:
            # up to the first right neighbour with a row, then down to its leftmost one
            while node > 1 and (node & 1 or not self.any[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        row = self.rows[capacity].pop()
        if not self.rows[capacity]:
            self.any[node] = 0
            while node > 1:
                node >>= 1
                self.any[node] = self.any[2 * node] | self.any[2 * node + 1]
        return capacity, row


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], int]:
    """Row of each item (1 to ``capacity`` long), and the number of rows; ties in the given order."""
    tree, out, rows = Capacities(capacity), [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room = tree.take(lengths[i])
        left, row = (capacity, rows) if room is None else room
        rows += room is None
        out[i] = row
        if left > lengths[i]:
            tree.put(left - lengths[i], row)
    return out, rows


def pack_window(ids: list[np.ndarray], length: int, pad: int) -> tuple[np.ndarray, np.ndarray, list[list[tuple[int, int, int, int]]]]:
    """Id matrix, positions, and by row its pieces (document, start, length, offset)."""
    pieces = [(d, start, min(length, len(x) - start)) for d, x in enumerate(ids) for start in range(0, len(x), length)]
    row_of, rows = best_fit_decreasing([p[2] for p in pieces], length)
    matrix, positions = np.full((rows, length), pad, "<u4"), np.zeros((rows, length), "<u4")
    held: list[list[tuple[int, int, int, int]]] = [[] for _ in range(rows)]
    filled = [0] * rows
    for (d, start, size), row in zip(pieces, row_of, strict=True):
        at = filled[row]
        matrix[row, at : at + size] = ids[d][start : start + size]
        positions[row, at : at + size] = np.arange(size)
        held[row].append((d, start, size, at))
        filled[row] = at + size
    return matrix, positions, held


def pack_rows(docs: DataFrame, length: int = LENGTH, pad: int = PAD, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``sequence_id, ids, positions, cu_seqlens, doc_ids, pieces``: one row per packed sequence.

    ``ids`` and ``positions`` hold ``length`` little-endian unsigned 32-bit integers; ``cu_seqlens``
    are the cumulative segment lengths from 0, so what lies after the last is padding. ``pieces``
    are (start, length, offset, doc_tokens) in the order of ``doc_ids``. A null or empty text is its
    end id alone; every row of the input is packed. ``sequence_id`` is unique, not gapless.
    """
    source = id_and_text(docs, id_col, text_col)
    id_kind = source.schema["doc_id"].dataType.simpleString()

    def pack(batches):
        number = TaskContext.get().partitionId() << 33
        keys: list[pa.Array] = []
        ids: list[np.ndarray] = []
        tokens = 0

        def flush():
            nonlocal number, tokens
            matrix, positions, held = pack_window(ids, length, pad)
            owners = pa.concat_arrays(keys)
            for lo in range(0, len(held), 1024):
                part = held[lo : lo + 1024]
                sizes = np.concatenate(([0], np.cumsum([len(p) for p in part]))).astype(np.int32)
                docs_of = owners.take(pa.array([p[0] for row in part for p in row], pa.int64()))
                facts = pa.array([{"start": s, "length": n, "offset": at, "doc_tokens": len(ids[d])} for row in part for d, s, n, at in row], _PIECE)
                ends = [[0, *(at + n for _, _, n, at in row)] for row in part]
                columns = [
                    pa.array(number + np.arange(len(part)), pa.int64()),
                    *(pa.array([r.tobytes() for r in m[lo : lo + 1024]], pa.binary()) for m in (matrix, positions)),
                    pa.array(ends, pa.list_(pa.int32())),
                    pa.ListArray.from_arrays(sizes, docs_of),
                    pa.ListArray.from_arrays(sizes, facts),
                ]
                number += len(part)
                yield pa.RecordBatch.from_arrays(columns, names=["sequence_id", "ids", "positions", "cu_seqlens", "doc_ids", "pieces"])
            keys.clear()
            ids.clear()
            tokens = 0

        for batch in slices(batches):
            texts = texts_of(batch.column(1))
            for lo, hi in chunks(texts):
                found = document_ids(texts[lo:hi])
                keys.append(batch.column(0)[lo:hi])
                ids.extend(found)
                tokens += sum(map(len, found))
                if tokens >= window:
                    yield from flush()
        if ids:
            yield from flush()

    fields = f"sequence_id bigint, ids binary, positions binary, cu_seqlens array<int>, doc_ids array<{id_kind}>"
    return source.mapInArrow(pack, f"{fields}, pieces array<struct<start:bigint,length:bigint,offset:bigint,doc_tokens:bigint>>")


def write_packed(docs: DataFrame, path: str, length: int = LENGTH, **options) -> None:
    """Write the packed rows as Parquet: one fixed-size id row, its positions and segment ends per record."""
    pack_rows(docs, length, **options).write.parquet(path)


@register("op7_bfd_pack")
def op7_bfd_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per piece, with checksums of its ids and of its positions as they stand in the matrix."""
    packed = pack_rows(table(spark, sf_dir, "documents"))
    each = packed.select("sequence_id", "ids", "positions", F.size("cu_seqlens").alias("_ends"), F.explode(F.arrays_zip("doc_ids", "pieces")).alias("p"))
    cut = lambda c: F.crc32(F.substring(F.col(c), 4 * F.col("p.pieces.offset") + 1, 4 * F.col("p.pieces.length")))
    return each.select(
        F.col("p.doc_ids").alias("doc_id"), "p.pieces.start", "p.pieces.length", cut("ids").alias("ids_crc32"), "p.pieces.doc_tokens",
        "sequence_id", "p.pieces.offset", cut("positions").alias("positions_crc32"), (F.col("_ends") - 1).alias("segments"),
    )
