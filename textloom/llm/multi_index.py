"""Approximate nearest neighbours by cosine, with an inverted multi-index.

The halves of the (unit) vectors are quantised separately; a cell is a pair of centroids. A query
walks the cells in order of summed distance with a heap, until they hold enough entries, and the
entries are ranked by their exact cosine. Codebooks are fitted on a bounded sample (``SAMPLE``);
every vector is indexed.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from textloom.llm.catalog import register, table
from textloom.session import materialize

#: Vectors to fit the codebooks on, at most.
SAMPLE = 20_000
#: Centroids of each half, at most; cells are the square of it.
CENTROIDS = 128
#: Entries that a query ranks at least (all, if there are fewer), and their share of all entries at
#: least. The share is large because vectors without clusters need it for a recall above 0.9.
ENTRIES = 2000
SHARE = 0.4
#: Entries, and queries, that one task compares at once.
BLOCK = 4096


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v``: rows with an id whose vector is neither null nor zero and has finite components.

    Vectors of another length than the most frequent one take no part.
    """
    kind = vectors.select(vector_col).schema[0].dataType.simpleString()
    v = F.col(vector_col) if kind == "array<float>" else F.col(vector_col).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v"))
    rows = rows.filter("id IS NOT NULL AND v IS NOT NULL").filter(~F.exists("v", bad) & F.exists("v", lambda x: x != 0))
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("v") == (size[0]["n"] if size else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids by Lloyd's method from a fixed start; empty ones keep their place."""
    rng = np.random.default_rng(5)
    x = np.unique(x, axis=0)
    centres = x[rng.permutation(len(x))[: min(k, len(x))]].copy()
    for _ in range(rounds):
        near = nearest(x, centres)
        counts = np.bincount(near, minlength=len(centres))
        for d in range(x.shape[1]):
            sums = np.bincount(near, x[:, d], minlength=len(centres))
            centres[:, d] = np.where(counts > 0, sums / np.maximum(counts, 1), centres[:, d])
    return centres


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(1)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return distances(x, centres).argmin(1)


def walk(first: np.ndarray, second: np.ndarray, held: np.ndarray, entries: int) -> list[int]:
    """Cells (numbers i * columns + j) by summed distance, until they hold ``entries`` entries."""
    a, b = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    heap = [(float(first[a[0]] + second[b[0]]), 0, 0)]
    out, got, columns = [], 0, len(b)
    while heap and got < entries:
        _, i, j = heapq.heappop(heap)
        cell = a[i] * columns + b[j]
        if held[cell]:
            out.append(cell)
            got += int(held[cell])
        if j + 1 < columns:
            heapq.heappush(heap, (float(first[a[i]] + second[b[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(a):  # each row is entered once, from the one above
            heapq.heappush(heap, (float(first[a[i + 1]] + second[b[0]]), i + 1, 0))
    return out


def nearest_neighbours(
    vectors: DataFrame, queries: DataFrame, k: int = 5, entries: int = ENTRIES, share: float = SHARE, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each query.

    Score is the cosine in double precision; ties go to the smaller id, and a row is never a
    neighbour of its own id. Repeated rows count once; an id with several vectors counts with its
    nearest. Vectors that ``usable`` leaves out take no part.
    """
    spark = vectors.sparkSession
    rows = materialize(usable(vectors, id_col, vector_col), "vectors")
    # of equal vectors only the smallest ids can be among the k nearest; reduced before the shuffle
    same = Window.partitionBy("v").orderBy("id")
    kept = rows.withColumn("_n", F.dense_rank().over(same)).filter(F.col("_n") <= k + 1).drop("_n").distinct()
    sample = rows.select("v").orderBy(F.xxhash64("id", "v")).limit(SAMPLE).toPandas()["v"]  # bounded by SAMPLE
    if not len(sample):
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    known = _unit(np.stack(sample.to_numpy()).astype(float))
    half = max(1, known.shape[1] // 2)
    books = codebook(known[:, :half], CENTROIDS), codebook(known[:, half:], CENTROIDS) if known.shape[1] > half else np.zeros((1, 0))
    columns = len(books[1])
    parts = lambda x: (x[:, :half], x[:, half:])

    def locate(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = parts(_unit(_matrix(batch.column(1))))
                cell = nearest(a, books[0]) * columns + nearest(b, books[1])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], names=["id", "v", "cell"])

    kind = rows.schema["v"].dataType.simpleString()
    index = materialize(kept.mapInArrow(locate, f"id bigint, v {kind}, cell int"), "multi-index")
    held = np.zeros(len(books[0]) * columns, np.int64)
    for r in index.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():  # at most one row per pair of centroids
        held[r["cell"]] = r["n"]

    wanted = max(entries, math.ceil(share * int(held.sum())))

    def probe(batches):
        """For each query and first centroid on its way, the second centroids of the cells it takes."""
        for batch in batches:
            for row in range(batch.num_rows):
                a, b = parts(_unit(_matrix(batch.column(1)[row : row + 1])))
                cells = np.sort(walk(distances(a, books[0])[0], distances(b, books[1])[0], held, wanted))
                lines, at = np.unique(cells // columns, return_index=True)
                one = [batch.column(c).take(pa.array(np.full(len(lines), row))) for c in (0, 1)]
                taken = pa.array([(x % columns).astype(np.int16) for x in np.split(cells, at[1:])], pa.list_(pa.int16()))
                yield pa.RecordBatch.from_arrays([*one, pa.array(lines.astype(np.int32)), taken], names=["query_id", "q", "line", "taken"])

    asked = usable(queries, id_col, vector_col).distinct()
    probes = materialize(asked.mapInArrow(probe, f"query_id bigint, q {kind}, line int, taken array<smallint>"), "probes")
    visits = {r["line"]: r["n"] for r in probes.groupBy("line").agg(F.count(F.lit(1)).alias("n")).collect()}
    # a first centroid with many entries or queries is compared in several tasks
    sizes = held.reshape(-1, columns).sum(1)
    cuts = [(c, -(-int(sizes[c]) // BLOCK), -(-n // BLOCK)) for c, n in visits.items()]
    lines = F.broadcast(spark.createDataFrame(cuts, "line int, entry_blocks int, query_blocks int"))  # CENTROIDS rows at most
    block = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = probes.join(lines, "line").withColumn("e", every("entry_blocks")).select("line", "e", block("query_id", "query_blocks").alias("b"), "query_id", "q", "taken")
    entry = index.select(F.floor(F.col("cell") / columns).cast("int").alias("line"), F.pmod("cell", F.lit(columns)).alias("second"), "id", "v")
    right = entry.join(lines, "line").withColumn("b", every("query_blocks")).select("line", block("id", "entry_blocks").alias("e"), "b", "second", "id", "v")

    def rank(ask: pa.Table, own: pa.Table) -> pa.Table:
        found: list[tuple[int, int, float]] = []
        if ask.num_rows and own.num_rows:
            q, x = (_matrix(t.column(c).combine_chunks()) for t, c in ((ask, "q"), (own, "v")))
            asked, ids = ask.column("query_id").to_numpy(), own.column("id").to_numpy()
            second, taken = own.column("second").to_numpy(), ask.column("taken").to_pylist()
            length = np.sqrt(np.einsum("xd,xd->x", x, x))
            for i, query in enumerate(q):
                listed = np.zeros(columns, bool)
                listed[taken[i]] = True
                # one product per entry, so that equal vectors get equal scores
                score = np.einsum("xd,d->x", x, query) / (math.sqrt(float(np.einsum("d,d->", query, query))) * length)
                score[(ids == asked[i]) | ~listed[second]] = -np.inf
                best = np.argpartition(-score, k)[:k] if len(score) > k else np.arange(len(score))
                best = np.flatnonzero(score >= score[best].min())
                best = best[np.lexsort((ids[best], -score[best]))][:k]
                found += [(int(asked[i]), int(ids[j]), float(score[j])) for j in best if score[j] > -np.inf]
        ask_ids, own_ids, scores = zip(*found, strict=True) if found else ((), (), ())
        return pa.table({"query_id": pa.array(ask_ids, pa.int64()), "vec_id": pa.array(own_ids, pa.int64()), "score": pa.array(scores, pa.float64())})

    keys = ("line", "e", "b")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(rank, "query_id bigint, vec_id bigint, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@register("op2_multi_index")
def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.filter("vec_id % 50 = 0"))
