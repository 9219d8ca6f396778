"""Centroid clustering with exact integers, filtered by an n-simplex projection.

Vectors are whole numbers, and so are centroids. A few pivots span a simplex; the distances of a
vector to them, taken once and stored, become the coordinates of an apex over that simplex. Between
two apexes the Euclidean distance is a lower bound of the true distance, and with the last coordinate
mirrored it is an upper bound. In a round a vector compares its apex with those of the centroids; only
centroids whose lower bound does not exceed the least upper bound are compared exactly.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textloom.llm.catalog import register, table
from textloom.session import materialize

DIMENSIONS, SCALE, SEED = 64, 64, 1
CLUSTERS, ROUNDS = 16, 3
#: Pivots at most; fewer where the starting centroids span less.
PIVOTS = 12
#: A pivot must stand this far out of the span of the others, as a share of the largest distance.
ALTITUDE = 0.05
#: Bounds are widened by this share of the largest distance involved, for rounding.
SLACK = 1e-6
#: Components from here on are compared as numbers of any length, so that no square overflows.
WIDE = 1 << 27

_LONG = (1 << 63) - 1


class Simplex:
    """Pivots and their simplex: row i of ``base`` holds the i coordinates of pivot i."""

    def __init__(self, points: np.ndarray, limit: int = PIVOTS):
        """Take points one by one, each time the one that stands farthest out of the simplex so far."""
        points = points.astype(float)
        self.pivots = points[:1]
        self.base = np.zeros((1, 1))
        top = float(np.sqrt(((points[:, None] - points[None]) ** 2).sum(2)).max())
        while len(self.pivots) < min(limit, len(points)):
            apexes = self.project(points)
            next_one = int(apexes[:, -1].argmax())
            if not apexes[next_one, -1] > ALTITUDE * top:
                break
            size = len(self.pivots)
            base = np.zeros((size + 1, size + 1))
            base[:size, :size] = self.base
            base[size, :size] = apexes[next_one]
            self.pivots, self.base = np.vstack((self.pivots, points[next_one])), base

    def project(self, x: np.ndarray) -> np.ndarray:
        """Apex coordinates of each row of ``x``: one per pivot, the last one never negative."""
        x, count = x.astype(float), len(self.pivots)
        d = np.stack([((x - p) ** 2).sum(1) for p in self.pivots], 1)
        out = np.zeros((len(d), count))
        rest = d[:, 0].copy()
        for i in range(1, count):
            # pivot i lies in the span of the first i axes, with base[i, i - 1] along the last of them
            p = self.base[i]
            along = (d[:, 0] - d[:, i] + (p[:i] ** 2).sum()) / 2 - out[:, : i - 1] @ p[: i - 1]
            out[:, i - 1] = along / p[i - 1]
            rest = rest - out[:, i - 1] ** 2
        out[:, -1] = np.sqrt(np.maximum(rest, 0.0))
        return out


def bounds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared lower and upper bounds between all apexes of two lists."""
    base = ((a[:, None, :-1] - b[None, :, :-1]) ** 2).sum(2)
    return base + (a[:, None, -1] - b[None, :, -1]) ** 2, base + (a[:, None, -1] + b[None, :, -1]) ** 2


def assign(x: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """``(cluster, squared distance, exact comparisons)``: nearest centroid of each row, ties to the smaller number."""
    low, high = bounds(apexes, tops)
    room = SLACK * (np.abs(apexes).max(1, initial=0.0) + np.abs(tops).max(initial=0.0)) ** 2
    open_ = low <= high.min(1, keepdims=True) + room[:, None]
    best = np.full(len(x), -1, np.int64)
    distance = np.zeros(len(x), x.dtype)
    for k, c in enumerate(centroids):
        rows = np.flatnonzero(open_[:, k])
        d = ((x[rows] - c) ** 2).sum(1)
        better = (best[rows] < 0) | (d < distance[rows])
        best[rows[better]], distance[rows[better]] = k, d[better]
    return best, distance, int(open_.sum())


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: vectors of the right length without null or non-finite components, as whole numbers."""
    v = F.col(vector_col).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    kept = vectors.select(F.col(id_col).alias("vec_id"), v.alias("v")).filter((F.size("v") == dimensions) & ~F.exists("v", bad))
    whole = lambda x: F.when(F.abs(x) < 2.0**62 / scale, F.floor(x * float(scale))).otherwise(F.raise_error(F.lit("a component is larger than a long")).cast("bigint"))
    return kept.select("vec_id", F.transform("v", whole).alias("v"))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    return x.astype(object) if x.size and np.abs(x).max() >= WIDE else x


def starting_order(vec_id: Column, seed: int = SEED) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), vec_id.cast("string")), 256)


def simplex_means(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, pivots: int = PIVOTS,
    id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE,
) -> tuple[DataFrame, list[list[int]], list[int]]:
    """``(rows, centroids, comparisons)``: rows are ``vec_id, cluster, distance``, one per kept input row.

    ``comparisons`` are the exact comparisons of each round; without the bounds each would be rows
    times centroids. Vectors of another length, null ones and those with null or non-finite components
    take no part. Repeated rows count each. A row without an id is assigned and counted, but never
    starts a centroid. With fewer vectors than clusters each one starts a centroid; of equal ids the
    smaller vector comes first. Nothing comes of an empty table. Squared distances that no long can
    hold are an error.

    Partial sums are taken in every task, so a round sends (clusters x dimensions) numbers to the
    driver. The vectors with their apexes are written once and read in each round.
    """
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, id_col, vector_col, dimensions, scale)
    first = whole.filter("vec_id IS NOT NULL").orderBy(starting_order(F.col("vec_id"), seed), "v").limit(clusters).select("v").collect()
    centroids = [list(r["v"]) for r in first]
    id_kind = whole.schema["vec_id"].dataType.simpleString()
    if not centroids:
        return spark.createDataFrame([], f"vec_id {id_kind}, cluster int, distance bigint"), [], []
    simplex = Simplex(np.array(centroids), pivots)

    def project(batches):
        for batch in batches:
            apexes = simplex.project(_matrix(batch.column(1), dimensions))
            offsets = np.arange(len(apexes) + 1, dtype=np.int32) * apexes.shape[1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(apexes.ravel()))], names=["vec_id", "v", "apex"])

    rows = materialize(whole.mapInArrow(project, f"vec_id {id_kind}, v array<bigint>, apex array<double>"), "apexes")

    def nearest(batch: pa.RecordBatch, centres: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        x = _matrix(batch.column("v"), dimensions)
        c = np.array(centres, object)
        if x.dtype != object and max((abs(i) for row in centres for i in row), default=0) < WIDE:
            c = c.astype(np.int64)
        else:
            x = x.astype(object)
        apexes = batch.column("apex").flatten().to_numpy().reshape(len(x), -1)
        return (x, *assign(x, apexes, c, simplex.project(c)))

    def totals(centres: list[list[int]]) -> DataFrame:
        def add(batches):
            sums = np.zeros((len(centres), dimensions), object)
            counts, compared = [0] * len(centres), 0
            for batch in batches:
                x, cluster, _, n = nearest(batch, centres)
                compared += n
                for k in np.unique(cluster).tolist():
                    mine = x[cluster == k]
                    sums[k] += mine.sum(0).astype(object)
                    counts[k] += len(mine)
            used = [k for k, n in enumerate(counts) if n]
            digits = [[str(s) for s in sums[k]] for k in used]
            columns = [pa.array(used, pa.int32()), pa.array([counts[k] for k in used], pa.int64()), pa.array(digits, pa.list_(pa.string())), pa.array([compared if i == 0 else 0 for i in range(len(used))], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", "sums", "compared"])

        found = rows.select("v", "apex").mapInArrow(add, "cluster int, n bigint, sums array<string>, compared bigint")
        parts = found.select("cluster", "n", "compared", F.posexplode("sums").alias("i", "s"))
        return parts.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum("compared").alias("compared"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))

    comparisons = []
    for _ in range(rounds):
        found = totals(centroids).collect()  # one row per centroid and dimension
        for r in found:
            centroids[r["cluster"]][r["i"]] = int(r["s"]) // r["n"]
        comparisons.append(sum(r["compared"] for r in found if r["i"] == 0))

    def label(batches):
        for batch in batches:
            _, cluster, distance, _ = nearest(batch, centroids)
            if distance.dtype == object and any(d > _LONG for d in distance):
                raise ValueError("a squared distance is larger than a long")
            columns = [batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return rows.mapInArrow(label, f"vec_id {id_kind}, cluster int, distance bigint"), centroids, comparisons


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def with_inertia(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """The assignments with the sums of distances of their cluster and of all, and their centroid's digest."""
    spark = rows.sparkSession
    kept = materialize(rows, "assigned")
    own = kept.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    found = {r["cluster"]: int(r["s"]) for r in own.collect()}  # one row per centroid
    total = sum(found.values())
    if total > _LONG:
        raise ValueError("the sum of all distances is larger than a long")
    facts = [(k, found[k], total, centroid_digest(centroids[k])) for k in sorted(found)]
    facts_table = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return kept.join(F.broadcast(facts_table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    near = """SELECT vec_id, v, c.cluster, list_sum(list_transform(range(1, 65), lambda i: (v[i] - c.c[i]) * (v[i] - c.c[i])))::BIGINT AS distance
        FROM w CROSS JOIN {centres} c QUALIFY row_number() OVER (PARTITION BY w.n ORDER BY distance, c.cluster) = 1"""
    parts = [
        """k AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE len(embedding) = 64
               AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        "w AS MATERIALIZED (SELECT vec_id, list_transform(e, lambda x: floor(x * 64)::BIGINT) AS v, row_number() OVER () AS n FROM k)",
        "c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h, v) - 1)::INTEGER AS cluster, v AS c FROM (SELECT v, sha256('1:' || vec_id) AS h FROM w WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT 16) s)",
    ]
    for i in range(ROUNDS):
        parts.append(f"a{i} AS MATERIALIZED ({near.format(centres=f'c{i}')})")
        sums = f"SELECT cluster, i, sum(v[i])::HUGEINT AS s, count(*) AS n FROM a{i}, range(1, 65) r(i) GROUP BY cluster, i"
        floors = f"SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM ({sums}) x GROUP BY cluster"
        parts.append(f"c{i + 1} AS MATERIALIZED (SELECT p.cluster, coalesce(q.c, p.c) AS c FROM c{i} p LEFT JOIN ({floors}) q USING (cluster))")
    parts.append(f"z AS MATERIALIZED ({near.format(centres=f'c{ROUNDS}')})")
    return f"""WITH {', '.join(parts)}
    SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
           sha256(array_to_string(c, ',')) AS centroid_sha256 FROM z JOIN c{ROUNDS} USING (cluster)"""


@register("op12_simplex_means", _sql())
def op12_simplex_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, centroids, _ = simplex_means(table(spark, sf_dir, "embeddings"))
    return with_inertia(rows, centroids)
