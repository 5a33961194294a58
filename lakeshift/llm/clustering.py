"""Centroid clustering with n-simplex projection.

A few pivots, chosen among the first centroids, span a simplex. The distances of a vector to the pivots,
computed once and stored with it, give the vector as the apex of that simplex: its coordinates within
the space of the pivots, and its altitude above it. For two vectors the Euclidean distance of their
apexes bounds the true one from below, and the same with one altitude turned over from above. In each
round only the centroids get new apexes; a centroid whose lower bound exceeds the least upper bound of a
vector cannot be its nearest, and the others are compared exactly, in integers.

Each round is one pass over the stored vectors in which every task adds up its own vectors by cluster.
What reaches the driver is bounded by the number of centroids times the dimensions.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.llm.common import REGISTRY, table
from lakeshift.sources.scratch import stored

CENTROIDS, ROUNDS, DIMENSIONS, SCALE, SEED = 40, 5, 64, 256, 2
#: Pivots of the simplex.
PIVOTS = 32
#: Integers beyond this could make squared distances that do not fit into 64 bits.
LARGEST = 1 << 27
#: Vectors handled at once.
ROWS = 8192


def usable(vector: Column, dimensions: int) -> Column:
    """Has exactly so many components, none null, NaN or infinite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) == dimensions) & finite


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of integers, pair by pair."""
    d = a - b
    return np.einsum("ij,ij->i", d, d)


class Simplex:
    """The pivots and the shape that they span: ``base[i]`` are the coordinates of pivot i + 1, pivot 0 is the origin."""

    def __init__(self, candidates: np.ndarray, pivots: int = PIVOTS) -> None:
        """Take in turn the candidate that lies farthest above the space of those taken, as long as one lies above it at all."""
        rest = candidates.astype(np.float64)
        chosen = [0]
        rest = rest - rest[0]
        while len(chosen) < min(pivots, len(candidates)):
            heights = np.einsum("ij,ij->i", rest, rest)
            top = int(heights.argmax())
            if heights[top] < 1.0:
                break
            chosen.append(top)
            along = rest[top] / np.sqrt(heights[top])
            rest = rest - np.outer(rest @ along, along)
        self.pivots = candidates[chosen]
        n = len(chosen)
        gaps = np.array([squared(self.pivots, p[None, :]) for p in self.pivots], np.float64)
        gram = (gaps[0][1:, None] + gaps[0][None, 1:] - gaps[1:, 1:]) / 2
        self.base = np.linalg.cholesky(gram) if n > 1 else np.empty((0, 0))

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        """Squared distances to the pivots, one column each."""
        return np.column_stack([squared(vectors, p[None, :]) for p in self.pivots]).astype(np.float64)

    def apexes(self, gaps: np.ndarray) -> np.ndarray:
        """Coordinates in the space of the pivots, and last the altitude above it, from squared distances."""
        if len(self.base):
            right = (gaps[:, :1] - gaps[:, 1:] + np.einsum("ij,ij->i", self.base, self.base)) / 2
            inside = np.linalg.solve(self.base, right.T).T
        else:
            inside = np.empty((len(gaps), 0))
        height = np.sqrt(np.maximum(gaps[:, 0] - np.einsum("ij,ij->i", inside, inside), 0))
        return np.column_stack([inside, height])


def bounds(points: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of squared distances, one column per center, from apexes."""
    a, b = points[:, :-1], centers[:, :-1]
    flat = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b) - 2 * (a @ b.T)
    h, g = points[:, -1:], centers[:, -1]
    return flat + (h - g) ** 2, flat + (h + g) ** 2


def nearest(vectors: np.ndarray, apexes: np.ndarray, centers: np.ndarray, simplex: Simplex) -> tuple[np.ndarray, np.ndarray]:
    """Number of and squared distance to the nearest center of each vector; of equally near ones the smallest number."""
    lower, upper = bounds(apexes, simplex.apexes(simplex.distances(centers)))
    # rounding is far below this share of the squares that went into the sums
    slack = 1e-7 * ((apexes**2).sum(1) + float((centers.astype(np.float64) ** 2).sum(1).max()) + float((simplex.pivots.astype(np.float64) ** 2).sum(1).max())) + 1e-3
    near = lower <= (upper.min(1) + slack)[:, None]
    best = np.full(len(vectors), np.iinfo(np.int64).max)
    which = np.zeros(len(vectors), np.int32)
    for c in range(len(centers)):
        rows = np.flatnonzero(near[:, c])
        d = squared(vectors[rows], centers[c])
        closer = d < best[rows]
        best[rows[closer]], which[rows[closer]] = d[closer], c
    return which, best


def _whole(column: pa.Array, dimensions: int, scale: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions)
    out = np.floor(flat * scale)
    if len(out) and np.abs(out).max() > LARGEST:
        raise ValueError(f"a component times {scale} lies beyond {LARGEST}: squared distances would not fit into 64 bits")
    return out.astype(np.int64)


def _packed(rows: np.ndarray) -> pa.Array:
    """One binary value per row."""
    width = rows.shape[1] * rows.itemsize
    data = np.ascontiguousarray(rows)
    offsets = pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width))
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets, pa.py_buffer(data)])


def _unpacked(column: pa.Array, kind: type, width: int) -> np.ndarray:
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].copy().view(kind).reshape(-1, width)


def _first(rows: DataFrame, k: int, seed: int, dimensions: int, scale: int) -> np.ndarray:
    """The k vectors of least hash. Rows of equal key are ordered by their components, so reruns agree."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    got = rows.select(digest.alias("h"), "v").orderBy("h", "v").limit(k).toArrow()
    return _whole(got["v"].combine_chunks(), dimensions, scale)


def clustered(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED, pivots: int = PIVOTS,
) -> DataFrame:
    """key, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each usable vector.

    Components become floor(scale * x). The first centroids are the k vectors whose keys have the least
    SHA-256 with the seed; in each round vectors go to the nearest centroid (ties: smallest number), and
    each centroid that has vectors moves to their mean, rounded down.

    Vectors that are null, of another length, or hold a null, NaN or infinite component have no row. A
    null key counts as an empty one and stays null. Repeated rows count each. With fewer than k vectors
    each is a centroid; an empty table gives an empty result. Other columns are not read, so their names
    cannot clash. Components beyond 2^27 after scaling end in an error, since distances would not fit.
    """
    rows = df.select(F.col(key).alias("key"), F.col(vector).alias("v")).where(usable(F.col("v"), dimensions))
    centers = _first(rows, k, seed, dimensions, scale)
    spark, key_type = df.sparkSession, df.schema[key].dataType
    out = T.StructType([T.StructField(key, key_type), *T.StructType.fromDDL("cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string").fields])
    if not len(centers):
        return spark.createDataFrame([], out)
    simplex = Simplex(centers, pivots)
    n_pivots = len(simplex.pivots)

    def project(batches):
        for b in batches:
            whole = _whole(b["v"], dimensions, scale)
            apexes = np.concatenate([simplex.apexes(simplex.distances(whole[at : at + ROWS])) for at in range(0, len(whole), ROWS)] or [np.empty((0, n_pivots))])
            yield pa.RecordBatch.from_arrays([b["key"], _packed(whole.astype(np.int32)), _packed(apexes)], ["key", "v", "apex"])

    kept = T.StructType([T.StructField("key", key_type), T.StructField("v", T.BinaryType()), T.StructField("apex", T.BinaryType())])
    vectors = stored(rows.mapInArrow(project, kept), "apexes")

    def read(b):
        """(slice, vectors, apexes) of a batch, some rows at a time."""
        for at in range(0, b.num_rows, ROWS):
            part = b.slice(at, ROWS)
            yield part, _unpacked(part["v"], np.int32, dimensions).astype(np.int64), _unpacked(part["apex"], np.float64, n_pivots)

    for _ in range(rounds):

        def sums(batches, centers=centers):
            total, count = np.zeros((len(centers), dimensions), object), np.zeros(len(centers), np.int64)
            for b in batches:
                for _, whole, apexes in read(b):
                    which, _ = nearest(whole, apexes, centers, simplex)
                    order = np.argsort(which, kind="stable")
                    found, starts = np.unique(which[order], return_index=True)
                    total[found] += np.add.reduceat(whole[order], starts, axis=0).astype(object)
                    count += np.bincount(which, minlength=len(centers))
            c = np.flatnonzero(count)
            lists = pa.array([[str(x) for x in row] for row in total[c]], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(count[c], pa.int64()), lists], ["cluster", "n", "total"])

        parts = vectors.mapInArrow(sums, "cluster int, n long, total array<string>")
        flat = parts.select("cluster", "n", F.posexplode("total").alias("i", "x"))
        added = flat.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
        centers = centers.copy()
        for r in added.collect():  # at most centroids x dimensions rows
            centers[r.cluster, r.i] = int(r.x) // r.n

    def assign(batches):
        for b in batches:
            for part, whole, apexes in read(b):
                which, best = nearest(whole, apexes, centers, simplex)
                yield pa.RecordBatch.from_arrays([part["key"], pa.array(which, pa.int32()), pa.array(best, pa.int64())], ["key", "cluster", "distance"])

    given = T.StructType([T.StructField("key", key_type), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    assigned = stored(vectors.mapInArrow(assign, given), "clusters")
    inertia = {r.cluster: r.d for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # one row per centroid
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centers]

    def of(values, kind):
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)

    return assigned.select(
        F.col("key").alias(key), "cluster", "distance",
        of([inertia.get(c, 0) for c in range(len(centers))], "long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        of(digests, "string").alias("centroid_sha256"),
    )


def _sql(k: int, rounds: int, dimensions: int, scale: int, seed: int) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
g{r} AS (SELECT e.vec_id, e.v, c.c, CAST(sum((e.x - c.x) * (e.x - c.x)) AS BIGINT) AS d FROM e JOIN c{r} c ON e.i = c.i GROUP BY ALL),
a{r} AS (SELECT vec_id, v, c, d FROM g{r} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (SELECT a.c, e.i, CAST(sum(e.x) AS HUGEINT) AS s, count(*) AS n FROM a{r} a JOIN e ON a.vec_id = e.vec_id GROUP BY ALL),
c{r + 1} AS (SELECT c.c, c.i, CAST(CASE WHEN m.n IS NULL THEN c.x ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS BIGINT) AS x
       FROM c{r} c LEFT JOIN m{r} m ON c.c = m.c AND c.i = m.i)""")
    return f"""
WITH w AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS (SELECT vec_id, v, unnest(range(1, {dimensions + 1})) AS i, unnest(v) AS x FROM w),
f AS (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c, vec_id FROM w QUALIFY c < {k}),
c0 AS (SELECT f.c, e.i, e.x FROM f JOIN e ON f.vec_id = e.vec_id),
{",".join(steps)},
h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT a.vec_id, CAST(a.c AS INT) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM a{rounds} a JOIN h ON a.c = h.c"""


@REGISTRY.query("op13_simplex_centroids", _sql(CENTROIDS, ROUNDS, DIMENSIONS, SCALE, SEED))
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings"))
