"""Centroid clustering (Lloyd's rounds) of 64-component vectors in exact
integers, by bit planes and popcounts.

A kept vector has exactly 64 components, none null or non-finite; component x
becomes the integer floor(1024 * x). With B bits in two's complement a vector
is B *planes*: plane i is a uint64 whose bit j is bit i of component j, with
the weight 2^i (the top plane: -2^i). For a vector x and a centroid c

    x . c = sum over planes i, j of weight_i * weight_j * popcount(x_i & c_j)

so dot products, norms and squared distances are exact, from B * B popcounts
of single words. B is what the largest component of the whole table needs.
The vectors are turned into planes once and written to the shared folder; a
round is one pass over them with the centroids' planes broadcast (k * B
words), in which each task sums its vectors by cluster (counts of set bits by
plane and component); the sums are combined by cluster, and only they reach
the driver.

Distances and sums are int64 up to ``FAST_BITS`` bits and Python integers
beyond, so the clusters are exact for any finite input; a distance or inertia
above 2^63 - 1 is given as 2^63 - 1.

Defined results: other vectors are left out; rows that repeat (or share an id)
are vectors each; a null id counts as the empty text in the hash that orders
the first centroids, and equal hashes are ordered by the vectors; fewer
vectors than ``k`` give fewer centroids; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triage.llm.common import bound_batches, written

SIZE, SCALE = 64, 1024
#: centroids, rounds, and the text before an id whose hash orders the first centroids
CENTROIDS, ROUNDS, SEED = 8, 10, "3:"
#: planes up to which distances and a task's sums fit int64
FAST_BITS = 28
MOST = (1 << 63) - 1
#: planes that are summed together (a sum stays below 2^16 times the rows of the table)
LIMB = 16


def kept(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == SIZE) & finite, F.lit(False))


def integers(rows: np.ndarray) -> np.ndarray:
    """floor(1024 * x) of finite doubles: int64, or Python integers where that
    could overflow."""
    if not rows.size or np.abs(rows).max() < 2.0 ** 50:
        return np.floor(rows * SCALE).astype(np.int64)
    # a double of 2^53 or more is an integer
    exact = [SCALE * int(x) if abs(x) >= 2.0 ** 53 else math.floor(x * SCALE) for x in rows.ravel().tolist()]
    return np.array(exact, object).reshape(rows.shape)


def bits_of(least: int, most: int) -> int:
    """Bits of a two's complement that holds both."""
    return max((-least - 1).bit_length() if least < 0 else 0, most.bit_length() if most > 0 else 0) + 1


def to_planes(v: np.ndarray, bits: int) -> np.ndarray:
    """(rows, bits) words of (rows, 64) integers."""
    out = np.zeros((len(v), bits), np.uint64)
    for i in range(bits):
        bit = ((v >> i) & 1).astype(np.uint8)  # arithmetic shift: the sign fills up
        out[:, i] = np.packbits(bit, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def weights(bits: int) -> np.ndarray:
    """Weights of the planes."""
    w = [1 << i for i in range(bits)]
    w[-1] = -w[-1]
    return np.array(w, np.int64 if bits <= FAST_BITS else object)


def dots(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Dot products of the vectors with planes ``x`` (rows, B) and ``c`` (B,)."""
    w = weights(x.shape[1])
    total = np.zeros(len(x), w.dtype)
    for i in range(x.shape[1]):
        common = np.bitwise_count(x[:, i, None] & c[None, :])
        total = total + w[i] * (common.astype(w.dtype) @ w)
    return total


def norms(x: np.ndarray) -> np.ndarray:
    w = weights(x.shape[1])
    total = np.zeros(len(x), w.dtype)
    for i in range(x.shape[1]):
        total = total + w[i] * (np.bitwise_count(x[:, i, None] & x).astype(w.dtype) @ w)
    return total


def nearest(x: np.ndarray, centroids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid (ties: the smaller number) of each vector, and
    |c|^2 - 2 x.c, the squared distance less |x|^2."""
    score = np.stack([norms(c[None, :])[0] - 2 * dots(x, c) for c in centroids], axis=1)
    best = score.argmin(axis=1)
    return best, score[np.arange(len(x)), best]


def planes_of(batch: pa.RecordBatch, bits: int) -> np.ndarray:
    col = batch.column(batch.schema.get_field_index("planes"))
    return np.array([np.frombuffer(b, "<u8") for b in col.to_pylist()], np.uint64).reshape(len(col), bits)


def as_planes(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, planes) of the kept vectors, written, and the number of planes."""
    rows = (vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(kept(F.col("v"))))
    edge = rows.agg(F.min(F.array_min("v")).alias("least"), F.max(F.array_max("v")).alias("most")).first()
    if edge.least is None:
        return rows.select("id", F.lit(b"").alias("planes")), 1
    bits = bits_of(*(int(integers(np.array([[x]]))[0, 0]) for x in edge))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b.column(1).flatten().to_numpy(zero_copy_only=False)
            p = to_planes(integers(flat.reshape(-1, SIZE)), bits)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in p], pa.binary())], ["id", "planes"])

    return written(rows.mapInArrow(run, f"id {kind}, planes binary"), "planes"), bits


def sums(table: DataFrame, centroids: list[np.ndarray], bits: int) -> dict[int, tuple[int, list[int]]]:
    """Vectors of each cluster, and their exact sum."""
    limbs = -(-bits // LIMB)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centroids), np.int64)
        total = np.zeros((len(centroids), limbs, SIZE), np.int64)
        for b in batches:
            x = planes_of(b, bits)
            best, _ = nearest(x, centroids)
            count += np.bincount(best, minlength=len(centroids))
            for i in range(bits):
                of = np.unpackbits(x[:, i].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                w = (1 << (i % LIMB)) * (-1 if i == bits - 1 else 1)
                for c in np.unique(best).tolist():
                    total[c, i // LIMB] += w * of[best == c].sum(axis=0, dtype=np.int64)
        cells = [(c, k) for c in np.flatnonzero(count).tolist() for k in range(limbs)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in cells], pa.int32()), pa.array([k for _, k in cells], pa.int32()), pa.array([int(count[c]) for c, _ in cells], pa.int64()),
             pa.array([total[c, k].tolist() for c, k in cells], pa.list_(pa.int64()))], ["c", "limb", "n", "s"])

    parts = (table.select("planes").mapInArrow(run, "c int, limb int, n bigint, s array<bigint>").groupBy("c", "limb")
             .agg(F.sum("n").alias("n"), *(F.sum(F.col("s")[j]).alias(f"s{j}") for j in range(SIZE))))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in parts.collect():  # a row for each cluster and limb
        n, s = out.get(r.c, (r.n, [0] * SIZE))
        out[r.c] = (n, [a + (int(r[f"s{j}"]) << (LIMB * r.limb)) for j, a in enumerate(s)])
    return out


def fit(table: DataFrame, bits: int, k: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED) -> list[list[int]]:
    """The final centroids' components."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = table.select(digest.alias("_h"), "planes").orderBy("_h", "planes").limit(k).collect()  # k rows
    centroids = [components(np.frombuffer(r.planes, "<u8"), bits) for r in first]
    for _ in range(rounds if centroids else 0):
        found = sums(table, [packed(c, bits) for c in centroids], bits)
        centroids = [[s // found[i][0] for s in found[i][1]] if i in found else c for i, c in enumerate(centroids)]
    return centroids


def packed(c: list[int], bits: int) -> np.ndarray:
    return to_planes(np.array([c], np.int64 if bits <= 62 else object), bits)[0]


def components(planes: np.ndarray, bits: int) -> list[int]:
    """A vector's integers from its planes."""
    w = [int(x) for x in weights(bits)]
    return [sum(w[i] for i in range(bits) if int(planes[i]) >> j & 1) for j in range(SIZE)]


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CENTROIDS,
            rounds: int = ROUNDS, seed: str = SEED) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of
    each kept vector."""
    spark = vectors.sparkSession
    bound_batches(spark)
    table, bits = as_planes(vectors, id_col, vector_col)
    centroids = fit(table, bits, k, rounds, seed)
    kind = table.schema["id"].dataType.simpleString()
    words = [packed(c, bits) for c in centroids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = planes_of(b, bits)
            best, score = nearest(x, words)
            distance = norms(x) + score
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(best, pa.int32()), pa.array([min(int(d), MOST) for d in distance], pa.int64())],
                                             ["id", "cluster", "distance"])

    found = written((table if centroids else table.limit(0)).mapInArrow(run, f"id {kind}, cluster int, distance bigint"), "clusters")
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    by_cluster = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(exact.alias("s")).collect()}  # k rows
    rows = [(c, min(s, MOST), min(sum(by_cluster.values()), MOST), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
            for c, s in by_cluster.items()]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
