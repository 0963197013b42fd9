"""Centroid clustering in whole numbers, with an n-simplex projection in front of the exact distances.

A few vectors are pivots. The distances of a vector to them fix the apex of a simplex over
the pivots: its place in the space the pivots span, and its altitude above it. Of two
apexes, the distance is a lower bound of the distance of their vectors, and the distance with
one altitude turned downwards an upper bound (Connor et al. 2017, "High-dimensional simplexes
for supermetric search"). The apexes are computed once and written next to the vectors. In
each round, centroids whose lower bound exceeds the least upper bound of a vector are out;
the rest is compared exactly, in 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliate.errors import DataError
from foliate.llm.frames import written
from foliate.session import small_frame

DIMENSIONS, SCALE = 64, 1024
CLUSTERS, ROUNDS, SEED, PIVOTS = 8, 10, 3, 16
#: Beyond this size of a component, the squared distance of two vectors of 64 might not fit 64 bits.
LARGEST = 1 << 27
#: Numbers that one step of bounds works on.
STEP = 1 << 21


@dataclass(frozen=True)
class Simplex:
    """A base of pivots: ``inverse`` turns distances into coordinates, ``edge`` is the longest and ``height`` the least altitude in it."""

    pivots: np.ndarray
    inverse: np.ndarray
    squares: np.ndarray
    edge: float
    height: float

    @classmethod
    def of(cls, vectors: np.ndarray) -> Simplex:
        """The simplex of those vectors that stand clearly above the ones before them."""
        chosen, rows = [0], []
        offsets = (vectors - vectors[0]).astype(np.float64)
        edge = float(np.sqrt((offsets**2).sum(axis=1).max(initial=0)))
        for i in range(1, len(vectors)):
            above = offsets[i].copy()
            for row in rows:
                above -= (above @ row) * row
            height = float(np.sqrt(above @ above))
            if height > 1e-3 * edge:
                chosen.append(i)
                rows.append(above / height)
        base = offsets[chosen[1:]]
        lower = np.linalg.cholesky(base @ base.T) if rows else np.zeros((0, 0))
        height = float(np.diag(lower).min(initial=edge))
        return cls(vectors[chosen], np.linalg.inv(lower), (base**2).sum(axis=1), edge, height)

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """Per vector the coordinates of its apex, the altitude last."""
        squared = np.stack([_squared(vectors, p) for p in self.pivots], axis=1).astype(np.float64)
        flat = (squared[:, :1] + self.squares - squared[:, 1:]) / 2 @ self.inverse.T
        height = np.sqrt(np.maximum(squared[:, 0] - (flat**2).sum(axis=1), 0))
        return np.concatenate([flat, height[:, None]], axis=1)

    def candidates(self, apexes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Which centroids (apexes) may be the nearest of each vector, with room for rounding."""
        mask = np.empty((len(apexes), len(centroids)), bool)
        step = max(1, STEP // max(1, centroids.size))
        far_c = np.sqrt((centroids**2).sum(axis=1))
        for a in range(0, len(apexes), step):
            part = apexes[a : a + step]
            flat = ((part[:, None, :-1] - centroids[None, :, :-1]) ** 2).sum(axis=2)
            lower = flat + (part[:, None, -1] - centroids[None, :, -1]) ** 2
            upper = flat + (part[:, None, -1] + centroids[None, :, -1]) ** 2
            far = np.sqrt((part**2).sum(axis=1))[:, None] + far_c
            room = 1e-10 * (far + self.edge) ** 2 * (1 + far / max(self.height, 1e-9))
            mask[a : a + step] = lower - room <= (upper + room).min(axis=1, keepdims=True)
        return mask


def _squared(vectors: np.ndarray, other: np.ndarray) -> np.ndarray:
    apart = vectors - other
    return np.einsum("ij,ij->i", apart, apart)


def nearest(vectors: np.ndarray, centroids: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest candidate of each vector and its squared distance, exactly; of equal ones the smaller number."""
    best = np.full(len(vectors), np.iinfo(np.int64).max)
    where = np.zeros(len(vectors), np.int32)
    for k, centroid in enumerate(centroids):
        rows = np.flatnonzero(mask[:, k])
        distance = _squared(vectors[rows], centroid)
        closer = distance < best[rows]
        best[rows[closer]], where[rows[closer]] = distance[closer], k
    return where, best


def whole_numbers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)``; refuses components that are too large for exact 64-bit distances."""
    scaled = np.floor(values * scale)
    if np.abs(scaled).max(initial=0) >= LARGEST:
        raise DataError(f"a component times {scale} is not below {LARGEST}; its distances don't fit 64 bits")
    return scaled.astype(np.int64)


def usable(vector: str | Column, dimensions: int = DIMENSIONS) -> Column:
    """Whether a vector has the right length and only finite numbers."""
    return (F.size(vector) == dimensions) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _numbers(batch: pa.RecordBatch, column: str, kind: str, width: int) -> np.ndarray:
    """A column of packed little-endian numbers as a matrix."""
    return np.frombuffer(b"".join(batch.column(column).to_pylist()), kind).reshape(-1, width)


def _projected(vectors: DataFrame, simplex: Simplex, dimensions: int, scale: int) -> DataFrame:
    """``vec_id``, ``vector`` and ``apex`` of each kept vector, the numbers packed as bytes; written once."""
    kind = vectors.schema["vec_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = whole_numbers(batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions), scale)
            apexes = simplex.apexes(whole)
            packed = [pa.array([row.tobytes() for row in numbers], pa.binary()) for numbers in (whole.astype("<i4"), apexes.astype("<f8"))]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), *packed], names=["vec_id", "vector", "apex"])

    return written(vectors.mapInArrow(run, T.StructType([kind]).add("vector", T.BinaryType()).add("apex", T.BinaryType())), "simplex")


def _assigner(simplex: Simplex, centroids: np.ndarray) -> Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    tops = simplex.apexes(centroids)

    def assign(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        vectors = _numbers(batch, "vector", "<i4", centroids.shape[1]).astype(np.int64)
        mask = simplex.candidates(_numbers(batch, "apex", "<f8", tops.shape[1]), tops)
        return vectors, *nearest(vectors, centroids, mask)

    return assign


def _moved(placed: DataFrame, simplex: Simplex, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round. A task sends one sum per cluster and dimension, whatever the number of its vectors."""
    assign = _assigner(simplex, centroids)
    count, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, rows = np.zeros((count, width), np.int64), np.zeros(count, np.int64)
        for batch in batches:
            vectors, where, _ = assign(batch)
            for k in np.unique(where):
                mine = where == k
                sums[k] += vectors[mine].sum(axis=0)
                rows[k] += mine.sum()
        full = np.flatnonzero(rows)
        columns = [np.repeat(full, width).astype(np.int32), np.tile(np.arange(width, dtype=np.int32), len(full)), sums[full].ravel(), np.repeat(rows[full], width)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cluster", "dim", "total", "n"])

    parts = placed.select("vector", "apex").mapInArrow(run, "cluster int, dim int, total bigint, n bigint")
    exact = (F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("total", "n"))
    moved = centroids.copy()
    for r in parts.groupBy("cluster", "dim").agg(*exact).collect():
        moved[r["cluster"], r["dim"]] = int(r["total"]) // int(r["n"])
    return moved


def cluster(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, pivots: int = PIVOTS,
    seed: int = SEED, dimensions: int = DIMENSIONS, scale: int = SCALE,
) -> DataFrame:
    """``vec_id``, ``cluster``, squared ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` per usable vector.

    Vectors of another length, with a null or without a finite value are left out, as is a null
    vector. Centroids start as the vectors of the least sha256 of ``seed:id``, null ids last,
    equal ids by their components; fewer vectors than ``clusters`` are that many centroids. Each
    repeated row is a vector of its own. Of centroids equally near the smaller number wins. An
    empty table gives no rows; other columns are not read. A component of 2^27 or more in whole
    numbers is a ``DataError``, as distances would not fit 64 bits.

    The driver holds the first ``clusters`` or ``pivots`` vectors and, per round, one row per
    cluster and dimension.
    """
    own = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).where(usable("vector", dimensions))
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = own.orderBy(rank.asc_nulls_last(), "vector").limit(max(clusters, pivots)).collect()
    if not first:
        facts = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return small_frame(vectors.sparkSession, [], f"vec_id {own.schema['vec_id'].dataType.simpleString()}, {facts}")
    chosen = whole_numbers(np.array([r["vector"] for r in first], np.float64), scale)
    simplex = Simplex.of(chosen[:pivots])
    centroids = chosen[:clusters].copy()
    placed = _projected(own, simplex, dimensions, scale)
    for _ in range(rounds):
        centroids = _moved(placed, simplex, centroids)
    return _with_sums(_assigned(placed, simplex, centroids), centroids)


def _assigned(placed: DataFrame, simplex: Simplex, centroids: np.ndarray) -> DataFrame:
    assign = _assigner(simplex, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, where, distance = assign(batch)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(where), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    kind = placed.schema["vec_id"]
    return written(placed.mapInArrow(run, T.StructType([kind]).add("cluster", T.IntegerType()).add("distance", T.LongType())), "assigned")


def _with_sums(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    sums = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digests = [sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]
    rows = [(k, s, sum(sums.values()), digests[k]) for k, s in sums.items()]
    facts = small_frame(assigned.sparkSession, rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(facts, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
