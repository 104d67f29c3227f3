"""Integer k-means whose distance computations are filtered by an n-simplex projection.

Distances of a vector to a few pivots are computed once and kept. Together with the distances
between the pivots they fix the vector's apex over the simplex of the pivots: its place in the
pivots' span and its height above it. Two apexes give a lower bound of the distance of their
vectors, as if both heights pointed the same way, and an upper bound, as if they pointed apart. A
round projects the centroids likewise, and only centroids whose lower bound does not exceed the
least upper bound, within a slack for rounding, are compared, in exact integers.

A round is one pass over the kept table; it moves a row of sums for each centroid and task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

DIMENSIONS = 64
SCALE = 1024
#: Pivots at most, and vectors (the first by hash) from which they are chosen.
PIVOTS, PIVOT_SAMPLE = 12, 256
#: Largest component in absolute value: squared distances of such vectors fit 64 bits.
LARGEST = 1 << 27
#: Share of the largest distance by which bounds are widened; rounding is below 1e-9 of it.
SLACK = 1e-6
#: A pivot stands at least this share of the largest distance above the span of earlier ones.
HEIGHT = 1e-2


def integers(vector: str = "embedding", dimensions: int = DIMENSIONS) -> Column:
    """floor(1024 * x) of each component, or null for a vector that takes no part."""
    x = F.col(vector).cast("array<double>")
    sound = (F.size(x) == dimensions) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c)
                                                 & (F.abs(c) < float("inf")))
    return F.when(F.coalesce(sound, F.lit(False)),
                  F.transform(x, lambda c: F.floor(F.lit(float(SCALE)) * c).cast("long")))


def order_hash(seed: int, key: Column) -> Column:
    """Lower-case hex sha256 of ``seed:key``; a null key is the empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.sha2(text.cast("binary"), 256)


class Simplex:
    """Apex coordinates over pivots, in floating point.

    ``pivots`` are integer vectors. Those too near the span of earlier ones are left out, so that
    the triangular system of the base is well conditioned.
    """

    def __init__(self, sample: np.ndarray, limit: int = PIVOTS) -> None:
        chosen: list[int] = []
        points = sample.astype(np.float64)
        self.base = np.zeros((0, 0))
        if len(points):
            chosen.append(0)
            self.base = np.zeros((1, 1))
            spread = np.sqrt(((points - points[0]) ** 2).sum(axis=1)).max()
            while len(chosen) < min(limit, len(points)):
                # the next pivot is the vector highest above the span of those so far
                apex = self._project(points[chosen], points, self.base)
                best = int(np.argmax(apex[:, -1]))
                if apex[best, -1] <= HEIGHT * spread:
                    break
                self.base = np.pad(np.vstack([self.base, apex[best]]), ((0, 0), (0, 1)))
                chosen.append(best)
        self.pivots = sample[chosen].astype(np.int64)

    @staticmethod
    def _project(pivots: np.ndarray, points: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Coordinates from distances alone; the last is the height above the pivots' span."""
        squares = np.stack([((points - p) ** 2).sum(axis=1) for p in pivots], axis=1)
        apex = np.zeros((len(points), len(pivots)))
        rest = squares[:, 0].copy()
        for j in range(1, len(pivots)):
            row = base[j]
            norm = float((row[:j] ** 2).sum())
            before = apex[:, :j - 1] @ row[:j - 1]
            apex[:, j - 1] = (squares[:, 0] - squares[:, j] + norm - 2 * before) / (2 * row[j - 1])
            rest -= apex[:, j - 1] ** 2
        apex[:, -1] = np.sqrt(np.maximum(rest, 0))
        return apex

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        return self._project(self.pivots.astype(np.float64), vectors.astype(np.float64), self.base)


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray,
            tops: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid (the smaller on ties), squared distance, comparisons made."""
    flat = ((apexes[:, None, :-1] - tops[None, :, :-1]) ** 2).sum(axis=2)
    lower = np.sqrt(flat + (apexes[:, None, -1] - tops[None, :, -1]) ** 2)
    upper = np.sqrt(flat + (apexes[:, None, -1] + tops[None, :, -1]) ** 2)
    reach = upper.min(axis=1)
    slack = SLACK * (upper.max(axis=1) + 1)
    row, number = np.nonzero(lower <= (reach + slack)[:, None])
    squares = np.full(lower.shape, np.iinfo(np.int64).max)
    for start in range(0, len(row), 1 << 14):
        r, c = row[start:start + (1 << 14)], number[start:start + (1 << 14)]
        squares[r, c] = ((vectors[r] - centroids[c]) ** 2).sum(axis=1)
    best = squares.argmin(axis=1)
    return best, squares[np.arange(len(best)), best], len(row)


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    """Binary cells of one length as rows of numbers."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, kind).reshape(len(column), -1)


class Clusters:
    """``count`` clusters of the vectors of ``rows`` after ``rounds`` rounds.

    Vectors take part that have exactly 64 components, none null or non-finite; their components
    x become floor(1024 * x). The centroids start as the vectors with the smallest hashes of
    ``seed:key`` (ties by components); with fewer vectors there are fewer centroids. An empty
    centroid stays. Null and repeated keys are rows like others, other columns are ignored, and
    an empty table gives no rows. A component beyond 2 ** 27 after scaling ends with an error,
    since its squared distances do not fit a long.
    """

    def __init__(self, rows: DataFrame, key: str = "vec_id", vector: str = "embedding",
                 count: int = 8, rounds: int = 10, seed: int = 3) -> None:
        self.key, self.spark = key, rows.sparkSession
        self.kind = dict(rows.dtypes)[key]
        kept = rows.select(F.col(key).alias("key"), integers(vector).alias("v")) \
            .filter("v is not null")
        # the vectors of the smallest hashes: a bounded sample for centroids and pivots
        first = kept.withColumn("hash", order_hash(seed, F.col("key"))).orderBy("hash", "v") \
            .limit(max(count, PIVOT_SAMPLE)).select("v").collect()
        sample = np.array([r.v for r in first], np.int64).reshape(len(first), DIMENSIONS)
        if len(sample) and np.abs(sample).max() >= LARGEST:
            raise ValueError(f"components beyond {LARGEST}")
        self.simplex = Simplex(sample)
        self.centroids = sample[:count]
        self.table = written(self._projected(kept), "vectors") if len(sample) else None
        for _ in range(rounds if len(sample) else 0):
            self._move()

    def _projected(self, kept: DataFrame) -> DataFrame:
        """Vectors and their apexes as packed numbers: what each round reads."""
        simplex = self.simplex

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
                vectors = flat.reshape(batch.num_rows, -1)
                if np.abs(vectors).max() >= LARGEST:
                    raise ValueError(f"components beyond {LARGEST}")
                apexes = simplex.apexes(vectors)
                packed = [v.tobytes() for v in vectors.astype("<i4")]
                tops = [a.tobytes() for a in apexes.astype("<f8")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), pa.array(packed, pa.binary()),
                     pa.array(tops, pa.binary())], names=["key", "v", "apex"])
        return kept.mapInArrow(run, f"key {self.kind}, v binary, apex binary")

    def _assigned(self, function, columns: list[str], ddl: str) -> DataFrame:
        """``function(batch, vectors, numbers, squares)`` of each batch, as record batches."""
        centroids, tops = self.centroids, self.simplex.apexes(self.centroids)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    vectors = _matrix(batch.column("v"), "<i4").astype(np.int64)
                    number, squares, _ = nearest(
                        vectors, _matrix(batch.column("apex"), "<f8"), centroids, tops)
                    yield function(batch, vectors, number, squares)
        return self.table.select(*columns).mapInArrow(run, ddl)

    def _move(self) -> None:
        """Replaces each centroid that has vectors by the floor of their mean."""
        count = len(self.centroids)

        def sums(batch: pa.RecordBatch, vectors: np.ndarray, number: np.ndarray,
                 squares: np.ndarray) -> pa.RecordBatch:
            total = np.zeros((count, vectors.shape[1]), np.int64)
            np.add.at(total, number, vectors)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(count, dtype=np.int32)),
                 pa.array(np.bincount(number, minlength=count)), pa.array(total.tolist())],
                names=["cluster", "n", "total"])
        dimensions = self.centroids.shape[1]
        parts = self._assigned(sums, ["v", "apex"], "cluster int, n long, total array<long>")
        # decimals: a sum over all vectors may exceed a long
        rows = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *(
            F.sum(F.col("total")[i].cast("decimal(20,0)")).alias(f"s{i}")
            for i in range(dimensions))).collect()
        moved = self.centroids.copy()
        for row in rows:
            if row.n:
                moved[row.cluster] = [int(row[f"s{i}"]) // int(row.n) for i in range(dimensions)]
        self.centroids = moved

    def members(self) -> DataFrame:
        """Key, ``cluster`` and squared ``distance`` of each vector, as a table."""
        def found(batch: pa.RecordBatch, vectors: np.ndarray, number: np.ndarray,
                  squares: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(number.astype(np.int32)), pa.array(squares)],
                names=["key", "cluster", "distance"])
        ddl = f"key {self.kind}, cluster int, distance long"
        rows = self.spark.createDataFrame([], ddl) if self.table is None else written(
            self._assigned(found, ["key", "v", "apex"], ddl), "members")
        return rows.withColumnRenamed("key", self.key)

    def comparisons(self) -> tuple[int, int]:
        """Exact comparisons that a last assignment makes, and those without the filter."""
        if self.table is None:
            return 0, 0
        centroids, tops = self.centroids, self.simplex.apexes(self.centroids)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    made = nearest(_matrix(batch.column("v"), "<i4").astype(np.int64),
                                   _matrix(batch.column("apex"), "<f8"), centroids, tops)[2]
                    yield pa.RecordBatch.from_pydict(
                        {"made": [made], "all": [batch.num_rows * len(centroids)]})
        row = self.table.mapInArrow(run, "made long, all long").agg(
            F.sum("made").alias("made"), F.sum("all").alias("all")).first()
        return row.made, row["all"]

    def hashes(self) -> list[str]:
        """Lower-case hex sha256 of each centroid's components, joined by commas."""
        return [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()
                for c in self.centroids]

    def report(self) -> DataFrame:
        """``members`` with the inertia of the cluster and of all, and the centroid's hash."""
        members = self.members()
        sums = {r.cluster: int(r.s) for r in members.groupBy("cluster").agg(
            F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
        facts = [F.struct(F.lit(sums.get(i, 0)).cast("long").alias("cluster_inertia"),
                          F.lit(text).alias("centroid_sha256"))
                 for i, text in enumerate(self.hashes())]
        if not facts:
            return members.selectExpr("*", "0L AS cluster_inertia", "0L AS inertia",
                                      "'' AS centroid_sha256")
        # one literal for each centroid: no join
        return members.withColumn("_fact", F.get(F.array(*facts), F.col("cluster"))).select(
            self.key, "cluster", "distance", F.col("_fact.cluster_inertia"),
            F.lit(sum(sums.values())).cast("long").alias("inertia"),
            F.col("_fact.centroid_sha256"))
