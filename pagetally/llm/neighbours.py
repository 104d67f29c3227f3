"""Approximate nearest neighbours by a hierarchical small-world graph per shard.

Equal vectors are one point that keeps the smallest ids it needs, so that copies do not fill the
graph. Points go to the cell of the nearest of a few pivots, which a bounded sample gives; a cell
with more points than a shard holds is split by hash. Each shard's graph is one row of a table:
its vectors and, per level, one flat array of neighbour numbers. A query goes to the shards of
its nearest cells. How many cells that takes is measured: sampled probes are compared with all
points, and so many cells are searched that they hold ``COVERED`` of the probes' nearest points.
The nearest of all shards searched are merged by exact cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Points of a shard and bytes of its vectors, and queries that a shard answers at once, about.
SHARD_ROWS, SHARD_BYTES, BLOCK_ROWS = 16_384, 1 << 26, 4096
#: Cells of a dimension and bytes of their pivots, at most; dimensions with cells (of any other
#: every shard is searched).
MOST_CELLS, PIVOT_BYTES, MOST_DIMS = 1024, 1 << 22, 16
#: Rows and bytes, about, of the sample that gives the pivots; probes that give the cells to search.
SAMPLE_ROWS, SAMPLE_BYTES, PROBES = 16_384, 1 << 25, 256
#: Share of the probes' nearest points that the cells to search must hold.
COVERED = 0.98
#: Neighbours that a new point links to, and most on level 0 and above it.
LINKS, MOST, MOST_ABOVE = 16, 32, 16
#: Points kept while inserting and while searching.
BEAM_BUILD, BEAM_SEARCH = 80, 160
#: Multiplications of a matrix product that BLAS does not spread over threads.
ONE_THREAD = 200_000


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``left`` and ``right``, on one thread.

    BLAS spreads a large product over threads, which then wait on cores that other tasks use.
    """
    right = np.swapaxes(right, -1, -2)
    step = max(1, ONE_THREAD // (right.shape[-2] * max(1, right.shape[-1])))
    return np.concatenate([np.matmul(left[..., at:at + step, :], right)
                           for at in range(0, max(1, left.shape[-2]), step)], axis=-2)


def _beam(points: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray,
          beam: int, width: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """The best ``beam`` points that each query reaches on one level, nearest first.

    All queries walk at once; each step opens the ``width`` nearest points not opened yet. A
    query is done when none of its best ``beam`` is left to open. Missing points are -1.
    """
    n_q, n_p, depth = len(queries), len(points), links.shape[1]
    best = np.full((n_q, beam), -1, np.int64)
    near = np.full((n_q, beam), -np.inf, np.float32)
    open_ = np.zeros((n_q, beam), bool)
    seen = np.zeros((n_q, n_p + 1), bool)
    seen[:, n_p] = True
    for k in range(min(entry.shape[1], beam)):
        at = entry[:, k]
        rows = np.flatnonzero((at >= 0) & ~seen[np.arange(n_q), at])
        best[rows, k], open_[rows, k] = at[rows], True
        near[rows, k] = np.einsum("ij,ij->i", queries[rows], points[at[rows]])
        seen[rows, at[rows]] = True
    live = np.arange(n_q)
    while len(live):
        score = np.where(open_[live], near[live], -np.inf)
        pick = np.argpartition(-score, min(width, beam) - 1, axis=1)[:, :width]
        chosen = np.take_along_axis(score, pick, 1) > -np.inf
        some = chosen.any(axis=1)
        live, pick, chosen = live[some], pick[some], chosen[some]
        if not len(live):
            break
        open_[live[:, None], pick] = False
        opened = np.where(chosen, best[live[:, None], pick], n_p)
        to = np.where(opened[:, :, None] < n_p, links[np.minimum(opened, n_p - 1)], -1) \
            .reshape(len(live), -1)
        to = np.where(to < 0, n_p, to)
        row, col = np.nonzero(~seen[live[:, None], to])
        # a point that two opened ones link to is taken once
        key = np.sort(row * (n_p + 1) + to[row, col])
        row, found = np.divmod(key[np.diff(key, prepend=-1) > 0], n_p + 1)
        seen[live[row], found] = True
        number = np.bincount(row, minlength=len(live))
        column = np.arange(len(row)) - (np.cumsum(number) - number)[row]
        new = np.full((len(live), int(number.max())), -1, np.int64)
        value = np.full(new.shape, -np.inf, np.float32)
        new[row, column] = found
        value[row, column] = np.einsum("ij,ij->i", queries[live[row]], points[found])
        all_near = np.concatenate([near[live], value], axis=1)
        all_best = np.concatenate([best[live], new], axis=1)
        all_open = np.concatenate([open_[live], new >= 0], axis=1)
        keep = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
        near[live] = np.take_along_axis(all_near, keep, 1)
        best[live] = np.where(near[live] > -np.inf, np.take_along_axis(all_best, keep, 1), -1)
        open_[live] = np.take_along_axis(all_open, keep, 1) & (near[live] > -np.inf)
    order = np.argsort(-near, axis=1, kind="stable")
    return np.take_along_axis(best, order, 1), np.take_along_axis(near, order, 1)


def _diverse(points: np.ndarray, near: np.ndarray, candidates: np.ndarray,
             number: int) -> np.ndarray:
    """Of candidates, nearest first, those nearer to the point than to any chosen before.

    Free places go to the nearest others. -1 stands for none.
    """
    n, width = candidates.shape
    there = candidates >= 0
    vectors = points[np.maximum(candidates, 0)]
    among = _products(vectors, vectors)
    chosen = np.zeros((n, width), bool)
    closest = np.full((n, width), -np.inf, np.float32)
    left = np.full(n, number)
    for k in range(width):
        take = there[:, k] & (left > 0) & (near[:, k] > closest[:, k])
        chosen[take, k] = True
        left[take] -= 1
        closest = np.where(take[:, None], np.maximum(closest, among[:, k]), closest)
    value = np.where(there, near, -np.inf) + np.where(chosen, 4.0, 0.0)
    order = np.argsort(-value, axis=1, kind="stable")[:, :number]
    out = np.take_along_axis(np.where(there, candidates, -1), order, 1)
    return np.pad(out, ((0, 0), (0, number - out.shape[1])), constant_values=-1)


class Graph:
    """Unit vectors of a shard and flat neighbour arrays, one per level; -1 pads a list."""

    def __init__(self, points: np.ndarray, links: list[np.ndarray]) -> None:
        self.points, self.links = points, links

    @classmethod
    def build(cls, points: np.ndarray, seed: int = 11) -> Graph:
        """Insert all points, in batches that search the graph of the earlier ones.

        Points come in the order of their levels, the highest first, so the first is the entry.
        """
        n = len(points)
        random = np.random.Generator(np.random.PCG64(seed))
        level = np.minimum((-np.log(1 - random.random(n)) / np.log(LINKS)).astype(int), 6)
        level = -np.sort(-level)
        links = [np.full((n, MOST if k == 0 else MOST_ABOVE), -1, np.int32)
                 for k in range((level[0] if n else 0) + 1)]
        graph = cls(points, links)
        start = 1
        while start < n:
            same = int(np.searchsorted(-level, -level[start], side="right"))
            stop = min(same, start + max(1, min(256, start)))
            graph._insert(start, stop, int(level[start]))
            start = stop
        return graph

    def _insert(self, start: int, stop: int, level: int) -> None:
        own = np.arange(start, stop)
        queries = self.points[own]
        entry = np.zeros((len(own), 1), np.int64)
        for k in range(len(self.links) - 1, -1, -1):
            beam = min(BEAM_BUILD, start) if k <= level else 1
            best, near = _beam(self.points[:start], self.links[k][:start], queries, entry, beam)
            entry = best
            if k > level:
                continue
            # the others of the batch are candidates too
            others = _products(queries, queries)
            np.fill_diagonal(others, -np.inf)
            best = np.concatenate([best, np.broadcast_to(own, others.shape)], axis=1)
            near = np.concatenate([near, others], axis=1)
            best = np.where(near > -np.inf, best, -1)
            order = np.argsort(-near, axis=1, kind="stable")[:, :BEAM_BUILD]
            best, near = np.take_along_axis(best, order, 1), np.take_along_axis(near, order, 1)
            chosen = _diverse(self.points, near, best, LINKS)
            self.links[k][own, :LINKS] = chosen[:, :self.links[k].shape[1]]
            self._link_back(k, np.repeat(own, LINKS), chosen.ravel())

    def _link_back(self, k: int, source: np.ndarray, target: np.ndarray) -> None:
        """Add source to the list of target; a list that is too long keeps a diverse part."""
        links = self.links[k]
        there = target >= 0
        source, target = source[there], target[there]
        there = ~(links[target] == source[:, None]).any(axis=1)
        source, target = source[there], target[there]
        if not len(target):
            return
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, number = np.unique(target, return_index=True, return_counts=True)
        for part in range(0, len(nodes), 256):
            some = slice(part, part + 256)
            most = int(number[some].max())
            added = np.full((len(nodes[some]), most), -1, np.int64)
            for i, (f, c) in enumerate(zip(first[some], number[some])):
                added[i, :c] = source[f:f + c]
            lists = np.concatenate([links[nodes[some]], added], axis=1)
            order = np.argsort(lists < 0, axis=1, kind="stable")
            lists = np.take_along_axis(lists, order, 1)
            size = (lists >= 0).sum(axis=1)
            fits = size <= links.shape[1]
            wide = np.pad(lists, ((0, 0), (0, max(0, links.shape[1] - lists.shape[1]))),
                          constant_values=-1)
            links[nodes[some][fits]] = wide[fits, :links.shape[1]]
            full = np.flatnonzero(~fits)
            if len(full):
                rows = lists[full]
                near = np.einsum("ijk,ik->ij", self.points[np.maximum(rows, 0)],
                                 self.points[nodes[some][full]])
                near = np.where(rows >= 0, near, -np.inf)
                order = np.argsort(-near, axis=1, kind="stable")
                links[nodes[some][full]] = _diverse(
                    self.points, np.take_along_axis(near, order, 1),
                    np.take_along_axis(rows, order, 1), links.shape[1])

    def search(self, queries: np.ndarray, beam: int = BEAM_SEARCH) -> np.ndarray:
        """Numbers of the nearest points found, nearest first; -1 where there are fewer."""
        entry = np.zeros((len(queries), 1), np.int64)
        for k in range(len(self.links) - 1, -1, -1):
            entry, _ = _beam(self.points, self.links[k], queries, entry,
                             min(len(self.points), beam if k == 0 else 4))
        return entry


def _unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return (v / np.sqrt((v * v).sum(axis=1, keepdims=True))).astype(np.float32)


def _cosines(query: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Double precision; where squares would leave the range, of the vectors made smaller."""
    q, o = query.astype(np.float64), others.astype(np.float64)
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        found = (o @ q) / (np.sqrt((o * o).sum(axis=1)) * np.sqrt((q * q).sum()))
        if not np.isfinite(found).all():
            q, o = q / np.abs(q).max(), o / np.abs(o).max(axis=1, keepdims=True)
            found = (o @ q) / (np.sqrt((o * o).sum(axis=1)) * np.sqrt((q * q).sum()))
    return found


def usable(vector: Column) -> Column:
    """Vectors with components, all finite and not all zero."""
    return F.coalesce(
        (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0), F.lit(False))


def _points(vectors: DataFrame, k: int) -> DataFrame:
    """``embedding, dim, ids``: distinct vectors with their ``k + 1`` smallest ids.

    The row limit works before rows are shuffled, so a vector that many rows share is cut to
    ``k + 1`` rows per task; no answer of ``k`` rows needs more of equal nearness.
    """
    within = Window.partitionBy("embedding").orderBy("vec_id")
    ranked = vectors.withColumn("nth", F.row_number().over(within)).filter(F.col("nth") <= k + 1)
    return ranked.groupBy("embedding").agg(
        F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn(
        "dim", F.size("embedding"))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(
        np.float64, copy=False).reshape(-1, dim)


def _shard_rows(dim: int) -> int:
    return max(64, min(SHARD_ROWS, SHARD_BYTES // (8 * dim)))


@dataclass
class Routes:
    """Cells of each large dimension: pivots, cells to search, and the shards of each cell.

    ``shards`` has (first shard, number of shards) per (dimension, cell), and ``blocks`` the number
    of blocks that a cell's queries are cut into. A dimension without pivots is one cell; one that
    is not named has one shard and one block.
    """

    pivots: dict[int, np.ndarray] = field(default_factory=dict)
    probed: dict[int, int] = field(default_factory=dict)
    shards: dict[tuple[int, int], tuple[int, int]] = field(default_factory=dict)
    blocks: dict[tuple[int, int], int] = field(default_factory=dict)
    total: int = 1

    def cells(self, vectors: np.ndarray, number: int | None = None) -> np.ndarray:
        """Cells of vectors of one dimension, nearest first: ``number`` of them or those to search."""
        pivots = self.pivots.get(vectors.shape[1])
        if pivots is None:
            return np.zeros((len(vectors), 1), np.int64)
        number = self.probed[vectors.shape[1]] if number is None else number
        near = _products(_unit(vectors), pivots)
        if number == 1:
            return near.argmax(axis=1)[:, None]
        return np.argsort(-near, axis=1, kind="stable")[:, :number]

    def first(self, dim: int, cell: int) -> tuple[int, int]:
        return self.shards.get((dim, cell), (dim % self.total, 1))


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``dim``, row numbers and vectors of the rows of each dimension."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == dim)
        yield dim, rows, _matrix(batch.column("embedding").take(pa.array(rows)), dim)


def _counts(df: DataFrame, routes: Routes, number: int | None) -> dict[tuple[int, int], int]:
    """Rows per cell of the dimensions with pivots: at most ``MOST_DIMS * MOST_CELLS`` numbers."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, _, vectors in _by_dim(batch):
                if dim in routes.pivots:
                    cells, rows = np.unique(routes.cells(vectors, number), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(cells), dim), pa.int32()),
                         pa.array(cells, pa.int32()), pa.array(rows, pa.int64())],
                        names=["dim", "cell", "n"])
    found = df.select("dim", "embedding").mapInArrow(run, "dim int, cell int, n long")
    return {(r.dim, r.cell): r.n for r in
            found.groupBy("dim", "cell").agg(F.sum("n").alias("n")).collect()}


def _pivots(sample: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Unit vectors: means of the sample's vectors nearest to them, from sampled starts."""
    pivots = sample[:cells]
    for _ in range(rounds):
        own = (sample @ pivots.T).argmax(axis=1)
        sums = np.zeros(pivots.shape)
        np.add.at(sums, own, sample)
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        pivots = np.where(length > 0, sums / np.maximum(length, 1e-30), pivots).astype(np.float32)
    return pivots


def _probed(points: DataFrame, dim: int, probes: np.ndarray, routes: Routes, k: int) -> int:
    """Cells to search: in them lie ``COVERED`` of the probes' ``k`` nearest of all points.

    A probe is compared with every point; a point in its own direction (its own row) is left out.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = np.full((len(probes), k), -2, np.float32)
        cell = np.zeros((len(probes), k), np.int64)
        for batch in batches:
            vectors = _matrix(batch.column("embedding"), dim)
            if not len(vectors):
                continue
            near = _products(probes, _unit(vectors))
            near[near > 1 - 1e-6] = -2
            own = np.broadcast_to(routes.cells(vectors, 1)[:, 0], near.shape)
            near, own = np.concatenate([score, near], axis=1), np.concatenate([cell, own], axis=1)
            top = np.argpartition(-near, k - 1, axis=1)[:, :k]
            score, cell = np.take_along_axis(near, top, 1), np.take_along_axis(own, top, 1)
        there = score > -2
        probe = np.broadcast_to(np.arange(len(probes))[:, None], score.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(probe[there], pa.int32()), pa.array(score[there], pa.float32()),
             pa.array(cell[there], pa.int32())], names=["probe", "score", "cell"])
    found = points.filter(F.col("dim") == dim).select("embedding").mapInArrow(
        run, "probe int, score float, cell int")
    order = Window.partitionBy("probe").orderBy(F.desc("score"), "cell")
    best = found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k) \
        .select("probe", "cell").collect()
    cells = len(routes.pivots[dim])
    if not best:
        return cells
    place = np.argsort(routes.cells(probes, cells), axis=1)
    ranks = np.sort([place[r.probe, r.cell] for r in best])
    return int(ranks[int(np.ceil(COVERED * len(ranks))) - 1]) + 1


def _routes(points: DataFrame, asked: DataFrame, k: int) -> Routes:
    """Cells, shards and blocks for ``points`` and the queries ``asked`` (both with ``dim``)."""
    routes = Routes()
    large = [r for r in points.groupBy("dim").count().filter(
        F.col("count") > min(SHARD_ROWS, 64)).collect() if r["count"] > _shard_rows(r.dim)]
    large.sort(key=lambda r: (-r["count"], r.dim))
    for row in large[:MOST_DIMS]:
        # distinct vectors, so a share of the hashes is about that share of the rows
        wanted = min(SAMPLE_ROWS, max(64, SAMPLE_BYTES // (8 * row.dim)))
        part = F.pmod(F.xxhash64("embedding"), F.lit(1 << 40))
        found = points.filter((F.col("dim") == row.dim) & (
            part < int((1 << 40) * min(1.0, (wanted + PROBES) / row["count"])))) \
            .select("embedding").toArrow()
        sample = np.unique(_matrix(found.column("embedding"), row.dim), axis=0)
        sample = _unit(np.random.Generator(np.random.PCG64(5)).permutation(sample))
        cells = min(MOST_CELLS, PIVOT_BYTES // (4 * row.dim), len(sample) // 8,
                    -(-row["count"] // _shard_rows(row.dim)))
        if cells < 2:
            continue
        probes, sample = sample[:PROBES], sample[min(PROBES, len(sample) // 2):]
        routes.pivots[row.dim] = _pivots(sample, cells)
        routes.probed[row.dim] = _probed(points, row.dim, probes, routes, k)
    sizes = {(r.dim, 0): r["count"] for r in large if r.dim not in routes.pivots}
    sizes |= _counts(points, routes, 1) if routes.pivots else {}
    start = 0
    for key in sorted(sizes):
        number = -(-sizes[key] // _shard_rows(key[0]))
        routes.shards[key] = (start, number)
        start += number
    routes.total = max(1, start)
    queries = {(r.dim, 0): r["count"] for r in asked.groupBy("dim").count().filter(
        F.col("count") > BLOCK_ROWS).collect() if r.dim not in routes.pivots}
    queries |= _counts(asked, routes, None) if routes.pivots else {}
    routes.blocks = {key: -(-n // BLOCK_ROWS) for key, n in queries.items()}
    return routes


_KEY = ["shard", "dim", "cell", "part"]


def _dealt(points: DataFrame, routes: Routes) -> DataFrame:
    """``points`` with the shard, cell and part of the cell that each lies in."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.zeros((3, batch.num_rows), np.int32)
            for dim, rows, vectors in _by_dim(batch):
                cells = routes.cells(vectors, 1)[:, 0]
                first = np.array([routes.first(dim, c) for c in cells.tolist()])
                part = batch.column("hash").to_numpy()[rows] % first[:, 1]
                own[:, rows] = first[:, 0] + part, cells, part
            yield pa.RecordBatch.from_arrays(
                [batch.column("embedding"), batch.column("ids"), batch.column("dim"),
                 *(pa.array(x) for x in own)],
                names=["embedding", "ids", "dim", "shard", "cell", "part"])
    return points.withColumn("hash", F.xxhash64("embedding")).mapInArrow(
        run, "embedding array<double>, ids array<long>, dim int, shard int, cell int, part int")


def _index(points: DataFrame, routes: Routes) -> DataFrame:
    """One row per shard and dimension: ids, vectors and flat neighbour arrays."""
    def build(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        vectors = _matrix(table.column("embedding"), dim)
        ids = table.column("ids").to_pylist()
        order = np.argsort([i[0] for i in ids], kind="stable")
        vectors, ids = vectors[order], [ids[i] for i in order]
        graph = Graph.build(_unit(vectors))
        cell = table.column("cell")[0].as_py()
        return pa.table({
            **{name: table.column(name).slice(0, 1) for name in _KEY},
            "blocks": pa.array([routes.blocks.get((dim, cell), 1)], pa.int32()),
            "ids": pa.array([ids], pa.list_(pa.list_(pa.int64()))),
            "vectors": pa.array([vectors.tobytes()], pa.binary()),
            "links": pa.array([[x.tobytes() for x in graph.links]], pa.list_(pa.binary()))})
    # one shard a task: shards cost alike, whatever their bytes
    return _dealt(points, routes).repartitionById(routes.total, "shard").groupBy(*_KEY) \
        .applyInArrow(build, "shard int, dim int, cell int, part int, blocks int, "
                      "ids array<array<long>>, vectors binary, links array<binary>")


def _sent(asked: DataFrame, routes: Routes) -> DataFrame:
    """Each query once for every shard of the cells that it searches, with its block there."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("hash").to_numpy()
            for dim, rows, vectors in _by_dim(batch):
                cells = routes.cells(vectors)
                for at in range(cells.shape[1]):
                    own = cells[:, at]
                    first = np.array([routes.first(dim, c) for c in own.tolist()])
                    blocks = np.array([routes.blocks.get((dim, c), 1) for c in own.tolist()])
                    for part in range(int(first[:, 1].max())):
                        some = np.flatnonzero(first[:, 1] > part)
                        of = batch.take(pa.array(rows[some]))
                        key = (first[some, 0] + part, np.full(len(some), dim), own[some],
                               np.full(len(some), part), hashes[rows[some]] % blocks[some])
                        yield pa.RecordBatch.from_arrays(
                            [*(pa.array(x, pa.int32()) for x in key), of.column("vec_id"),
                             of.column("embedding")],
                            names=[*_KEY, "block", "vec_id", "embedding"])
    return asked.withColumn("hash", F.xxhash64("embedding", "vec_id")).mapInArrow(
        run, "shard int, dim int, cell int, part int, block int, vec_id long, "
        "embedding array<double>")


def _read(row: dict) -> tuple[Graph, np.ndarray]:
    vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"])
    links = [np.frombuffer(x, np.int32).reshape(len(vectors), -1) for x in row["links"]]
    return Graph(_unit(vectors), links), vectors


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each query.

    Both frames have ``vec_id`` and ``embedding``. A query's own id is no candidate of it. Ties
    go to the smaller id. Null ids, and vectors that are null, empty, zero or not finite, take no
    part; only vectors of a query's dimension are its candidates. Equal rows count once; an id
    with several vectors is one query, as near as the nearest of them; a query without
    candidates has no row.
    """
    def sound(df: DataFrame) -> DataFrame:
        return df.select(F.col("vec_id").cast("long").alias("vec_id"),
                         F.col("embedding").cast("array<double>").alias("embedding")) \
            .filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))

    points = written(_points(sound(vectors), k), "points")
    asked = sound(queries).distinct().withColumn("dim", F.size("embedding"))
    routes = _routes(points, asked, k)
    index = written(_index(points, routes), "index")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        query, vec, score = [], [], []
        if left.num_rows and right.num_rows:
            row = right.to_pylist()[0]
            graph, stored = _read(row)
            own = left.column("vec_id").to_numpy()
            asked_ = _matrix(left.column("embedding"), row["dim"])
            for start in range(0, len(own), 256):
                found = graph.search(_unit(asked_[start:start + 256]))
                for i, points_ in enumerate(found, start):
                    points_ = points_[points_ >= 0][:4 * k + 8]
                    near = _cosines(asked_[i], stored[points_])
                    ranked = sorted(
                        (-s, v) for s, p in zip(near.tolist(), points_.tolist())
                        for v in row["ids"][p] if v != own[i])[:k]
                    query += [int(own[i])] * len(ranked)
                    vec += [v for _, v in ranked]
                    score += [-s for s, _ in ranked]
        return pa.table({"query_id": pa.array(query, pa.int64()), "vec_id": pa.array(vec, pa.int64()),
                         "score": pa.array(score, pa.float64())})

    # a shard is read once for every block of about BLOCK_ROWS of its queries
    stored = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = [*_KEY, "block"]
    found = _sent(asked, routes).groupBy(*group).cogroup(stored.groupBy(*group)).applyInArrow(
        search, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
