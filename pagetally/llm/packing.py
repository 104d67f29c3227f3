"""Token sequences packed into as few rows of fixed length as possible.

Pieces above one third of the capacity meet at most in pairs, so a greedy matching (the longest
takes the longest partner that still fits) is the best for them. Smaller pieces then go, longest
first, into the tightest gap that holds them. Both steps only look at lengths: the plan is made
from a histogram of at most ``capacity`` rows, whatever the number of documents, as ranges
(length, first rank, number) -> (first sequence, pieces each, offset). Pieces get a rank among
those of their length from counts by task, and look their place up in the plan.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, written
from .tokens import encoder

PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
          "task int, nth long")


def pieces(docs: DataFrame, capacity: int, end_id: int) -> DataFrame:
    """Token pieces of every document, with their rank among those of a task and length."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, "text"):
            columns = [[] for _ in range(6)]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("text").to_pylist()):
                ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                start = 0
                for number, stop in enumerate(range(first, len(ids) + 1, capacity)):
                    length = stop - start
                    values = (doc_id, number, start, length,
                              crc32(ids[start:stop].tobytes()), int(seen[length]))
                    for column, value in zip(columns, values):
                        column.append(value)
                    seen[length] += 1
                    start = stop
            yield pa.RecordBatch.from_arrays([
                pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()),
                *(pa.array(c, pa.int64()) for c in columns[2:5]),
                pa.array(np.full(len(columns[0]), task, np.int32)),
                pa.array(columns[5], pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .mapInArrow(run, PIECES)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Ranges (length, first rank, number, first sequence, pieces each, offset).

    Rank ``r`` of a range stands in sequence ``first + (r - rank) // each`` at
    ``offset + (r - rank) % each * length``. The work depends on the capacity alone.
    """
    left = {length: n for length, n in histogram.items() if n > 0}
    rank: dict[int, int] = defaultdict(int)
    ranges, gaps, sequences = [], defaultdict(list), 0

    def put(length: int, each: int, first: int, offset: int, number: int) -> None:
        if number:
            ranges.append((length, rank[length], number, first, each, offset))
            rank[length] += number

    for length in sorted((x for x in left if 3 * x > capacity), reverse=True):
        while left[length]:
            partner = next((p for p in range(capacity - length, capacity // 3, -1)
                            if left.get(p, 0) > (p == length)), None)
            bins = left[length] if partner is None else \
                left[length] // 2 if partner == length else min(left[length], left[partner])
            put(length, 1, sequences, 0, bins)
            left[length] -= bins
            gap = capacity - length
            if partner is not None:
                put(partner, 1, sequences, length, bins)
                left[partner] -= bins
                gap -= partner
            gaps[gap].append((sequences, bins))
            sequences += bins
    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        number = left[length]
        for gap in range(length, capacity):
            if not number:
                break
            waiting, gaps[gap] = gaps[gap], []
            each = gap // length
            for first, bins in waiting:
                full = min(bins, number // each)
                put(length, each, first, capacity - gap, full * each)
                number -= full * each
                if full:
                    gaps[gap - each * length].append((first, full))
                if number and full < bins:
                    put(length, each, first + full, capacity - gap, number)
                    gaps[gap - number * length].append((first + full, 1))
                    full, number = full + 1, 0
                if full < bins:
                    gaps[gap].append((first + full, bins - full))
        if number:
            each = capacity // length
            full, rest = divmod(number, each)
            put(length, each, sequences, 0, full * each)
            if full:
                gaps[capacity - each * length].append((sequences, full))
            if rest:
                put(length, each, sequences + full, 0, rest)
                gaps[capacity - rest * length].append((sequences + full, 1))
            sequences += full + (rest > 0)
    return ranges


def placed(ranked: DataFrame, ranges: list[tuple[int, int, int, int, int, int]]) -> DataFrame:
    """``sequence_id`` and ``offset`` of pieces with ``length`` and ``rank``."""
    table = np.array(sorted(ranges), np.int64).reshape(-1, 6)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = table[:, 0] << 48 | table[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, length << 48 | rank, side="right") - 1
            _, first_rank, _, first, each, offset = table[at].T
            past = rank - first_rank
            columns = [batch.column(i) for i in range(5)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(first + past // each),
                 pa.array(offset + past % each * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32",
                       "sequence_id", "offset"])
    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, "
                                  "ids_crc32 long, sequence_id long, offset long")


def pack(docs: DataFrame, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """One row per piece: where it comes from and where it stands.

    A document is its token ids and ``end_id``; only one longer than ``capacity`` is cut, and
    then its first piece may be shorter. Null and empty texts are the end id alone. Repeated rows
    and null ids are packed as documents of their own, other columns are ignored, and an empty
    table gives no rows.
    """
    cut = written(pieces(docs, capacity, end_id), "pieces")
    counts = cut.groupBy("task", "length").agg(F.count("*").alias("number"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1)
    counts = counts.withColumn(
        "base", F.coalesce(F.sum("number").over(earlier), F.lit(0)).cast("long"))
    # at most one row per length: the histogram, not the documents
    totals = {r["length"]: r["n"] for r in
              cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    ranked = cut.join(counts.select("task", "length", "base"), ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("base") + F.col("nth")).alias("rank"))
    return placed(ranked, plan(totals, capacity))
