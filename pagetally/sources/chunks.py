"""Files cut into records by many tasks where a record's end depends on all that came before.

Spark reads a file in byte ranges, the chunks, as pieces between single separator characters. Whether
a separator ends a record depends on an automaton's state at that place: inside quotes or not, and
for JSON how deep. A first pass runs each chunk from both states in which it may start and keeps
what that does: the end state, the change of depth, and how many records end at each depth. These
small rows are composed in file order, which fixes the true start of every chunk and the number of
records before it. A second pass cuts the chunks from their true starts. What crosses a chunk's border comes
out as fragments, which are joined by their record's number; no task reads more than its own chunks
and the fragments of some records.
"""

from __future__ import annotations

import json
import re
import sys
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from pagetally.session import written

# Workers get the code of this module with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Chunks whose starts may be broadcast: about a hundred bytes each.
BROADCAST_CHUNKS = 200_000

#: Characters other than white space that are kept of a file's beginning.
HEAD = 3

#: From a piece and its start state (1: inside quotes) to its end state and change of depth.
Step = Callable[[str, int], tuple[int, int]]


def csv_step(line: str, state: int) -> tuple[int, int]:
    """Lines of CSV with ``"`` as quote, doubled inside quotes.

    A quote opens a field only at its start; elsewhere in a bare field it is a plain character.
    """
    if '"' not in line:
        return state, 0
    inside, outside, closed = 1, 0, 2
    for place, part in enumerate(line.split('"')[:-1]):
        # the state before the quote that follows ``part``
        if state == inside:
            state = closed
        elif state == closed and not part:
            state = inside          # a doubled quote
        else:
            state = inside if part.endswith(",") or not (place or part) else outside
    return int(state == inside), 0


_STRING = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"', re.DOTALL)
_REST = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*"', re.DOTALL)


def json_step(piece: str, state: int) -> tuple[int, int]:
    """Pieces of JSON between commas; depth counts open braces and brackets outside strings."""
    if state:
        end = _REST.match(piece)
        if end is None:
            return 1, 0
        piece = piece[end.end():]
    if '"' in piece:
        piece = _STRING.sub("", piece)
    cut = piece.find('"')
    if cut >= 0:
        piece = piece[:cut]
    depth = piece.count("{") + piece.count("[") - piece.count("}") - piece.count("]")
    return int(cut >= 0), depth


def pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """``value, file, block``: the pieces of the files under ``path`` in order within each chunk."""
    return spark.read.text(path, lineSep=separator).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))


def _stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, dict, list[str]]]:
    """Consecutive pieces of one chunk: its key, its other columns, the pieces."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = pc.run_end_encode(batch.column("block")).run_ends.to_pylist()
        names = pc.run_end_encode(batch.column("file")).run_ends.to_pylist()
        start = 0
        for end in sorted({*ends, *names}):
            head = {n: batch.column(n)[start].as_py() for n in batch.schema.names if n != "value"}
            yield (head["file"], head["block"]), head, \
                batch.column("value").slice(start, end - start).to_pylist()
            start = end


def summaries(cut: DataFrame, step: Step) -> DataFrame:
    """``file, block, effects, head``: what each chunk does from either start state, as JSON.

    ``head`` has its first characters other than white space, at most ``HEAD``.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, effects, head = None, [], ""

        def close() -> pa.RecordBatch:
            text = json.dumps([[state, depth, dict(ends)] for state, depth, ends in effects])
            return pa.RecordBatch.from_pydict(
                {"file": [key[0]], "block": [key[1]], "effects": [text], "head": [head[:HEAD]]})

        for own, _, values in _stretches(batches):
            if own != key:
                if key is not None:
                    yield close()
                key, effects, head = own, [[0, 0, Counter()], [1, 0, Counter()]], ""
            for value in values:
                if len(head) < HEAD:
                    head += "".join(value.split())[:HEAD]
                # once both starts have led to one state, one step serves both
                first = step(value, effects[0][0])
                second = first if effects[0][0] == effects[1][0] else step(value, effects[1][0])
                for effect, (state, change) in zip(effects, (first, second)):
                    effect[0], effect[1] = state, effect[1] + change
                    if not state:
                        effect[2][effect[1]] += 1
        if key is not None:
            yield close()
    return cut.mapInArrow(run, "file string, block long, effects string, head string")


STARTS = ("file string, block long, state int, depth long, fresh boolean, before long, "
          "last boolean, end_state int, end_depth long, before_end long, head string")


def starts(chunks: DataFrame, level: int) -> DataFrame:
    """The true start of each chunk; a record ends where the state is 0 and the depth ``level``.

    ``before`` records ended earlier in the file, ``before_end`` when the chunk ends; ``fresh``
    says that one starts with the chunk; ``head`` has the file's first characters so far.
    The chunks of a file are one group: a row for each 100 MB or so.
    """
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        state = depth = before = 0
        head, out = "", []
        for place, row in enumerate(rows):
            end, change, ends = json.loads(row["effects"])[state]
            out.append({"file": row["file"], "block": row["block"], "state": state, "depth": depth,
                        "fresh": place == 0 or (state == 0 and depth == level), "before": before,
                        "last": place == len(rows) - 1, "end_state": end,
                        "end_depth": depth + change})
            before += ends.get(str(level - depth), 0)
            head = (head + row["head"])[:HEAD]
            out[-1] |= {"before_end": before, "head": head}
            state, depth = end, depth + change
        return pa.Table.from_pylist(out, schema=pa.schema([
            ("file", pa.string()), ("block", pa.int64()), ("state", pa.int32()),
            ("depth", pa.int64()), ("fresh", pa.bool_()), ("before", pa.int64()),
            ("last", pa.bool_()), ("end_state", pa.int32()), ("end_depth", pa.int64()),
            ("before_end", pa.int64()), ("head", pa.string())]))
    return chunks.groupBy("file").applyInArrow(run, STARTS)


def _started(cut: DataFrame, begin: DataFrame) -> DataFrame:
    """Pieces with their chunk's start, still in order."""
    columns = begin.select("file", "block", "state", "depth", "fresh", "before", "last")
    if begin.count() <= BROADCAST_CHUNKS:
        return cut.join(F.broadcast(columns), ["file", "block"])
    # too many to broadcast: a chunk's pieces move together and are put in order again
    return cut.withColumn("nth", F.monotonically_increasing_id()).join(
        columns.hint("merge"), ["file", "block"]) \
        .sortWithinPartitions("file", "block", "nth").drop("nth")


RECORDS = "file string, block long, ord long, last boolean, whole boolean, value string"


def _cut(started: DataFrame, step: Step, level: int, separator: str) -> DataFrame:
    """Records that lie in one chunk, and the fragments of the others."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, head, out, size = None, None, [], 0
        state = depth = nth = 0
        open_, fresh = [], True

        def leave() -> None:
            if open_:
                out.append((*key, nth, head["last"], False, separator.join(open_)))

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (
                pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()))],
                names=["file", "block", "ord", "last", "whole", "value"])

        for own, first, values in _stretches(batches):
            if own != key:
                leave()
                key, head, open_ = own, first, []
                state, depth, nth, fresh = (first[n] for n in ("state", "depth", "before", "fresh"))
            for value in values:
                open_.append(value)
                size += len(value) + 50
                state, change = step(value, state)
                depth += change
                if state == 0 and depth == level:
                    out.append((*key, nth, False, fresh, separator.join(open_)))
                    open_, fresh, nth = [], True, nth + 1
                if size > 1 << 21 and out:
                    yield batch()
                    size = 0
        leave()
        if out:
            yield batch()
    return started.mapInArrow(run, RECORDS)


def records(spark: SparkSession, path: str, separator: str, step: Step, level: int,
            ) -> tuple[DataFrame, DataFrame]:
    """(records, starts): ``file, ord, last, value`` of each record, and where chunks start.

    ``ord`` numbers the records of a file from 0. ``last`` marks what follows the last end of a
    record in a file. Records are read when they are used: one scan for those that lie in one chunk
    and one for the rest, beside the scan that found the starts.
    """
    cut = pieces(spark, path, separator)
    begin = written(starts(summaries(cut, step), level), "starts")
    found = _cut(_started(cut, begin), step, level, separator)
    parts = found.filter("not whole").groupBy("file", "ord").agg(
        F.max("last").alias("last"),
        F.sort_array(F.collect_list(F.struct("block", "value"))).alias("parts"))
    joined = parts.select("file", "ord", "last", F.array_join(
        F.transform("parts", lambda p: p["value"]), separator).alias("value"))
    return found.filter("whole").select("file", "ord", "last", "value").unionByName(joined), begin
