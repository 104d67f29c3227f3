"""Cheapest repair of conversations whose rows are blank, repeated, cut off or out of turn.

A repaired conversation has the role initials ``(s?(ua)+)?``. Four states read that pattern: start,
after the system row, after a user row, after an assistant row. Each row is a symbol of role class
and fault; consuming it, with rows inserted before it, is a 4 x 4 matrix of costs, and a sequence of
rows is the min-plus product of its matrices. Equal consecutive symbols are one run, which advances
by binary powers of its matrix that are kept; then the choices are unrolled row by row, the letter
that is least in ASCII first, so that the audit is the least of all cheapest ones.

Rows are range partitioned by conversation and order, so that one conversation may take any share of
them. A conversation that lies inside one partition in one segment is solved there. Of the others,
each partition's stretch becomes one matrix; a scan over a conversation's stretches gives the costs
at each stretch's end, each stretch is unrolled from all four states, and a second scan picks. Only
the digest of a conversation's repaired text is sequential: one task reads its segments in order,
a segment at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, written

#: Rows and text bytes of a segment, the unit in which texts are held and moved.
SEGMENT_ROWS = 256
SEGMENT_BYTES = 1 << 17

DELETE, REROLE, INSERT, CUT_OFF = 4, 3, 3, 3
FINE, BLANK, REPEATED, TRUNCATED = range(4)
SPACE = " \t\n\x0b\x0c\r"
_FAR = 1 << 60
#: The state after an inserted or rerolled row, and that row's role.
_NEXT = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")
#: The state after a kept row by role class (system, user, assistant, other); -1: not legal.
_KEEP = ((1, 2, -1, -1), (-1, 2, -1, -1), (-1, -1, 3, -1), (-1, 2, -1, -1))
#: Cost from each state to an accepted end, and the rows that it takes.
END = (0, 2 * INSERT, INSERT, 0)
_CLOSING = ("", "II", "I", "")
_LEGAL = {(0, 1), (1, 2), (2, 1)}

SUMMARY = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")


def symbol(role: str, fault: int) -> str:
    """One letter for a row's role class and fault."""
    return chr(97 + 4 * ("sua".find(role[0]) if role and role[0] in "sua" else 3) + fault)


def fault_of(text: str) -> int:
    """The fault of a text by itself."""
    said = text.strip(SPACE)
    return BLANK if not said else FINE if said[-1] in ".!?" else TRUNCATED


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None]).min(axis=1), _FAR)


def _moves(letter: str, state: int) -> list[tuple[str, int, int]]:
    """(edits, cost, next state) of ways to consume a row from ``state``, least edits first."""
    kind, fault = divmod(ord(letter) - 97, 4)
    found = []
    for inserts in range(3):
        before, cost = "I" * inserts, INSERT * inserts
        found.append((before + "D", cost + DELETE, state))
        if fault not in (BLANK, REPEATED):
            cost += CUT_OFF if fault == TRUNCATED else 0
            if _KEEP[state][kind] >= 0:
                found.append((before + "K", cost, _KEEP[state][kind]))
            found.append((before + "R", cost + REROLE, _NEXT[state]))
        state = _NEXT[state]
    return sorted(found)


@lru_cache(None)
def power(letter: str, bit: int) -> np.ndarray:
    """Costs of 2 ** ``bit`` rows of one symbol from each state to each state."""
    if bit:
        half = power(letter, bit - 1)
        return _product(half, half)
    costs = np.full((4, 4), _FAR, np.int64)
    for state in range(4):
        for _, cost, after in _moves(letter, state):
            costs[state, after] = min(costs[state, after], cost)
    return costs


def runs(symbols: str) -> list[tuple[str, int]]:
    """Equal consecutive symbols; blank and repeated rows of one role behave alike."""
    alike = symbols.translate(_ALIKE)
    return [(letter, sum(1 for _ in group)) for letter, group in groupby(alike)]


_ALIKE = str.maketrans({symbol(r, REPEATED): symbol(r, BLANK) for r in "suax"})


def transition(symbols: str) -> np.ndarray:
    """The min-plus matrix of a sequence of rows."""
    total = np.where(np.eye(4, dtype=bool), 0, _FAR).astype(np.int64)
    for letter, length in runs(symbols):
        for bit in range(length.bit_length()):
            if length >> bit & 1:
                total = _product(total, power(letter, bit))
    return total


def before(matrix: np.ndarray, after: Iterable[int]) -> list[int]:
    """Costs to go from each state, given those after the rows of ``matrix``."""
    return [int(c) for c in (matrix + np.array(list(after), np.int64)).min(axis=1)]


@lru_cache(1 << 16)
def _back(letter: str, after: tuple[int, ...]) -> tuple[int, ...]:
    costs = before(power(letter, 0), after)
    return tuple(c - min(costs) for c in costs)


@lru_cache(1 << 16)
def _choice(letter: str, state: int, after: tuple[int, ...]) -> tuple[str, int]:
    moves = _moves(letter, state)
    least = min(cost + after[to] for _, cost, to in moves)
    return next((edits, to) for edits, cost, to in moves if cost + after[to] == least)


def unrolled(symbols: str, tail: Iterable[int], starts: Iterable[int]) -> list[tuple[list[str], int]]:
    """Edits of each row and the last state, for each of ``starts``.

    ``tail`` is the cost to go after the rows. Costs are kept less their least, so that few
    different ones occur and each step is looked up.
    """
    tail = list(tail)
    costs = [tuple(c - min(tail) for c in tail)]
    steps = []
    for letter, length in reversed(runs(symbols)):
        for _ in range(length):
            steps.append((letter, costs[-1]))
            costs.append(_back(letter, costs[-1]))
    found = []
    for state in starts:
        edits = []
        for letter, after in reversed(steps):
            chosen, state = _choice(letter, state, after)
            edits.append(chosen)
        found.append((edits, state))
    return found


def illegal(symbols: str) -> int:
    """Neighbours whose role initials are none of ``su``, ``ua`` and ``au``."""
    kinds = [(ord(letter) - 97) // 4 for letter in symbols]
    return sum(pair not in _LEGAL for pair in zip(kinds, kinds[1:]))


@lru_cache(1 << 14)
def solved(symbols: str) -> tuple[int, tuple[str, ...], int]:
    """Cost, edits of each row with the closing ones last, and illegal neighbours."""
    cost = before(transition(symbols), END)[0]
    edits, state = unrolled(symbols, END, (0,))[0]
    return cost, (*edits, _CLOSING[state]), illegal(symbols)


def applied(edits: Iterable[str], roles: list[str], texts: list[str],
            state: int = 0) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the repaired rows, from the edits of each row and closing ones."""
    for place, letters in enumerate(edits):
        for letter in letters:
            if letter == "K":
                yield letter, roles[place], texts[place]
                state = _KEEP[state]["sua".find(roles[place][0])]
            elif letter != "D":
                yield letter, _ROLE[state], texts[place] if letter == "R" else ""
                state = _NEXT[state]


def _digest(rows: Iterable[tuple[str, str, str]]) -> str:
    return hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in rows).encode()).hexdigest()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _arrow(conv: pa.DataType, ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(),
             "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64()),
             "array<int>": pa.list_(pa.int32())}
    return pa.schema([("conv_id", conv)] + [
        (name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


SEGMENT = ("part int, seg long, whole boolean, symbols string, first_turn long, last_turn long, "
           "turns long, roles array<string>, texts array<string>, ties array<string>")


class _Segments:
    """Cuts a sorted partition into segments of at most one conversation each."""

    def __init__(self, part: int) -> None:
        self.part, self.seg = part, 0
        self.rows: list[tuple] = []
        self.size = 0
        self.edge = True

    def add(self, turn: int | None, role: str, text: str, tie: str) -> tuple | None:
        done = None
        if self.rows and (len(self.rows) >= SEGMENT_ROWS or self.size >= SEGMENT_BYTES):
            self.edge = True
            done = self.close(split=True)
        self.rows.append((turn, role, text, tie))
        self.size += len(text) + len(role)
        return done

    def close(self, split: bool = False, last: bool = False) -> tuple:
        seen: set[str] = set()
        symbols, ties = [], []
        for _, role, text, tie in self.rows:
            fault = fault_of(text)
            if fault != BLANK:
                fault = REPEATED if tie in seen else fault
                ties.append(None if tie in seen else tie)
                seen.add(tie)
            else:
                ties.append(None)
            symbols.append(symbol(role, fault))
        turns = [t for t, *_ in self.rows if t is not None]
        row = (self.part, self.seg, not (self.edge or last), "".join(symbols),
               turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)),
               [r for _, r, _, _ in self.rows], [t for _, _, t, _ in self.rows], ties)
        self.rows, self.size, self.seg = [], 0, self.seg + 1
        if not split:
            self.edge = False
        return row


def segments(rows: DataFrame, gone: str | None = None) -> DataFrame:
    """The rows of conversations in order, in segments, as a table in the shared folder."""
    here = F.lit(True) if gone is None else ~F.coalesce(F.col(gone), F.lit(False))
    plain = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.when(here, F.coalesce(F.col("text").cast("string"), F.lit(" "))).otherwise("")
        .alias("text"), here.alias("here"))
    keyed = plain.withColumns({
        # the length keeps role and text apart, whatever they hold
        "tie": F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", F.lit("\n"),
                               "text").cast("binary"), 256),
        # parts rows that are equal in everything; their order makes no difference
        "place": F.monotonically_increasing_id()})
    order = ["conv_id", "turn", "tie", "place"]
    placed = keyed.repartitionByRange(*order).sortWithinPartitions(*order) \
        .withColumn("part", F.spark_partition_id())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, current, schema, ready, size = None, None, None, [], 0

        def emit(row: tuple) -> None:
            nonlocal size
            ready.append((current, *row))
            size += sum(map(len, row[8])) + 100 * len(row[8])

        for batch in slices(batches, "text"):
            if cutter is None:
                cutter = _Segments(batch.column("part")[0].as_py())
                schema = _arrow(batch.schema.field("conv_id").type, SEGMENT)
                current = batch.column("conv_id")[0].as_py()
            for conv, turn, role, text, here, tie in zip(*(
                    batch.column(n).to_pylist()
                    for n in ("conv_id", "turn", "role", "text", "here", "tie"))):
                if conv != current:
                    emit(cutter.close())
                    current = conv
                if here:
                    done = cutter.add(turn, role, text, tie)
                    if done is not None:
                        emit(done)
                if size > 1 << 22:
                    yield _batch(ready, schema)
                    ready, size = [], 0
        if cutter is not None:
            emit(cutter.close(last=True))
            yield _batch(ready, schema)

    kind = dict(rows.dtypes)["conv_id"]
    return written(placed.mapInArrow(run, f"conv_id {kind}, {SEGMENT}"), "segments")


def _grouped(df: DataFrame, function, ddl: str, *keys: str) -> DataFrame:
    """``function`` from a group's sorted dictionaries to rows after ``conv_id``, as a table."""
    def run(table: pa.Table) -> pa.Table:
        schema = _arrow(table.schema.field("conv_id").type, ddl)
        rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["seg"]))
        return pa.Table.from_batches([_batch(
            [(rows[0]["conv_id"], *row) for row in function(rows)], schema)])
    kind = dict(df.dtypes)["conv_id"]
    return df.groupBy(*keys).applyInArrow(run, f"conv_id {kind}, {ddl}")


LEAF = ("part int, seg long, symbols string, lengths array<int>, costs array<long>, "
        "first_turn long, last_turn long, turns long")
SCAN = ("part int, seg long, tail array<long>, last boolean, gaps long, blank long, "
        "duplicate long, truncated long, illegal long, cost long")


def _leaf(rows: list[dict]) -> Iterator[tuple]:
    """One conversation's stretch in one partition: its symbols, matrix and turns."""
    symbols, turns, last = [], 0, None
    for row in rows:
        letters = list(row["symbols"])
        for place in row["later"] or ():
            letters[place] = chr(97 + (ord(letters[place]) - 97) // 4 * 4 + REPEATED)
        symbols.append("".join(letters))
        turns += row["turns"] - (row["turns"] > 0 and last is not None and row["first_turn"] == last)
        last = row["last_turn"] if row["turns"] else last
    joined = "".join(symbols)
    yield (rows[0]["part"], rows[0]["seg"], joined, [len(s) for s in symbols],
           [int(c) for c in transition(joined).ravel()],
           next((r["first_turn"] for r in rows if r["turns"]), None), last, turns)


def _totals(rows: list[dict]) -> Iterator[tuple]:
    """Costs after each stretch of a conversation, and its counts, from the last to the first."""
    tails, tail = [], list(END)
    for row in reversed(rows):
        tails.append(tail)
        tail = before(np.array(row["costs"], np.int64).reshape(4, 4), tail)
    tails.reverse()
    turns, last, first = 0, None, None
    for row in rows:
        if row["turns"]:
            turns += row["turns"] - (last is not None and row["first_turn"] == last)
            first, last = row["first_turn"] if first is None else first, row["last_turn"]
    filled = [r for r in rows if r["ends"]]
    wrong = sum(r["illegal"] for r in rows) + sum(
        illegal(a["ends"][-1] + b["ends"][0]) for a, b in zip(filled, filled[1:]))
    counts = [sum(r[n] for r in rows) for n in ("blank", "duplicate", "truncated")]
    for place, (row, after) in enumerate(zip(rows, tails)):
        yield (row["part"], row["seg"], after, place == len(rows) - 1,
               last - first + 1 - turns if turns else 0, *counts, wrong, tail[0])


def _starts(rows: list[dict]) -> Iterator[tuple]:
    """The state in which each stretch of a conversation starts."""
    state = 0
    for row in rows:
        yield row["part"], row["seg"], state
        state = row["reached"][state]


def _by_row(df: DataFrame, function, ddl: str) -> DataFrame:
    """``function`` from each row as a dictionary to rows after ``conv_id``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = _arrow(batch.schema.field("conv_id").type, ddl)
            # a row's texts are at most a segment's; a few rows at a time bound the memory
            for start in range(0, batch.num_rows, 16):
                yield _batch([(row["conv_id"], *out) for row in batch.slice(start, 16).to_pylist()
                              for out in function(row)], schema)
    kind = dict(df.dtypes)["conv_id"]
    return df.mapInArrow(run, f"conv_id {kind}, {ddl}")


def _count(letters: str) -> Column:
    """Rows of a fault in ``symbols``."""
    return F.length("symbols").cast("long") - F.length(
        F.translate("symbols", letters, "")).cast("long")


def _spread_edits(cut: DataFrame) -> DataFrame:
    """Edits of each segment of the conversations that lie in several segments or partitions.

    ``conv_id, part, seg, edits, start`` and the conversation's counts. What is grouped is one
    stretch of a partition, or a conversation's stretches, at most one a partition; a row that is
    seen earlier is found by its digest, once a segment.
    """
    seen = cut.select("conv_id", "part", "seg", F.posexplode("ties").alias("place", "tie")) \
        .filter("tie is not null").withColumn("at", F.struct("part", "seg"))
    first = seen.groupBy("conv_id", "tie").agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1") \
        .withColumnsRenamed({"conv_id": "_conv", "tie": "_tie"})
    later = seen.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (
        F.col("tie") == F.col("_tie"))).filter("at > first").groupBy("part", "seg").agg(
        F.collect_list("place").alias("later"))
    narrow = cut.select("conv_id", "part", "seg", "symbols", "first_turn", "last_turn", "turns")
    leaves = written(_grouped(narrow.join(later, ["part", "seg"], "left"), _leaf, LEAF,
                              "conv_id", "part"), "leaves")
    blank, repeated, short = ("".join(symbol(r, f) for r in "suax")
                              for f in (BLANK, REPEATED, TRUNCATED))
    sums = leaves.select(
        "conv_id", "part", "seg", "costs", "first_turn", "last_turn", "turns",
        _count(blank).alias("blank"), _count(repeated).alias("duplicate"),
        _count(short).alias("truncated"), _illegal("symbols").alias("illegal"),
        F.when(F.length("symbols") > 0, F.concat(
            F.substring("symbols", 1, 1), F.substring("symbols", -1, 1))).alias("ends"))
    scan = written(_grouped(sums, _totals, SCAN, "conv_id"), "scan")
    ways = written(_by_row(
        leaves.select("conv_id", "part", "seg", "symbols", "lengths").join(
            scan.select("part", "seg", "tail", "last"), ["part", "seg"]),
        _ways, "part int, seg long, symbols string, lengths array<int>, last boolean, "
        "ways array<string>, reached array<int>"), "ways")
    starts = _grouped(ways.select("conv_id", "part", "seg", "reached"), _starts,
                      "part int, seg long, start int", "conv_id").drop("conv_id")
    chosen = ways.join(starts, ["part", "seg"]).select(
        "conv_id", "part", "seg", "symbols", "lengths", "last", "start",
        F.get("ways", F.col("start")).alias("way"))
    edits = _by_row(chosen, _pieces, "part int, seg long, head long, start int, "
                                     "edits array<string>").drop("conv_id")
    return edits.join(scan.select(F.col("part"), F.col("seg").alias("head"), "gaps", "blank",
                                  "duplicate", "truncated", "illegal", "cost"), ["part", "head"])


def _illegal(column: str) -> Column:
    """Illegal neighbours of a symbol string, as an expression."""
    legal = F.lit(0)
    kind = F.translate(column, "abcdefghijklmnop", "ssssuuuuaaaaxxxx")
    for pair in ("su", "ua", "au"):
        # neighbours overlap, so each pair is marked at its first letter
        legal = legal + F.size(F.regexp_extract_all(kind, F.lit(f"{pair[0]}(?={pair[1]})"), 0))
    return (F.greatest(F.length(column) - 1, F.lit(0)) - legal).cast("long")


def _ways(row: dict) -> Iterator[tuple]:
    """A stretch's edits from each of the four states; rows are parted by commas."""
    found = unrolled(row["symbols"], row["tail"], range(4))
    yield (row["part"], row["seg"], row["symbols"], row["lengths"], row["last"],
           [",".join(edits) for edits, _ in found], [state for _, state in found])


def _pieces(row: dict) -> Iterator[tuple]:
    """The chosen edits by segment, with the state in which it starts and the closing edits."""
    edits = row["way"].split(",") if row["way"] else []
    state, at = row["start"], 0
    for place, length in enumerate(row["lengths"]):
        piece, start = edits[at:at + length], state
        for letter, chosen in zip(row["symbols"][at:at + length], piece):
            for edit in chosen:
                if edit == "K":
                    state = _KEEP[state][(ord(letter) - 97) // 4]
                elif edit != "D":
                    state = _NEXT[state]
        at += length
        if row["last"] and at == len(row["symbols"]) and place == len(row["lengths"]) - 1:
            piece.append(_CLOSING[state])
        yield row["part"], row["seg"] + place, row["seg"], start, piece


def _whole(row: dict) -> Iterator[tuple]:
    """The outcome of a conversation that is one segment."""
    cost, edits, wrong = solved(row["symbols"])
    faults = [(ord(letter) - 97) % 4 for letter in row["symbols"]]
    yield (row["last_turn"] - row["first_turn"] + 1 - row["turns"] if row["turns"] else 0,
           faults.count(BLANK), faults.count(REPEATED), faults.count(TRUNCATED), wrong, cost,
           "".join(edits), _digest(applied(edits, row["roles"], row["texts"])))


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PIECE = "part int, seg long, " + ", ".join(f"{n} long" for n in COUNTS) + \
    ", audit string, repaired string"


def _piece(row: dict) -> Iterator[tuple]:
    """A segment's letters and repaired text; null text where no row is left."""
    rows = [f"{r}:{t}" for _, r, t in
            applied(row["edits"], row["roles"], row["texts"], row["start"])]
    yield (row["part"], row["seg"], *(row[n] for n in COUNTS), "".join(row["edits"]),
           "\n".join(rows) if rows else None)


def _joined(pieces: DataFrame) -> DataFrame:
    """One row per conversation from its pieces, read in order one after the other."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, schema, done = None, None, []

        def finish() -> tuple:
            _, counts, letters, digest, _ = current
            return (current[0], *counts, "".join(letters), digest.hexdigest())

        for batch in slices(batches, "repaired"):
            schema = schema or _arrow(batch.schema.field("conv_id").type, SUMMARY)
            for row in batch.to_pylist():
                if current is None or current[0] != row["conv_id"]:
                    if current is not None:
                        done.append(finish())
                    current = [row["conv_id"], [row[n] for n in COUNTS], [], hashlib.sha256(), False]
                current[2].append(row["audit"])
                if row["repaired"] is not None:
                    current[3].update(("\n" if current[4] else "").encode()
                                      + row["repaired"].encode())
                    current[4] = True
            if len(done) >= 1000:
                yield _batch(done, schema)
                done = []
        if current is not None:
            yield _batch([*done, finish()], schema)

    kind = dict(pieces.dtypes)["conv_id"]
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg") \
        .mapInArrow(run, f"conv_id {kind}, {SUMMARY}")


class Repair:
    """The cheapest repair of each conversation of ``rows`` (``conv_id, turn, role, text``).

    Rows are taken by turn, nulls first, and by a digest of role and text within a turn; rows
    that are equal in all of these are interchangeable. Null roles and texts are one space, a
    null ``conv_id`` is a conversation of its own, other columns are ignored. ``gone`` may name a
    boolean column: such rows only tell that their conversation exists. An empty table gives no
    rows.

    A row's first fault counts: blank (nothing but white space), repeated (role and text seen
    earlier), truncated (does not end in ``.``, ``!`` or ``?``). Keeping a row is free, giving it
    the role user or assistant costs 3, deleting it 4, an inserted empty user or assistant row 3;
    blank and repeated rows must go, a truncated row that stays adds 3.
    """

    def __init__(self, rows: DataFrame, gone: str | None = None) -> None:
        self._cut = segments(rows, gone)
        self._edges = self._cut.filter("not whole")

    def _edited(self) -> DataFrame:
        edits = _spread_edits(self._edges)
        return self._edges.select("conv_id", "part", "seg", "roles", "texts").join(
            edits, ["part", "seg"])

    def summary(self) -> DataFrame:
        """Counts, cost, letters of the edits and digest of the repaired text by conversation.

        ``audit`` has the initials of Keep, Rerole, Delete and Insert in order.
        """
        whole = _by_row(self._cut.filter("whole").select(
            "conv_id", "symbols", "first_turn", "last_turn", "turns", "roles", "texts"),
            _whole, SUMMARY)
        return whole.unionByName(_joined(_by_row(self._edited(), _piece, PIECE)))

    def rows(self) -> DataFrame:
        """``conv_id, part, seg, place, edit, role, text`` of the repaired conversations.

        Rows of a conversation stand in the order of ``part, seg, place``.
        """
        def whole(row: dict) -> Iterator[tuple]:
            edits = solved(row["symbols"])[1]
            for place, found in enumerate(applied(edits, row["roles"], row["texts"])):
                yield row["part"], row["seg"], place, *found

        def piece(row: dict) -> Iterator[tuple]:
            for place, found in enumerate(applied(
                    row["edits"], row["roles"], row["texts"], row["start"])):
                yield row["part"], row["seg"], place, *found
        ddl = "part int, seg long, place long, edit string, role string, text string"
        return _by_row(self._cut.filter("whole"), whole, ddl).unionByName(
            _by_row(self._edited(), piece, ddl))
