"""Conversation repair against search over all edits, in one piece and over many partitions."""

import hashlib
import heapq
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagetally.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, part int, tie string"
PATTERN = re.compile(r"(s?(ua)+)?")


def brute(rows):
    """The outcome of one conversation by cheapest-first search over edit strings."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(
        f"{len(r[1])}:{r[1]}\n{r[2]}".encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in rows:
        said = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("b" if not said else "d" if (role, text) in seen
                      else "" if said[-1] in ".!?" else "t")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    initials = [role[:1] for _, role, _ in rows]
    wrong = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0

    def legal(roles):
        return re.fullmatch(r"s?(ua)*u?", roles) is not None

    queue = [(0, "", 0, "", ())]
    while True:
        cost, audit, at, roles, out = heapq.heappop(queue)
        if at == len(rows) and PATTERN.fullmatch(roles):
            break
        found = []
        if at < len(rows):
            _, role, text = rows[at]
            found.append((4, "D", at + 1, roles, out))
            if faults[at] not in ("b", "d"):
                extra = 3 if faults[at] == "t" else 0
                found.append((extra, "K", at + 1, roles + (role[:1] or "?"), (*out, (role, text))))
                found += [(3 + extra, "R", at + 1, roles + r[0], (*out, (r, text)))
                          for r in ("user", "assistant")]
        if len(roles) < len(rows) + 4:
            found += [(3, "I", at, roles + r[0], (*out, (r, ""))) for r in ("user", "assistant")]
        for more, letter, place, then, said in found:
            if legal(then):
                heapq.heappush(queue, (cost + more, audit + letter, place, then, said))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), wrong, cost, audit,
            digest)


def expected(rows):
    groups = {}
    for conv, turn, role, text, *_ in rows:
        groups.setdefault(conv, []).append(
            (turn, " " if role is None else role, " " if text is None else text))
    return {conv: brute(own) for conv, own in groups.items()}


def random_rows(seed, conversations, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, longest)):
            rows.append((conv if conv else None, rng.choice([turn, turn, turn // 2, None, 3 * turn]),
                         rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "",
                                     None, "usher"]),
                         rng.choice(["Fine.", "Yes! ", "cut off", "a\nb?", "", " \t\x0b", None,
                                     " ", "x" * rng.randrange(3) + "."]), 1, "x"))
    return rows


def found(summary):
    return {r.conv_id: tuple(r[n] for n in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
        for r in summary.collect()}


def test_random_conversations(spark):
    rows = random_rows(1, 150, 7)
    got = found(repair.Repair(spark.createDataFrame(rows, SCHEMA)).summary())
    assert got == expected(rows)


@pytest.mark.parametrize("partitions,segment", [("3", 2), ("40", 1), ("1", 3)])
def test_pieces_over_partitions(spark, monkeypatch, partitions, segment):
    """Conversations cut into small segments and dealt over partitions give the same."""
    monkeypatch.setattr(repair, "SEGMENT_ROWS", segment)
    rows = random_rows(2, 12, 9)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        own = repair.Repair(spark.createDataFrame(rows, SCHEMA))
        got = found(own.summary())
        said = own.rows().orderBy("conv_id", "part", "seg", "place").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == expected(rows)
    for conv, outcome in got.items():
        own = [r for r in said if r.conv_id == conv]
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in own).encode()) \
            .hexdigest() == outcome[7]
        assert PATTERN.fullmatch("".join(r.role[0] for r in own))


def test_one_conversation_of_many_rows(spark):
    """A long run of equal rows, and one conversation that holds every row of the table."""
    frame = spark.range(6000).select(
        F.lit(5).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.when(F.col("id") < 3000, F.concat(F.col("id").cast("string"), F.lit(".")))
        .when(F.col("id") < 4000, F.lit("Same.")).otherwise(F.concat(
            F.col("id").cast("string"), F.lit("?"))).alias("text"))
    row = repair.Repair(frame).summary().first()
    assert (row.gaps, row.blank, row.duplicate, row.truncated, row.illegal) == (0, 0, 998, 0, 0)
    assert row.cost == 998 * 4
    assert row.audit == "K" * 3002 + "D" * 998 + "K" * 2000


def test_roles_with_line_breaks_are_no_repeats(spark):
    rows = [(1, 0, "user", "a.", 1, "x"), (1, 1, "assistant\nb", "c.", 1, "x"),
            (1, 2, "assistant", "b\nc.", 1, "x")]
    got = found(repair.Repair(spark.createDataFrame(rows, SCHEMA)).summary())
    assert got == expected(rows) and got[1][2] == 0


def test_gone_rows_and_empty_table(spark):
    rows = [(1, 0, "user", "a.", True), (2, 0, "user", "a.", True), (2, 1, "assistant", "b.", False),
            (3, None, "assistant", "b", None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, gone boolean")
    got = found(repair.Repair(frame, "gone").summary())
    empty = hashlib.sha256(b"").hexdigest()
    assert got[1] == (0, 0, 0, 0, 0, 0, "", empty)
    assert got[2][5:7] == (3, "IK") and got[3][:7] == (0, 0, 0, 1, 0, 4, "D")
    assert repair.Repair(frame.limit(0), "gone").summary().collect() == []


def test_powers_equal_steps():
    rng = random.Random(4)
    for _ in range(200):
        symbols = "".join(rng.choice("abcdefghijklmnop") * rng.randrange(1, 20) for _ in range(5))
        tail = [rng.randrange(9) for _ in range(4)]
        costs = tail
        for letter in reversed(symbols.translate(repair._ALIKE)):
            costs = repair.before(repair.power(letter, 0), costs)
        assert repair.before(repair.transition(symbols), tail) == costs
        for start, (edits, end) in enumerate(repair.unrolled(symbols, tail, range(4))):
            paid = sum({"D": 4, "I": 3, "R": 3, "K": 0}[e] for e in "".join(edits)) + sum(
                3 for letter, e in zip(symbols, edits)
                if (ord(letter) - 97) % 4 == repair.TRUNCATED and "D" not in e)
            assert paid + tail[end] == costs[start]
    assert np.array_equal(repair.power("a", 3), repair.transition("a" * 8))
