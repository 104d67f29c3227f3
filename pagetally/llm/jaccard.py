"""Similarity join on sets of word shingles by parity sketches.

A set's sketch is its tokens XOR-ed, each flipping one bit; so two sketches differ in at most as
many bits as the sets differ in tokens. Sets of sizes a <= b that are similar enough differ in at
most (a + b) / 7 tokens for a similarity of 3/4. The sketch is cut into blocks of 2^64 bits, held
as the XOR of the places of their set bits; if more blocks of a set hold tokens than it may differ
in, one of them is equal in the other set (pigeonhole). Sets meet in size bands: a set takes part
in its own band and in the next one if a partner there can be similar enough. Sets that meet in a
block are compared by the number of blocks in which they meet, then by a plain sketch of about as
many bits as they have tokens, whose Hamming distance bounds the difference from below, and then
by the exact shingles of their texts.

Frequent shingles, as of passages that many documents share, would bring unlike sets together.
A list of them, from a bounded sample, is left out of the blocks; taking tokens out cannot raise
the difference. A set that has too few blocks left without them also takes part with all its
tokens. Any list gives whole results; it only steers the work.

Sets that are equal are joined first and take part once. Links become components as they are
found, and sets known to be connected are not compared again; so a large group of near copies
costs one comparison for each of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import hashing
from .common import as_bytes, slices, written

WIDTH = 5
#: Similarity as a fraction: linked if DOWN * intersection >= UP * union.
UP, DOWN = 75, 100
#: Sets of at most so many tokens have a block for each token.
TOKEN_BLOCKS = 64
#: Tokens per block in the largest sets of a band.
LOAD = 2
#: Documents, about, in the sample for frequent shingles; how often one must be in it; most kept.
SAMPLE, OFTEN, FREQUENT = 8_000, 3, 500_000
#: Groups of at most so many sets are paired in full at once.
SMALL = 8
#: Sets of a block when all sets of a large group are compared.
BLOCK = 1024
#: Document ids that may be broadcast.
BROADCAST_ROWS = 2_000_000
#: Rows with the facts of a lead that may be broadcast.
BROADCAST_LEADS = 500_000
#: Documents, about, in the sample for hot blocks; sets that must meet in one; most kept.
HOT_SAMPLE, HOT, HOT_BLOCKS = 2_000, 20, 100_000
#: Pieces into which the rows of a hot block or lead are spread.
SPREAD = 64


def band(size: np.ndarray | int) -> np.ndarray | int:
    """The band of sizes from 2^k to 2^(k+1) - 1 that a size lies in."""
    return np.frexp(np.asarray(size, np.float64))[1] - 1


def bands_of(size: int) -> list[int]:
    """Own band, and the next one if similar sets may be in it."""
    own = int(band(size))
    return [own, own + 1] if size * DOWN // UP >= 2 << own else [own]


def blocks_of(number: int) -> int:
    """Blocks of a sketch in a band; 0: one for each token."""
    return 0 if 2 << number <= TOKEN_BLOCKS else (2 << number) // LOAD


def need(size: int, alone: bool) -> int:
    """Blocks that a set must hold, so that it has more than ``size / 24`` in common with any
    similar one.

    ``alone``: whichever of the pair is larger; else the set is the larger one. The difference is
    at most (a + b) / 7: a third of the smaller size a, and two sevenths of the larger one.
    """
    return size * 3 // 8 + 1 if alone else size * 55 // 168 + 1


def _places(tokens: np.ndarray, blocks: int) -> np.ndarray:
    return ((hashing.mixed(tokens, 3) >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)


def held(tokens: np.ndarray, number: int) -> int:
    """How many blocks of a sketch in band ``number`` hold tokens."""
    blocks = blocks_of(number)
    return len(np.unique(_places(tokens, blocks))) if blocks else len(tokens)


def block_keys(tokens: np.ndarray, number: int, every: bool, route: int) -> np.ndarray:
    """One key for each block that holds tokens: band, block and content hashed.

    ``every``: blocks of one token each. The last bit is ``route``: 1 if no token is left out.
    """
    blocks = 0 if every else blocks_of(number)
    tag = np.uint64(number * 4 + route * 2 + (blocks == 0))
    last = np.uint64((1 << 64) - 2), np.uint64(route)
    if not blocks:
        return hashing.mixed(tokens ^ hashing.mixed(tag[None], 5), 6) & last[0] | last[1]
    at = _places(tokens, blocks)
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else \
        np.zeros(0, np.int64)
    if not len(first):
        return np.zeros(0, np.uint64)
    content = np.bitwise_xor.reduceat(hashing.mixed(tokens, 4)[order], first)
    keys = hashing.mixed(content ^ hashing.mixed(at[first] * np.uint64(256) + tag, 5), 6)
    return keys & last[0] | last[1]


def sketch(tokens: np.ndarray) -> bytes:
    """Parity of the tokens that flip each bit: 64 bits, or from 4 to 8 for each token."""
    bits = max(64, 8 << int(band(max(1, len(tokens)))))
    at = (hashing.mixed(tokens, 7) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits) & 1).tobytes()


def apart(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Hamming distance of pairs of sketches; the longer one is folded, which keeps parities."""
    sizes = np.array([[len(x), len(y)] for x, y in zip(a, b)], np.int64).reshape(-1, 2)
    out = np.zeros(len(a), np.int64)
    for pair in np.unique(sizes, axis=0):
        at = np.flatnonzero((sizes == pair).all(axis=1))
        sides = []
        for side in (a, b):
            x = np.frombuffer(b"".join(side[i] for i in at), np.uint8).reshape(len(at), -1)
            while x.shape[1] > pair.min():
                half = x.shape[1] // 2
                x = x[:, :half] ^ x[:, half:]
            sides.append(x)
        out[at] = np.bitwise_count(sides[0] ^ sides[1]).sum(axis=1, dtype=np.int64)
    return out


def identity(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart, as two signed numbers."""
    with np.errstate(over="ignore"):
        sums = [hashing.mixed(tokens, k).sum(dtype=np.uint64) for k in (8, 9)]
    return tuple(int(x) for x in np.array(sums, np.uint64).view(np.int64))


def without(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent) or not len(tokens):
        return tokens
    at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
    return tokens[frequent[at] != tokens]


def _own(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


_SETS = ("doc_id long, n long, one long, two long, sketch binary, weak int, band int, "
         "rare int, rare_up int, full int")


def sets(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Size, identity and sketch of each row's set, and how many blocks it holds.

    ``rare`` and ``rare_up`` count them without frequent tokens, in the set's own band and in the
    next, null where they would not do; ``full`` with all tokens, in either band at least. ``weak``
    is its own band if even those would not do; it is then given token blocks.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = hashing.shingle_sets(as_bytes(batch, "text"), WIDTH)
            rows = []
            for tokens in found:
                own = int(band(max(1, len(tokens))))
                rare = without(tokens, frequent)
                enough = need(len(tokens), True)
                counts = [held(rare, own + k) for k in (0, 1)]
                full = held(tokens, own)
                rows.append((len(tokens), *identity(tokens), sketch(tokens),
                             own if full < need(len(tokens), False) and len(tokens) else None,
                             own, *(c if c >= enough else None for c in counts),
                             min(full, held(tokens, own + 1))))
            columns = list(zip(*rows)) or [()] * 9
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(),
                     pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, columns, kinds)],
                names=[c.split()[0] for c in _SETS.split(", ")])
    return _own(docs).mapInArrow(run, _SETS)


def _sample(docs: DataFrame, number: int, size: int) -> DataFrame:
    """About ``size`` of ``number`` documents, and at least a millionth of the ids."""
    share = max(1, round(2 ** 20 * min(1.0, size / max(1, number))))
    return _own(docs).filter(F.pmod(F.xxhash64("doc_id"), F.lit(2 ** 20)) < share)


def _frequent(docs: DataFrame, number: int) -> np.ndarray:
    """Shingles that are often in a sample of distinct sets, sorted; steers the work only."""
    some = _sample(docs, number, SAMPLE)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in slices(batches, "text"):
            parts = []
            for tokens in hashing.shingle_sets(as_bytes(batch, "text"), WIDTH):
                if len(tokens) and (name := identity(tokens)) not in seen:
                    seen.add(name)
                    parts.append(tokens)
            tokens = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            tokens, times = np.unique(tokens, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens.view(np.int64)), pa.array(times)], names=["token", "times"])
    counts = some.mapInArrow(run, "token long, times long").groupBy("token").agg(
        F.sum("times").alias("times")).filter(F.col("times") >= OFTEN)
    found = counts.orderBy(F.desc("times"), "token").limit(FREQUENT).select("token").toPandas()
    return np.sort(found["token"].to_numpy(np.int64).view(np.uint64))


def _meetings(docs: DataFrame, frequent: np.ndarray, weak: frozenset[int]) -> DataFrame:
    """``key, id``: the blocks of each set. Equal sets have the same rows, most of them once.

    ``id`` is a part of the identity: unlike sets that share it are only compared in vain.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            keys, ids, times = [], [], []
            for tokens in hashing.shingle_sets(as_bytes(batch, "text"), WIDTH):
                if not len(tokens):
                    continue
                name = identity(tokens)[0]
                if name in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(name)
                rare = without(tokens, frequent)
                for number in bands_of(len(tokens)):
                    every = number in weak
                    own = block_keys(rare, number, every, 0)
                    parts = [own]
                    if held(rare, number) < need(len(tokens), True):
                        parts.append(block_keys(tokens, number, every, 1))
                    for part in parts:
                        keys.append(part)
                        times.append(len(part))
                        ids.append(name >> 16)
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)),
                     pa.array(np.repeat(np.array(ids, np.int64), times))], names=["key", "id"])
    return _own(docs).mapInArrow(run, "key long, id long")


def _hot_blocks(docs: DataFrame, number: int, frequent: np.ndarray,
                weak: frozenset[int]) -> DataFrame:
    """``key, first``: blocks in which many sets of a sample meet, and one of these sets.

    Steers the work only: the rows of other blocks are grouped by key alone.
    """
    some = _meetings(_sample(docs, number, HOT_SAMPLE), frequent, weak)
    return written(some.groupBy("key").agg(
        F.countDistinct("id").alias("sets"), F.min("id").alias("first"))
        .filter(F.col("sets") >= HOT).orderBy(F.desc("sets"), "key").limit(HOT_BLOCKS)
        .select("key", "first"), "hot-blocks")


def _groups(meetings: DataFrame, hot: DataFrame) -> DataFrame:
    """``key, id, lead, size, earlier``: rows of blocks in which several sets meet.

    ``earlier`` has the other sets before this one where the group is small. A block of ``hot`` is
    a large group whose lead is known, so that its rows need not meet: they are spread.
    """
    known = F.col("first").isNotNull()
    spread = meetings.join(F.broadcast(hot), "key", "left").withColumn(
        "piece", F.when(known, F.pmod("id", F.lit(SPREAD))).otherwise(0))
    whole = Window.partitionBy("key", "piece")
    order = whole.orderBy("id")
    rows = spread.withColumn("before", F.lag("id").over(order)) \
        .withColumn("after", F.lead("id").over(order)) \
        .filter(known | F.col("before").isNotNull() | F.col("after").isNotNull()) \
        .filter(F.col("before").isNull() | (F.col("before") != F.col("id"))) \
        .drop("before", "after")
    return rows.withColumn("size", F.when(known, SMALL + 1).otherwise(F.count("*").over(whole))) \
        .filter(F.col("size") > 1) \
        .withColumn("lead", F.coalesce("first", F.min("id").over(whole))) \
        .withColumn("earlier", F.when(F.col("size") <= SMALL, F.collect_list("id").over(
            order.rowsBetween(1 - SMALL, -1))).otherwise(
            F.when(F.col("id") != F.col("lead"), F.array("lead")).otherwise(F.array())))


def _possible(met: Column) -> Column:
    """Whether sets _a and _b can be similar by their sizes and by the blocks they meet in.

    ``met`` blocks are known; blocks of large groups, in which not all pairs are formed, may
    come to them. The blocks of either set that are not equal in the other are at most (a + b) / 7.
    """
    larger = F.col("n_a") > F.col("n_b")

    def pick(name: str, big: bool) -> Column:
        first, second = (f"{name}_a", f"{name}_b") if big else (f"{name}_b", f"{name}_a")
        return F.when(larger, F.col(first)).otherwise(F.col(second))

    small_rare = F.when(F.col("band_a") == F.col("band_b"), pick("rare", False)) \
        .otherwise(pick("rare_up", False))
    blocks = F.coalesce(F.greatest(pick("rare", True), small_rare), pick("full", True))
    unseen = F.least(F.col("large_a") + F.col("large_full_a"),
                     F.col("large_b") + F.col("large_full_b"))
    most = F.floor((F.col("n_a") + F.col("n_b")) * (DOWN - UP) / (DOWN + UP))
    return (F.least("n_a", "n_b") * DOWN >= F.greatest("n_a", "n_b") * UP) \
        & (met + unseen >= blocks - most)


_MEASURES = ("n", "band", "rare", "rare_up", "full", "large", "large_full")


def _side(reps: DataFrame, side: str, *columns: str) -> DataFrame:
    return reps.select(*(F.col(c).alias(f"{c}_{side}") for c in columns))


def _possible_pairs(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Documents (a, b) for pairs of set ids that meet in ``met`` blocks and can be similar."""
    columns = ("id", "rep", *_MEASURES)
    return pairs.join(_side(reps, "a", *columns), "id_a") \
        .join(_side(reps, "b", *columns), "id_b").filter(_possible(F.col("met"))) \
        .select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")) \
        .filter("a < b").distinct()


def _near_enough(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs of documents whose sketches allow a link."""
    found = pairs.join(_side(reps, "a", "rep", "n", "sketch").withColumnRenamed("rep_a", "a"), "a") \
        .join(_side(reps, "b", "rep", "n", "sketch").withColumnRenamed("rep_b", "b"), "b")
    most = F.floor((F.col("n_a") + F.col("n_b")) * (DOWN - UP) / (DOWN + UP)).cast("long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "sketch_a"):
            far = apart(batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist())
            mask = far <= batch.column("most").to_numpy(zero_copy_only=False)
            yield batch.select(["a", "b"]).filter(pa.array(mask))
    # an id that stands for several sets may be near by any of them
    return found.select("a", "b", "sketch_a", "sketch_b", most.alias("most")).mapInArrow(
        run, "a long, b long").distinct()


def linked(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of ids whose texts are similar, by their exact sets of shingles.

    Only the texts of the pairs' documents move; each pair carries one of them.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    ids = written(ids, "ids")
    if ids.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    texts = written(_own(docs).join(ids, "doc_id", "left_semi"), "texts")
    # hash sorted by a: the left text of a run of pairs is read once
    both = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b") \
        .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a") \
        .select("a", "b", "text_a", "text_b")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tokens = None, np.zeros(0, np.uint64)
        for batch in slices(batches, "text_b"):
            right = hashing.shingle_sets(as_bytes(batch, "text_b"), WIDTH)
            mask = np.zeros(batch.num_rows, bool)
            for i, (text, other) in enumerate(zip(as_bytes(batch, "text_a"), right)):
                if text != last:
                    last, (tokens,) = text, hashing.shingle_sets([text], WIDTH)
                common = len(tokens) + len(other) - len(np.union1d(tokens, other))
                mask[i] = DOWN * common >= UP * (len(tokens) + len(other) - common) and common > 0
            yield batch.select(["a", "b"]).filter(pa.array(mask))
    return both.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of links (a, b): the smallest node reachable.

    Each round takes the least label among a node and its neighbours, and then the label of that
    label. Rounds grow with the logarithm of the longest path; each is written and read again.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.first("a"), F.min("b")).alias("component")), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(
            F.col("a").alias("node")).agg(F.min("component").alias("near"))
        joined = labels.join(seen, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("step"))
        jump = labels.select(F.col("node").alias("step"), F.col("component").alias("far"))
        moved = written(joined.join(jump, "step", "left").select(
            "node", "old", F.least("step", F.coalesce("far", "step")).alias("component")), "labels")
        changed = not moved.filter("old != component").isEmpty()
        labels = moved.select("node", "component")
        if not changed:
            return labels


class _Found:
    """Links found so far and the components they make."""

    def __init__(self, docs: DataFrame) -> None:
        self.docs, self.links, self.labels = docs, None, None

    def label(self, df: DataFrame, column: str, name: str) -> DataFrame:
        if self.labels is None:
            return df.withColumn(name, F.col(column))
        labels = self.labels.select(F.col("node").alias(column), F.col("component").alias(name))
        return df.join(labels, column, "left").withColumn(
            name, F.coalesce(F.col(name), F.col(column)))

    def apart(self, pairs: DataFrame) -> DataFrame:
        """The pairs that no known links connect."""
        if self.labels is None:
            return pairs
        marked = self.label(self.label(pairs, "a", "in_a"), "b", "in_b")
        return marked.filter("in_a != in_b").select("a", "b")

    def test(self, pairs: DataFrame) -> None:
        pairs = written(pairs, "tested")
        if pairs.isEmpty():
            return
        new = written(linked(pairs, self.docs), "new-links")
        if new.isEmpty():
            return
        self.links = new if self.links is None else written(self.links.union(new), "all-links")
        self.labels = components(self.links)


def _large_rows(groups: DataFrame, reps: DataFrame) -> DataFrame:
    """``lead, route``, measures, ``count`` and ``bound`` of sets that large groups may connect.

    In a large group, sets have met its first one, the lead, only. A similar pair that met nowhere
    else has ``bound`` blocks in common in large groups at least, by the blocks of either of its
    sets; sets with fewer blocks in such groups are done. A set has ``count`` blocks with a lead:
    sets that share a block share its lead.
    """
    enough, third = F.floor(F.col("n") / 24) + 1, F.floor(F.col("n") / 3)
    by_rare = F.when(F.col("rare").isNull() | F.col("rare_up").isNull(), enough).otherwise(
        F.greatest(enough, F.least("rare", "rare_up") - third))
    rows = groups.filter("lead is not null").groupBy("lead", "route", "id").agg(
        F.count("*").alias("count")).join(reps.select("id", "rep", *_MEASURES), "id")
    rare = F.col("route") == 0
    return rows.withColumn("bound", F.when(rare, by_rare).otherwise(
        F.greatest(enough, F.col("full") - third))) \
        .filter(F.when(rare, F.col("large")).otherwise(F.col("large_full")) >= F.col("bound"))


def _by_lead(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """``rows`` joined with the one row of ``facts`` of their lead; a lead's rows stay apart."""
    facts, on = written(facts, "leads"), ["lead", "route"]
    if facts.count() <= BROADCAST_LEADS:
        return rows.join(F.broadcast(facts), on)
    copies = facts.withColumn("piece", F.explode(F.sequence(
        F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))))
    return rows.withColumn("piece", F.pmod(F.xxhash64("rep"), F.lit(SPREAD).cast("long"))) \
        .join(copies, [*on, "piece"]).drop("piece")


def _open_rows(rows: DataFrame, found: _Found) -> DataFrame:
    """Rows of leads whose sets are in several components, with the component as ``part``."""
    rows = found.label(rows, "rep", "part")
    open_ = rows.groupBy("lead", "route").agg(F.min("part").alias("x"), F.max("part").alias("y")) \
        .filter("x != y").select("lead", "route")
    return written(_by_lead(rows, open_), "open-groups")


def _central_pairs(rest: DataFrame) -> DataFrame:
    """Each set with the one of its lead's sets that has the most blocks in large groups."""
    central = rest.groupBy("lead", "route").agg(F.max(F.struct(
        (F.col("large") + F.col("large_full")).alias("size"), "rep", "part")).alias("central"))
    return _by_lead(rest, central).filter("part != central.part").select(
        F.least("rep", "central.rep").alias("a"), F.greatest("rep", "central.rep").alias("b")) \
        .distinct()


def _open_pairs(rest: DataFrame, reps: DataFrame) -> DataFrame:
    """Documents (a, b) of different components under one lead whose sketches allow a link.

    A lead's sets are cut into blocks of about ``BLOCK`` sets; a task compares the sketches of two
    blocks and returns only the pairs that are near enough.
    """
    group = ["lead", "route"]
    sizes = rest.groupBy(*group).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    rows = _by_lead(rest, sizes).withColumn(
        "own", F.pmod(F.xxhash64("rep"), F.col("blocks"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select(*group, F.least("own", "other").alias("low"),
                       F.greatest("own", "other").alias("high"), "own", "rep", "part", "n") \
        .join(reps.select("rep", "n", "sketch"), ["rep", "n"])

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        rep, part, n, own = (table.column(c).to_numpy() for c in ("rep", "part", "n", "own"))
        sketches = table.column("sketch").to_pylist()
        whole = own == table.column("low").to_numpy()
        alone = table.column("low")[0].as_py() == table.column("high")[0].as_py()
        left = np.flatnonzero(whole)
        right = left if alone else np.flatnonzero(~whole)
        words: dict[int, np.ndarray] = {}
        for size in {len(sketches[i]) for i in right}:
            at = right[[len(sketches[i]) == size for i in right]]
            words[size] = at, np.frombuffer(b"".join(sketches[i] for i in at), np.uint64) \
                .reshape(len(at), -1)
        found_a, found_b = [], []
        for i in left.tolist():
            for size, (at, others) in words.items():
                mine = np.frombuffer(sketches[i], np.uint64)
                while len(mine) * 8 > size:
                    mine = mine[:len(mine) // 2] ^ mine[len(mine) // 2:]
                while others.shape[1] > len(mine):
                    half = others.shape[1] // 2
                    others = others[:, :half] ^ others[:, half:]
                near = (part[at] != part[i]) & (np.minimum(n[at], n[i]) * DOWN
                                                >= np.maximum(n[at], n[i]) * UP)
                if near.any():
                    far = np.bitwise_count(others[near] ^ mine).sum(axis=1, dtype=np.int64)
                    ok = far <= (n[at[near]] + n[i]) * (DOWN - UP) // (DOWN + UP)
                    for j in at[near][ok].tolist():
                        found_a.append(min(rep[i], rep[j]))
                        found_b.append(max(rep[i], rep[j]))
        return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    return rows.groupBy(*group, "low", "high").applyInArrow(compare, "a long, b long") \
        .filter("a < b").distinct()


def join(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row.

    Documents link if their sets of shingles are similar enough; ``component_id`` is the smallest
    id that links reach. Null and empty texts, and texts of white space, have an empty set and
    link with nothing. Rows with equal ids are one document with several texts, each with its own
    size; a row with a null id links with nothing, and its component is null. Other columns are
    ignored; an empty table gives no rows.
    """
    whole = _own(docs)
    docs = whole.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    number = docs.count()
    frequent = _frequent(docs, number)
    all_sets = written(sets(whole, frequent), "sets")
    some = all_sets.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    # at most one number for each power of two
    weak = frozenset(r["weak"] for r in
                     some.select("weak").filter("weak is not null").distinct().collect())
    hot = _hot_blocks(docs, number, frequent, weak)
    groups = written(_groups(_meetings(docs, frequent, weak), hot).select(
        F.when(F.col("size") > SMALL, F.col("lead")).alias("lead"),
        F.col("key").bitwiseAND(1).alias("route"), "id", "earlier"), "groups")
    large = groups.filter("lead is not null").groupBy("id").agg(
        F.count(F.when(F.col("route") == 0, 1)).alias("large"),
        F.count(F.when(F.col("route") == 1, 1)).alias("large_full"))
    same = ("n", "sketch", "band", "rare", "rare_up", "full")
    reps = some.groupBy("one", "two").agg(F.min("doc_id").alias("rep"),
                                          *(F.first(c).alias(c) for c in same))
    reps = written(reps.withColumn("id", F.shiftright("one", 16)).join(large, "id", "left")
                   .fillna(0, ["large", "large_full"]), "reps")
    pairs = groups.select(F.explode("earlier").alias("id_a"), F.col("id").alias("id_b")) \
        .groupBy("id_a", "id_b").agg(F.count("*").alias("met"))
    near = written(_near_enough(_possible_pairs(pairs, reps), reps), "near")

    found = _Found(docs)
    # one pair for each set first: that connects most of what is similar
    found.test(near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    found.test(found.apart(near))
    rows = written(_large_rows(groups, reps), "large-rows")
    for last in (False, False, True):
        rest = _open_rows(rows, found)
        if rest.isEmpty():
            break
        found.test(found.apart(_open_pairs(rest, reps) if last else
                               _near_enough(_central_pairs(rest), reps)))

    classes = found.label(reps.select("one", "two", "rep"), "rep", "component_id") \
        .select("one", "two", "component_id")
    # rows with equal ids connect the classes of their texts
    shared = some.select("doc_id", "one", "two").distinct().groupBy("doc_id").agg(
        F.count("*").alias("number")).filter("number > 1").select("doc_id")
    if not shared.isEmpty():
        across = some.join(shared, "doc_id").join(classes, ["one", "two"]).select(
            F.least("doc_id", "component_id").alias("a"),
            F.greatest("doc_id", "component_id").alias("b")).filter("a < b")
        joined = components(across)
        classes = classes.join(joined.withColumnsRenamed(
            {"node": "component_id", "component": "least"}), "component_id", "left").select(
            "one", "two", F.coalesce("least", "component_id").alias("component_id"))
    return all_sets.select("doc_id", "n", "one", "two").join(
        classes.withColumn("full", F.lit(True)), ["one", "two"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, with all columns.

    Where ids repeat or are null, the rows that are left are compared once more, each as a document
    of its own, so that no two of them are alike; rows with an id go before rows without.
    """
    repeated = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.count("*").alias("rows")).filter("rows > 1 OR doc_id IS NULL")
    unlike = not repeated.isEmpty()
    found = join(docs) if found is None else found
    left = _without_losers(docs, docs["doc_id"].cast("long"), found)
    if not unlike:
        return left
    # written, so that a row has one number in the join and after it
    number = F.monotonically_increasing_id() + F.when(
        F.col("doc_id").isNull(), F.lit(1 << 62)).otherwise(F.lit(0))
    rows = written(left.withColumn("row number", number), "unlike")
    found = join(rows.select(F.col("row number").alias("doc_id"), "text"))
    return _without_losers(rows, rows["row number"], found).drop("row number")


def _without_losers(docs: DataFrame, number: Column, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``number`` is not above its component in ``found``."""
    losers = written(found.filter(F.col("doc_id") != F.col("component_id"))
                     .select(F.col("doc_id").alias("lost id")).distinct(), "losers")
    if losers.count() <= BROADCAST_ROWS:
        losers = F.broadcast(losers)
    return docs.join(losers, number == losers["lost id"], "left_anti")
