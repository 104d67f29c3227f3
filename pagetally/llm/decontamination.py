"""Benchmark decontamination by suffix arrays over the words of the documents.

Documents are dealt into shards by the scan that reads them. A shard numbers the words that any
benchmark item has (any other word ends every match), sorts the word suffixes that are long
enough to match, and looks every benchmark suffix up by binary search. The neighbours of the
place give the longest verbatim match; the range that shares a whole window gives all its
occurrences. Nothing is shuffled, and a document lies in one shard.

The benchmark goes to the shards in blocks of bounded size; results of several blocks are added
up by document. A window is ``width`` consecutive words of an item; an item of fewer words, but
not none, is one window.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetally.session import durable

from .common import as_bytes, slices

WIDTH = 10
#: Text bytes of the benchmark that one pass over the documents searches for.
BLOCK_BYTES = 4 << 20
#: Text bytes of a shard.
SHARD_BYTES = 2 << 20
#: Words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ once A-Z is lower-cased.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128
              else 32 for b in range(256))
_PIECE = 1 << 20


def words(text: bytes | None) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size."""
    text = (text or b"").translate(WORDS)
    start = 0
    while start < len(text):
        stop = min(len(text), start + _PIECE)
        while stop < len(text) and text[stop] != 32:
            stop += 1
        yield text[start:stop].split()
        start = stop


def sorted_suffixes(ids: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at positions ``at``, sorted by their first ``depth`` words or more.

    Prefix doubling: ranks by 2n words come from pairs of ranks by n words. ``ids`` ends in 0;
    0 ends a suffix.
    """
    rank = ids.astype(np.int64)
    size = 1
    while size < min(depth, len(ids)):
        ahead = np.zeros(len(ids), np.int64)
        ahead[:len(ids) - size] = rank[size:]
        ahead[ids == 0] = 0
        pair = rank * (int(rank.max()) + 1) + ahead
        _, rank = np.unique(pair, return_inverse=True)
        rank = rank.astype(np.int64)
        size *= 2
    order = np.argsort(rank[at], kind="stable")
    return at[order], rank


class Items:
    """Windows and suffixes of a block of benchmark items."""

    def __init__(self, rows: list[tuple[object, bytes | None]], width: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        numbered = []
        for item_id, text in rows:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
                   for part in words(text) for w in part]
            if ids:
                numbered.append((str(item_id), ids))
        self.names = sorted({name for name, _ in numbered})
        number = {name: i for i, name in enumerate(self.names)}
        self.width = width
        # a window is a place among the items' words and a size
        self.words = np.zeros(sum(len(ids) + 1 for _, ids in numbered), np.int32)
        owners: dict[tuple[int, ...], tuple[int, set[int]]] = {}
        starts, sizes, own, position = [], [], [], 0
        for name, ids in numbered:
            size = min(width, len(ids))
            for i in range(len(ids) - size + 1):
                owners.setdefault(tuple(ids[i:i + size]),
                                  (position + i, set()))[1].add(number[name])
            self.words[position:position + len(ids)] = ids
            starts += range(position, position + len(ids))
            sizes += range(len(ids), 0, -1)
            own += [number[name]] * len(ids)
            position += len(ids) + 1
        self.suffix_at, self.suffix_sizes, self.suffix_item = (
            np.array(x, np.int64) for x in (starts, sizes, own))
        self.sizes = np.array([len(key) for key in owners], np.int64)
        self.windows = np.array([at for at, _ in owners.values()], np.int64)
        self.owners = [sorted(items) for _, items in owners.values()]
        self.shortest = int(self.sizes.min()) if len(owners) else 0
        self.depth = int(max(self.suffix_sizes, default=0))


def _compare(ids: np.ndarray, at: np.ndarray, words: np.ndarray, starts: np.ndarray,
             sizes: np.ndarray) -> np.ndarray:
    """Sign of (suffix at ``at``, words from ``starts`` on) by the first ``sizes`` words."""
    sign = np.zeros(len(at), np.int8)
    open_ = np.flatnonzero(sizes > 0)
    k = 0
    while len(open_):
        own = ids[np.minimum(at[open_] + k, len(ids) - 1)]
        found = np.sign(own - words[starts[open_] + k]).astype(np.int8)
        sign[open_] = found
        k += 1
        open_ = open_[(found == 0) & (sizes[open_] > k)]
    return sign


def _bound(ids: np.ndarray, suffixes: np.ndarray, words: np.ndarray, starts: np.ndarray,
           sizes: np.ndarray, after: bool) -> np.ndarray:
    """By binary search, the first sorted suffix not below (after: above) each run of words."""
    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(suffixes), np.int64)
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        sign = _compare(ids, suffixes[middle], words, starts[open_], sizes[open_])
        up = sign <= 0 if after else sign < 0
        low[open_[up]] = middle[up] + 1
        high[open_[~up]] = middle[~up]
        open_ = open_[low[open_] < high[open_]]
    return low


def _shared(a: np.ndarray, i: int, b: np.ndarray, j: int) -> int:
    """Words that two suffixes have in common from their beginning."""
    n, step = 0, 16
    while True:
        x, y = a[i + n:i + n + step], b[j + n:j + n + step]
        size = min(len(x), len(y))
        differ = np.flatnonzero((x[:size] != y[:size]) | (x[:size] == 0))
        if len(differ) or not size:
            return n + (int(differ[0]) if len(differ) else 0)
        n, step = n + size, min(2 * step, 1 << 16)


class Shard:
    """Word numbers of some documents, a 0 after each, and their sorted suffixes."""

    def __init__(self, items: Items, texts: list[bytes | None]) -> None:
        number, parts, self.counts = items.vocabulary.get, [], []
        for text in texts:
            n = 0
            for part in words(text):
                parts.append(np.fromiter((number(w, 0) for w in part), np.int64, len(part)))
                n += len(part)
            parts.append(np.zeros(1, np.int64))
            self.counts.append(n)
        self.items = items
        self.ids = np.concatenate(parts) if parts else np.zeros(1, np.int64)
        self.starts = np.concatenate(([0], np.cumsum(np.array(self.counts, np.int64) + 1)))
        # words until the next word that no item has; only longer runs can hold a window
        zero = np.flatnonzero(self.ids == 0)
        place = np.arange(len(self.ids))
        room = zero[np.minimum(np.searchsorted(zero, place), len(zero) - 1)] - place \
            if len(zero) else place
        self.able = np.flatnonzero(room >= max(1, items.shortest))
        if items.shortest and len(self.able):
            # sort a copy that holds only the runs with able suffixes
            self.suffixes = self._sorted(room)
        else:
            self.suffixes = np.zeros(0, np.int64)

    def _sorted(self, room: np.ndarray) -> np.ndarray:
        first = self.able[np.append(True, np.diff(self.able) > 1)]
        sizes = room[first] + 1
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        self.source = np.repeat(first - offsets[:-1], sizes) + np.arange(offsets[-1])
        self.able_at = np.flatnonzero(np.isin(self.source, self.able, assume_unique=True))
        # windows are found by their own words; longer matches are sorted where there are any
        ordered, _ = sorted_suffixes(self.ids[self.source], self.able_at, int(self.items.sizes.max()))
        return self.source[ordered]

    def hits(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per word whether it is hit; pairs (document, window) that occur."""
        items, marks = self.items, np.zeros(len(self.ids) + 1, np.int64)
        low = _bound(self.ids, self.suffixes, items.words, items.windows, items.sizes, False)
        high = _bound(self.ids, self.suffixes, items.words, items.windows, items.sizes, True)
        number = high - low
        window = np.repeat(np.arange(len(low)), number)
        within = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        at = self.suffixes[low[window] + within]
        np.add.at(marks, at, 1)
        np.add.at(marks, at + items.sizes[window], -1)
        doc = np.searchsorted(self.starts, at, side="right") - 1
        pairs = np.unique(np.stack([doc, window], axis=1), axis=0) if len(at) \
            else np.zeros((0, 2), np.int64)
        return np.cumsum(marks[:-1]) > 0, pairs[:, 0], pairs[:, 1]

    def longest(self) -> dict[int, tuple[int, int, int]]:
        """By document (length, first word, item) of the longest match that a suffix search meets.

        Benchmark suffixes that begin with a whole window's words of this shard are sorted among
        its own suffixes; the longest match of each is with one of its two neighbours. A suffix
        inside a match that was found from an earlier one, at the same distance between the two
        places, ends where that match ends, so no words of it are compared again.
        """
        items, best = self.items, {}
        if not len(self.suffixes):
            return best
        able = np.flatnonzero(items.suffix_sizes >= items.shortest)
        at, sizes = items.suffix_at[able], np.full(len(able), items.shortest)
        met = np.flatnonzero(
            _bound(self.ids, self.suffixes, items.words, at, sizes, False)
            < _bound(self.ids, self.suffixes, items.words, at, sizes, True))
        if not len(met):
            return best
        at, owner = at[met], items.suffix_item[able[met]]
        # the words of the suffixes met, run by run: what follows a run is in no longer match
        first = np.append(True, np.diff(at) > 1)
        begin, end = at[first], at[np.append(first[1:], True)] + items.shortest
        sizes = end - begin + 1
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        run = np.cumsum(first) - 1
        words_at = np.repeat(begin - offsets[:-1], sizes) + np.arange(offsets[-1])
        extra = items.words[np.minimum(words_at, len(items.words) - 1)].astype(self.ids.dtype)
        extra[offsets[1:] - 1] = 0
        joint = np.concatenate((self.ids[self.source], extra))
        places = np.concatenate((
            self.able_at, len(self.source) + offsets[run] + at - begin[run]))
        ordered, _ = sorted_suffixes(joint, places, int(sizes.max()))
        order = np.arange(len(ordered))
        own = ordered < len(self.source)
        left = np.maximum.accumulate(np.where(own, order, -1))
        right = np.minimum.accumulate(np.where(own, order, len(order))[::-1])[::-1]
        position = np.empty(len(joint), np.int64)
        position[ordered] = order
        spot = position[places[len(self.able_at):]]
        for side in (left[spot], right[spot]):
            there = np.flatnonzero((side >= 0) & (side < len(order)))
            starts = self.source[ordered[side[there]]]
            ends: dict[int, int] = {}
            for i, start in zip(there.tolist(), starts.tolist()):
                place = int(at[i])
                if ends.get(start - place, 0) <= place:
                    ends[start - place] = place + _shared(self.ids, start, items.words, place)
                n = ends[start - place] - place
                doc = int(np.searchsorted(self.starts, start, side="right") - 1)
                if n >= items.shortest and n > best.get(doc, (0, 0, 0))[0]:
                    best[doc] = (n, start - int(self.starts[doc]), int(owner[i]))
        return best


def _blocks(benchmark: DataFrame, width: int) -> Iterator[Items]:
    """Items in blocks of ``BLOCK_BYTES``; one block is held at a time, an item is in one."""
    waiting, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    for row in rows.toLocalIterator():
        text = (row[1] or "").encode("utf-8", "replace")
        if waiting and size + len(text) > BLOCK_BYTES:
            yield Items(waiting, width)
            waiting, size = [], 0
        waiting.append((row[0], text))
        size += len(text)
    yield Items(waiting, width)


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of the input as large as a shard."""
    return slices(batches, "text", SHARD_BYTES)


def _searched(docs: DataFrame, items: Items) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _shards(batches):
            shard = Shard(items, as_bytes(batch, "text"))
            hit, doc, window = shard.hits()
            longest = shard.longest()
            found: dict[int, set[int]] = {}
            for d, w in zip(doc.tolist(), window.tolist()):
                found.setdefault(d, set()).update(items.owners[w])
            total = np.concatenate(([0], np.cumsum(hit)))
            runs, matches = [], []
            for i in range(batch.num_rows):
                start = shard.starts[i]
                own = total[start + shard.counts[i]] - total[start]
                edges = []
                if own:
                    part = np.diff(np.concatenate(
                        ([0], hit[start:start + shard.counts[i]].astype(np.int8), [0])))
                    edges = [{"start": int(a), "stop": int(b)} for a, b in
                             zip(np.flatnonzero(part == 1), np.flatnonzero(part == -1))]
                runs.append(edges)
                n, at, item = longest.get(i, (0, 0, None))
                matches.append((n, at, None if item is None else items.names[item]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(shard.counts, pa.int64()),
                 pa.array(runs, pa.list_(pa.struct([("start", pa.int64()),
                                                    ("stop", pa.int64())]))),
                 pa.array([[items.names[k] for k in sorted(found.get(i, ()))]
                           for i in range(batch.num_rows)], pa.list_(pa.string())),
                 *(pa.array([m[k] for m in matches], kind) for k, kind in
                   enumerate((pa.int64(), pa.int64(), pa.string())))],
                names=_NAMES)
    return docs.mapInArrow(run, _SCHEMA)


_NAMES = ["row", "doc_id", "n_words", "runs", "items", "longest", "longest_at", "longest_item"]
_SCHEMA = ("row long, doc_id long, n_words long, runs array<struct<start:long,stop:long>>, "
           "items array<string>, longest long, longest_at long, longest_item string")


def search(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, items, longest, longest_at, longest_item``.

    ``n_hit`` words lie in occurrences of windows; ``items`` are the ids, sorted as strings, of
    the items whose windows occur. ``longest`` is the length of the longest match found there
    (0 without any), at word ``longest_at``, with the item ``longest_item``. Null and empty texts
    have no words, items without words no windows; repeated rows and null ids give rows of their
    own; repeated items count once. Other columns are ignored.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    blocks = [_searched(rows, items) for items in _blocks(benchmark, width)]
    found = blocks[0]
    if len(blocks) > 1:
        # a row has one number in all blocks, whatever tasks compute them
        rows = durable(rows)
        found = reduce(DataFrame.unionByName,
                       [_searched(rows, items) for items in _blocks(benchmark, width)])
        found = found.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("runs")).alias("runs"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.max(F.struct("longest", "longest_at", "longest_item")).alias("best")).select(
            "doc_id", "n_words", "runs", "items", "best.*")
    spans = F.array_sort("runs")
    covered = F.aggregate(
        spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda s, r: F.struct(
            (s.n + F.greatest(r.stop - F.greatest(s.to, r.start), F.lit(0))).alias("n"),
            F.greatest(s.to, r.stop).alias("to")), lambda s: s.n)
    return found.select("doc_id", "n_words", covered.alias("n_hit"), "items", "longest",
                        "longest_at", "longest_item")


def decontaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows in which no window of the benchmark occurs, with all columns."""
    def step(docs: DataFrame, items: Items) -> DataFrame:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _shards(batches):
                shard = Shard(items, as_bytes(batch, "text"))
                mask = np.ones(batch.num_rows, bool)
                mask[shard.hits()[1]] = False
                yield batch.filter(pa.array(mask))
        return docs.mapInArrow(run, docs.schema)
    return reduce(step, _blocks(benchmark, width), docs)
