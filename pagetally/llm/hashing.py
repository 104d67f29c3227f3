"""Vectorised 64-bit hashes of words and word shingles."""

from __future__ import annotations

import numpy as np

#: Bytes [\x20\x09-\x0D] end words.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z; every other byte stays.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)
_ORDER = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CHUNK = 1 << 19


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = values + np.uint64((seed * 0xD1342543DE82EF95 + 0x2545F4914F6CDD1D) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the multiplier and its inverse, grown on demand."""
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def reach(cls, n: int) -> None:
        if len(cls.up) < n:
            size = max(n, _CHUNK)
            for name, factor in (("up", _STEP), ("down", _BACK)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))


def spans(data: np.ndarray, ends_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in an array of bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~ends_word[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hashes`` reads the hash of any span."""
    _Powers.reach(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _Powers.up[:len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes in each span, wherever it stands."""
    return mixed((sums[ends] - sums[starts]) * _Powers.down[starts])


def word_hashes(texts: list[bytes | None], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the position of each text's first word.

    The positions have one entry more than there are texts. Null has no words.
    """
    counts = np.zeros(len(texts) + 1, np.int64)
    parts: list[np.ndarray] = []
    group: list[bytes] = []
    first = size = 0

    def flush(stop: int) -> None:
        nonlocal group, first, size
        if group:
            data = np.frombuffer(b"\n".join(group), np.uint8)
            starts, ends = spans(data, SPACES)
            parts.append(span_hashes(prefix_sums(data), starts, ends))
            lengths = np.fromiter((len(t) + 1 for t in group), np.int64, len(group))
            bounds = np.concatenate(([0], np.cumsum(lengths)))
            counts[first + 1:stop + 1] += np.diff(np.searchsorted(starts, bounds))
        group, first, size = [], stop, 0

    for i, text in enumerate(texts):
        text = (text or b"").translate(LOWER) if lower else (text or b"")
        if len(text) > 2 * _CHUNK:
            flush(i)
            start = 0
            while start < len(text):
                stop = min(len(text), start + _CHUNK)
                while stop < len(text) and not SPACES[text[stop]]:
                    stop += 1
                data = np.frombuffer(text[start:stop], np.uint8)
                at, to = spans(data, SPACES)
                parts.append(span_hashes(prefix_sums(data), at, to))
                counts[i + 1] += len(at)
                start = stop
            first = i + 1
            continue
        if size and size + len(text) > _CHUNK:
            flush(i)
        group.append(text)
        size += len(text) + 1
    flush(len(texts))
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.cumsum(counts)


def runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` values, by the position of its first one."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n] * _ORDER[0]
    for k in range(1, width):
        total = total + hashes[k:k + n] * _ORDER[k]
    return mixed(total, width)


def shingle_sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    """The sorted distinct shingles of ``width`` words of each text.

    A text of fewer words has its whole sequence as the only one, a text without words none.
    """
    words, first = word_hashes(texts)
    every = runs(words, width)
    found = []
    for start, stop in zip(first[:-1].tolist(), first[1:].tolist()):
        if stop - start >= width:
            found.append(np.unique(every[start:stop - width + 1]))
        else:
            found.append(runs(words[start:stop], stop - start) if stop > start
                         else np.zeros(0, np.uint64))
    return found
