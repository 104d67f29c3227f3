"""Longest matches against brute force, and long items."""

import random
import time

from pagetally.llm import decontamination


def shard(items, docs, width):
    held = decontamination.Items([(n, t.encode()) for n, t in items], width)
    return held, decontamination.Shard(held, [None if t is None else t.encode() for t in docs])


def brute(items, doc):
    words, best = doc.split(), 0
    for _, text in items:
        own = text.split()
        for i in range(len(own)):
            for j in range(len(words)):
                n = 0
                while i + n < len(own) and j + n < len(words) and own[i + n] == words[j + n]:
                    n += 1
                best = max(best, n)
    return best


def test_longest_matches():
    rng = random.Random(5)
    for _ in range(300):
        items = [(str(i), " ".join(rng.choices("abc", k=rng.randrange(3, 14)))) for i in range(3)]
        docs = [" ".join(rng.choices("abcz", k=rng.randrange(25))) for _ in range(4)]
        held, own = shard(items, docs, 3)
        found, wanted = own.longest(), [brute(items, d) for d in docs]
        assert max((n for n, _, _ in found.values()), default=0) == (
            max(wanted) if max(wanted) >= 3 else 0)
        for doc, (n, at, item) in found.items():
            assert 3 <= n <= wanted[doc]
            assert " ".join(docs[doc].split()[at:at + n]) in dict(items)[held.names[item]]


def test_a_long_item_takes_linear_time():
    rng = random.Random(1)
    seconds = []
    for n in (8000, 32000):
        text = " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))
        _, own = shard([("a", text)], ["x y " + text + " z", None, text[:3000] + " q", text], 10)
        start = time.monotonic()
        found = own.longest()
        seconds.append(time.monotonic() - start)
        assert found[0][:2] == (n, 2) or found[3][:2] == (n, 0)
    assert seconds[1] < 8 * seconds[0] + 1


def test_repeated_words():
    text = "a " * 3000
    _, own = shard([("a", text)], ["b " + text, text + text], 10)
    assert max(n for n, _, _ in own.longest().values()) == 3000
