"""Calls in flight: order, time, deadlines, retries, rates, and questions asked once."""

import asyncio
import json
import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from pagetally.operators import scoring
from pagetally.operators.calls import CallPolicy, Calls, DeadlineMissed, Retry, Throttled

QUICK = (Retry((Throttled,), 4, 0.01, 0.05), Retry((ConnectionError,), 3, 0.01, 0.05))


def ask_all(ask, texts, **policy):
    return list(Calls(ask, CallPolicy(**policy), ahead=50).answers(iter(texts)))


def test_answers_keep_their_order_and_overlap():
    rng, lock, most = random.Random(1), threading.Lock(), [0, 0]

    def ask(text):
        with lock:
            most[0] += 1
            most[1] = max(most)
        time.sleep(rng.random() / 50)
        with lock:
            most[0] -= 1
        return text.upper()
    texts = [f"t{i}" for i in range(300)]
    assert ask_all(ask, texts, in_flight=20) == [(t.upper(), None) for t in texts]
    assert 15 <= most[1] <= 20
    assert ask_all(ask, []) == []


def test_coroutines():
    async def ask(text):
        await asyncio.sleep(60 if text == "slow" else 0.01)
        return text
    found = ask_all(ask, ["a", "slow", "b"], in_flight=2, deadline=0.2)
    assert found == [("a", None), (None, "no answer in 0.2 s"), ("b", None)]


def test_calls_that_hang_fail_their_rows():
    stop = threading.Event()

    def ask(text):
        if text.startswith("hang"):
            stop.wait(30)
        return text
    texts = ["a", "hang1", "b", "hang2", "c"] + [f"x{i}" for i in range(50)]
    start = time.monotonic()
    found = ask_all(ask, texts, in_flight=2, deadline=0.3)
    assert time.monotonic() - start < 5
    assert [a[0] for a in found] == [t if "hang" not in t else None for t in texts]
    assert found[1][1] == "no answer in 0.3 s"
    found = ask_all(ask, ["hang"] * 6 + ["a"], in_flight=2, deadline=0.1, stuck=3)
    assert [reply for reply, _ in found] == [None] * 6 + [found[-1][0]]
    assert sum("not asked" in (error or "") for _, error in found) >= 2
    stop.set()


def test_retries_by_kind():
    tries = {}

    def ask(text):
        tries[text] = tries.get(text, 0) + 1
        kind, times = text.split()
        if tries[text] <= int(times):
            raise {"net": ConnectionError("lost"), "busy": Throttled("busy", 0.001),
                   "bad": ValueError("bad")}[kind]
        return "ok"
    found = ask_all(ask, ["net 2", "net 3", "busy 3", "busy 4", "bad 1", "net 0"], retries=QUICK)
    assert found == [("ok", None), (None, "lost"), ("ok", None), (None, "busy"), (None, "bad"),
                     ("ok", None)]
    assert tries == {"net 2": 3, "net 3": 3, "busy 3": 4, "busy 4": 4, "bad 1": 1, "net 0": 1}
    late = CallPolicy(retries=(Retry((DeadlineMissed,), 2, 0.5),))
    assert late.retry(DeadlineMissed(), 1) == 0.5 and late.retry(DeadlineMissed(), 2) is None
    assert [Retry((OSError,)).wait(OSError(), n) for n in (1, 2, 3, 4)] == [2, 4, 8, 10]


def test_rate_and_stop():
    start = time.monotonic()
    found = list(Calls(str.upper, CallPolicy(), pause=0.02).answers(["a"] * 26))
    assert len(found) == 26 and time.monotonic() - start >= 0.5
    assert CallPolicy(calls_per_second=40).pause(8) == 0.2

    def ask(text):
        raise KeyboardInterrupt
    with pytest.raises(KeyboardInterrupt):
        ask_all(ask, ["a"])


def test_a_slow_scorer_takes_a_tenth_of_the_time(spark):
    def slow(text):
        time.sleep(0.05)
        return json.dumps({"exposure": len(text) % 11})
    docs = spark.range(1000).select(F.col("id").alias("slug"), F.concat(
        F.lit("text "), F.col("id")).alias("text")).coalesce(1)
    scoring.score_table(docs.limit(1), slow, policy=CallPolicy()).collect()
    start = time.monotonic()
    rows = scoring.score_table(docs, slow, policy=CallPolicy(in_flight=32)).collect()
    assert time.monotonic() - start < 5
    assert [r.slug for r in rows] == list(range(1000))
    assert rows == scoring.score_table(docs, lambda t: json.dumps({"exposure": len(t) % 11})).collect()


def test_equal_texts_are_asked_once(spark, tmp_path):
    def counting(text):
        import uuid
        (tmp_path / uuid.uuid4().hex).write_text(text)
        if text == "boom":
            raise ValueError("no")
        return text.upper()
    rows = [(i, ["hot", "", None, "boom", f"t{i % 5}"][min(i % 7, 4)], i % 3) for i in range(300)]
    docs = spark.createDataFrame(rows, "slug int, text string, reply_to int").repartition(7)
    found = scoring.score_documents(docs, counting, CallPolicy(in_flight=4))
    assert found.columns == ["slug", "reply_to", "reply", "error"]
    got = {r.slug: (r.reply_to, r.reply, r.error) for r in found.collect()}
    assert got == {i: (n, None if t == "boom" else t.upper(), "no" if t == "boom" else None)
                   for i, t, n in rows if t}
    found.count()
    assert sorted(p.read_text() for p in tmp_path.iterdir()) == sorted({t for _, t, _ in rows if t})
    assert scoring.score_documents(docs.limit(0), counting).collect() == []


def test_incremental_run_with_calls_in_flight(spark):
    master = spark.createDataFrame([(i, f"s{i}", f"T{i}") for i in range(9)],
                                   "ord bigint, slug string, title string")
    docs = master.select("slug", F.concat(F.lit("text "), F.col("ord") % 3).alias("text"))
    old = spark.createDataFrame([("s0", "T0", 9.0, "kept", None)],
                                "slug string, title string, exposure double, rationale string, extras string")
    plain = scoring.score_incremental(master, docs, old, scoring.length_scorer)
    quick = scoring.score_incremental(master, docs, old, scoring.length_scorer, policy=CallPolicy())
    for name in ("scores", "statuses"):
        assert sorted(getattr(plain, name).collect(), key=str) == sorted(
            getattr(quick, name).collect(), key=str)
