"""The log of token counts: torn attempts, two writers, and brute force."""

import random
import re
from collections import Counter

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from pagetally.llm import queries, rollups, tokens

DOCS = "doc_id long, text string, lang string, source string, extra int"


def documents(spark, n, seed=3):
    rng = random.Random(seed)
    rows = [(i, rng.choice([None, "", " \t", "one", "Two words\n", "x " * rng.randrange(50)]),
             rng.choice(["en", "fr", None]), rng.choice(["hot", "hot", "b", None]), 1)
            for i in range(n)]
    return rows, spark.createDataFrame(rows, DOCS)


def parts(path):
    return {f.relative_to(path) for f in path.glob("*/part-*")}


def test_torn_attempt_is_committed_again(spark, tmp_path):
    """Half of an attempt's files counts for nothing, whichever half it is."""
    rows, docs = documents(spark, 40)
    counts = rollups.counted(docs, "words/1")
    for keep_mark in (True, False):
        path = tmp_path / f"log-{keep_mark}"
        rollup = rollups.Rollup(spark, str(path))
        rollup.commit("a", rollups.changes(inserted=counts.filter("doc_id < 10")))
        before = rollup.totals().collect()
        old = parts(path)
        rollup.commit("b", rollups.changes(inserted=counts.filter("doc_id >= 10")))
        whole = sorted(map(tuple, rollup.totals().collect()), key=str)
        new = sorted(parts(path) - old)
        has_mark = {f: any(n is not None for n in pq.ParquetFile(path / f).read()["rows"].to_pylist())
                    for f in new}
        assert len(new) > 1 and sum(has_mark.values()) == 1
        for name in new:
            if has_mark[name] != keep_mark:
                (path / name).rename((path / name).parent / f"_lost-{name.name}")
                (path / name).with_name(f".{name.name}.crc").unlink(missing_ok=True)
        assert not rollup.committed("b") and rollup.committed("a")
        assert sorted(map(tuple, rollup.totals().collect()), key=str) == sorted(
            map(tuple, before), key=str)
        assert rollup.commit("b", rollups.changes(inserted=counts.filter("doc_id >= 10")))
        assert sorted(map(tuple, rollup.totals().collect()), key=str) == whole
        assert not rollup.commit("b", rollups.changes(inserted=counts))


def test_two_writers_count_once(spark, tmp_path, monkeypatch):
    _, docs = documents(spark, 20)
    counts = rollups.counted(docs, "words/1")
    rollup = rollups.Rollup(spark, str(tmp_path / "log"))
    rollup.commit("a", rollups.changes(inserted=counts))
    totals = sorted(map(tuple, rollup.totals().collect()), key=str)
    monkeypatch.setattr(rollups.Rollup, "committed", lambda self, batch: False)
    assert rollup.commit("a", rollups.changes(inserted=counts.limit(3)))
    assert sorted(map(tuple, rollup.totals().collect()), key=str) == totals


def test_query_equals_brute_force(spark, tmp_path):
    rows, docs = documents(spark, 60)
    labels = spark.createDataFrame([(i, 0, int(i % 5 == 0)) for i in range(0, 60, 2)] + [(5, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    labels.coalesce(1).write.parquet(str(tmp_path / "labels.parquet"))
    toxic = {i for i in range(0, 60, 10)} | {5}
    encode, expected = tokens.encoder(), Counter()
    for doc_id, text, lang, source, _ in rows:
        text = text or ""
        words = len([w for w in re.split(r"[\x20\x09-\x0D]+", text) if w])
        version = "words/2" if doc_id % 2 else "words/1"
        amounts = [("bpe50k/1", 1, len(encode(text)))]
        amounts += [] if doc_id in toxic else [(version, 1, words)]
        for tokenizer, number, size in amounts:
            key = (source, lang, tokenizer)
            for name, value in (("documents", number), ("tokens", size), ("characters", len(text))):
                expected[(key, name)] += value
    got = {(r.source, r.lang, r.tokenizer): r
           for r in queries.op7_token_counts(spark, str(tmp_path)).collect()}
    keys = {key for key, _ in expected}
    assert set(got) == {k for k in keys if any(expected[(k, a)] for a in rollups.AMOUNTS)}
    for key, row in got.items():
        assert [row[a] for a in rollups.AMOUNTS] == [expected[(key, a)] for a in rollups.AMOUNTS]


def test_batches(spark, tmp_path):
    _, docs = documents(spark, 9)
    rollup = rollups.Rollup(spark, str(tmp_path / "log"))
    assert rollup.totals().collect() == [] and not rollup.committed("a")
    rollup.commit("a", lambda: rollups.changes(inserted=rollups.counted(docs, "words/1")))
    rollup.commit("none", rollups.changes(inserted=rollups.counted(docs.limit(0), "words/1")))
    found = {r.batch: r.documents for r in rollup.batches().filter(F.col("batch") != "").collect()}
    assert found == {"a": 9, "none": 0}
