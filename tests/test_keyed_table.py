"""Merge on read against plain dictionaries, what a run writes, and the filters."""

import random

import pytest
from pyspark.sql import functions as F

from pagetally.plans import steps
from pagetally.sources import keyed_table
from pagetally.sources.keyed_table import KeyedTable, key_filters, may_have

SCHEMA = "slug string, n int, note string"


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def size(path):
    return sum(p.stat().st_size for p in path.rglob("part-*"))


@pytest.mark.parametrize("large_filters", [False, True])
def test_random_updates(spark, tmp_path, monkeypatch, large_filters):
    if large_filters:
        monkeypatch.setattr(keyed_table, "FILTER_BYTES", 0)
    rng = random.Random(4)
    table, held = KeyedTable(spark, str(tmp_path / "t"), "slug", SCHEMA), {}
    assert table.read().collect() == [] and table.keys().collect() == []
    for run in range(5):
        new = {f"k{rng.randrange(60)}": (run, rng.choice([None, "", "x"])) for _ in range(15)}
        table.upsert(spark.createDataFrame([(k, *v) for k, v in new.items()], SCHEMA))
        held |= new
        if run in (1, 3):
            table.compact()
            assert len(table.sizes()) == 1 and len(list((tmp_path / "t/data").iterdir())) == 1
        assert rows_of(table.read()) == sorted(((k, *v) for k, v in held.items()), key=str)
    assert rows_of(table.keys()) == sorted((k,) for k in held)
    assert sum(table.sizes().values()) == len(held) if len(table.sizes()) == 1 else True


def test_null_keys_and_missing_columns(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "slug", SCHEMA)
    table.upsert(spark.createDataFrame([("a", 1, "x"), (None, 2, "y"), (None, 2, "y")], SCHEMA))
    table.compact()
    table.upsert(spark.createDataFrame([("a", 3), (None, 4)], "slug string, n int"))
    table.upsert(spark.createDataFrame([(None, 5)], "slug string, n int"))
    assert rows_of(table.read()) == sorted(
        [("a", 3, None), (None, 2, "y"), (None, 2, "y"), (None, 4, None), (None, 5, None)], key=str)


def test_a_run_writes_its_own_rows(spark, tmp_path):
    path = tmp_path / "t"
    table = KeyedTable(spark, str(path), "slug", "slug string, text string")
    rows = spark.range(20000).select(F.concat(F.lit("s"), "id").alias("slug"), F.sha2(
        F.col("id").cast("string"), 512).alias("text"))
    table.upsert(rows)
    whole = size(path)
    todo = rows.unionByName(rows.limit(0)).unionByName(spark.range(20000, 20200).select(
        F.concat(F.lit("s"), "id").alias("slug"), F.sha2(F.col("id").cast("string"), 512).alias("text")))
    found = steps.run_into(table, todo, lambda p: p)
    assert size(path) - whole < 0.03 * whole
    assert sorted(table.sizes().values()) == [200, 20000]
    assert found.count() == 20200
    plain = steps.run_incremental(todo, rows, lambda p: p)
    assert found.exceptAll(plain).count() == 0 == plain.exceptAll(found).count()


def test_an_unfinished_write_counts_for_nothing(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), "slug", SCHEMA)
    table.upsert(spark.createDataFrame([("a", 1, "x")], SCHEMA))
    wanted = rows_of(table.read())
    monkeypatch.setattr(keyed_table, "MANIFEST", "no schema")
    with pytest.raises(Exception):
        table._write(spark.createDataFrame([("a", 2, "y")], SCHEMA), False, [])
    monkeypatch.undo()
    assert rows_of(table.read()) == wanted


def test_filters_miss_no_key_and_pass_most_others(spark):
    keys = spark.range(0, 30000, 3).select(F.col("id").cast("string").alias("slug"))
    rows = spark.range(30000).select(F.col("id").cast("string").alias("slug"), "id")
    marked = may_have(rows, "slug", key_filters(keys, "slug"))
    counts = {(r.hit, r._maybe): r.n for r in marked.groupBy(
        (F.col("id") % 3 == 0).alias("hit"), "_maybe").agg(F.count("*").alias("n")).collect()}
    assert counts.get((True, False), 0) == 0 and counts[(True, True)] == 10000
    assert counts.get((False, True), 0) < 0.02 * 20000
    empty = may_have(rows, "slug", key_filters(keys.limit(0), "slug"))
    assert empty.filter("_maybe").count() == 0


def test_the_base_does_not_move(spark, tmp_path):
    """Rows that no update may replace go from the scan to the result without an exchange."""
    table = KeyedTable(spark, str(tmp_path / "t"), "slug", SCHEMA)
    table.upsert(spark.range(100).select(F.col("id").cast("string").alias("slug"),
                                         F.lit(1).alias("n"), F.lit("x").alias("note")))
    table.compact()
    table.upsert(spark.createDataFrame([("5", 2, "y")], SCHEMA))
    plan = table.read()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and table.read().count() == 100
    assert table.read().filter("slug = '5'").first().n == 2
