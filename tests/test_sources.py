"""Files, corpora and step state."""

import json

import pytest
from pyspark.sql import functions as F

from pagetally.operators import quality
from pagetally.sources import corpus, state, tables


def test_record_list_positions_run_over_files(spark, tmp_path):
    rows = [{"title": f"T{i}", "slug": f"s{i}", "category": "c", "url": "u"} for i in range(7)]
    (tmp_path / "a.json").write_text(json.dumps(rows[:3], indent=2))
    (tmp_path / "b.json").write_text(json.dumps([]))
    (tmp_path / "c.json").write_text(json.dumps(rows[3:]))
    got = tables.read_records(spark, str(tmp_path)).orderBy("ord").collect()
    assert [(r.ord, r.slug) for r in got] == [(i, f"s{i}") for i in range(7)]


def test_json_keeps_null_keys_and_unicode(spark, tmp_path):
    path = str(tmp_path / "out")
    tables.write_json(spark.createDataFrame([("é|", None), ("b", 4)], "a string, n int"), path)
    lines = [line for part in (tmp_path / "out").glob("part-*") for line in part.read_text().splitlines()]
    assert sorted(lines) == ['{"a":"b","n":4}', '{"a":"é|","n":null}']
    assert tables.read_json(spark, path, "a string, n int").count() == 2
    (tmp_path / "one.json").write_text('{\n "test": "value",\n "number": 42\n}')
    row = tables.read_json(spark, str(tmp_path / "one.json"), "test string, number int", multiline=True).first()
    assert (row.test, row.number) == ("value", 42)


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [("Alice, \"A\"", "30", None), ("Bob\nBuilder", "25", ""), ("back\\slash", "1", "x")]
    frame = spark.createDataFrame(rows, "name string, age string, note string").coalesce(1)
    tables.write_table(frame, path, ["age", "name", "note", "more"])
    back = tables.read_table(spark, path)
    assert back.columns == ["age", "name", "note", "more"]
    assert {(r.name, r.age, r.note, r.more) for r in back.collect()} == {
        (name, age, note or "", "") for name, age, note in rows}
    with pytest.raises(ValueError):
        tables.write_table(frame, str(tmp_path / "bad"), ["name"])


def test_corpus_files_and_table(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>é</p>")
    (tmp_path / "b-c.html").write_text("x\ny\n")
    (tmp_path / "note.md").write_text("no")
    rows = {r.slug: (r.text, r.bytes) for r in corpus.read_corpus(spark, str(tmp_path)).collect()}
    assert rows == {"a": ("<p>é</p>", 9), "b-c": ("x\ny\n", 4)}
    frame = spark.createDataFrame([("a", "t"), ("b", ""), ("c", None)], "slug string, text string")
    corpus.write_corpus(frame, str(tmp_path / "table"))
    table = corpus.read_corpus_table(spark, str(tmp_path / "table"))
    inventory = corpus.corpus_inventory(table, "markdown").first()
    assert (inventory.component, inventory.n, inventory.n_empty) == ("markdown", 3, 2)


def test_expected_files_that_are_empty(spark, tmp_path):
    (tmp_path / "full.html").write_text("x")
    (tmp_path / "blank.html").write_text("")
    expected = spark.createDataFrame([("full",), ("blank",), ("blank",), ("gone",), (None,)], "slug string")
    found = corpus.with_expected(corpus.read_corpus(spark, str(tmp_path)), expected)
    assert sorted((r.slug, r.text, r.bytes) for r in found.collect()) == [
        ("blank", "", 0), ("full", "x", 1), ("gone", "", 0)]
    result = quality.check_corpus(found, "html_files", "HTML").first()
    assert (result.is_valid, result.details) == (False, {"empty_files": "blank, gone"})


def test_report_files_read_in_order(spark, tmp_path):
    lines = spark.range(5000).select(
        F.floor(F.col("id") / 1000).cast("int").alias("section"), (F.col("id") % 1000).alias("row"),
        F.concat(F.lit("line "), F.col("id").cast("string")).alias("line")).repartition(8, "row")
    corpus.write_report(lines, str(tmp_path / "report"))
    parts = sorted((tmp_path / "report").glob("part-*"))
    text = "".join(part.read_text() for part in parts)
    assert text.splitlines() == [f"line {i}" for i in range(5000)]


def keys(spark, *pairs):
    return spark.createDataFrame(list(pairs), "step string, slug string")


def slugs(frame):
    return {row.slug for row in frame.collect()}


def test_state_is_replaced_cleared_and_summarised(spark, tmp_path):
    path = str(tmp_path / "state")
    assert state.read_state(spark, path).count() == 0
    state.save_checkpoint(keys(spark, ("s1", "item1"), ("s1", "item2"), ("s1", "item2"), ("s2", "item3")), path)
    saved = state.read_state(spark, path)
    assert slugs(state.load_checkpoint(saved, "s1")) == {"item1", "item2"}
    assert state.load_checkpoint(saved, "unknown").count() == 0
    items = spark.createDataFrame([("item1",), ("item4",)], "slug string")
    assert slugs(state.completed(items, saved, "s1")) == {"item1"}
    assert {r.step: r.completed for r in state.state_summary(saved).collect()} == {"s1": 2, "s2": 1}

    state.save_checkpoint(keys(spark, ("s1", "other"), ("s3", None)), path)
    saved = state.read_state(spark, path)
    assert slugs(state.load_checkpoint(saved, "s1")) == {"other"}
    assert {r.step: r.completed for r in state.state_summary(saved).collect()} == {"s1": 1, "s2": 1, "s3": 0}

    state.clear_steps(spark, path, ["s1", "nothing"])
    assert {r.step for r in state.state_summary(state.read_state(spark, path)).collect()} == {"s2", "s3"}
    state.save_checkpoint(keys(spark, ("s1", "again")), path)
    assert slugs(state.load_checkpoint(state.read_state(spark, path), "s1")) == {"again"}
    state.clear_steps(spark, path)
    assert state.read_state(spark, path).count() == 0


def test_unreadable_state_counts_as_empty(spark, tmp_path):
    path = tmp_path / "state" / "step=s1"
    path.mkdir(parents=True)
    (path / "part-0.parquet").write_text("not parquet")
    assert state.read_state(spark, str(tmp_path / "state")).count() == 0
