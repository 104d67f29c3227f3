"""Splittable CSV and JSON arrays against whole-file readers, with chunks of a few bytes."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from pagetally.sources import chunks, tables


@pytest.fixture
def small_chunks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}

    def use(size):
        for name in names:
            spark.conf.set(name, str(size))
    yield use
    for name, value in before.items():
        spark.conf.set(name, value)


def one_task_table(spark, path):
    frame = spark.read.option("header", True).option("escape", '"').option(
        "multiLine", True).csv(path)
    return tables.with_defaults(frame, frame.columns)


CELLS = ["", "plain", "with, comma", 'say "x"', "two\nlines", '"', '""', '\n', ",\n,", "é\n\"é\",",
         "x" * 70, 'a,"b"\n"c', " spaced ", "5' pipe", "\r\n", "tail\r"]


def random_csv(rng, rows, end="\n", bare=()):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["slug", "title", "note"])
    for i in range(rows):
        if bare and rng.random() < 0.2:
            out.write(f"{i},{rng.choice(bare)},z{end}")
        else:
            writer.writerow([i, rng.choice(CELLS), rng.choice(CELLS)])
    return out.getvalue()


@pytest.mark.parametrize("size", [25, 1000])
def test_csv_equals_one_task_reader(spark, tmp_path, small_chunks, size):
    rng = random.Random(size)
    bare = ['5" pipe', 'a "b" c', 'x""y', "no quote", ""]
    for i, text in enumerate([random_csv(rng, 25), random_csv(rng, 1), random_csv(rng, 0),
                              random_csv(rng, 20, bare=bare), random_csv(rng, 9).rstrip("\n"),
                              "slug,title,note\n\n1,,\n\n\n2,b,c\n"]):
        (tmp_path / f"{i}.csv").write_bytes(text.encode())
    wanted = sorted(map(tuple, one_task_table(spark, str(tmp_path)).collect()))
    small_chunks(size)
    found = tables.read_table(spark, str(tmp_path))
    assert found.columns == ["slug", "title", "note"]
    assert sorted(map(tuple, found.collect())) == wanted
    named = tables.read_table(spark, str(tmp_path), ["a", "b", "c", "d"])
    assert sorted(map(tuple, named.collect())) == [(*row, "") for row in wanted]


def test_csv_with_carriage_returns(spark, tmp_path, small_chunks):
    """Breaks inside quotes stay as they are written."""
    text = random_csv(random.Random(1), 50, "\r\n")
    (tmp_path / "a.csv").write_bytes(text.encode())
    wanted = sorted(map(tuple, list(csv.reader(io.StringIO(text, newline="")))[1:]))
    small_chunks(90)
    assert sorted(map(tuple, tables.read_table(spark, str(tmp_path)).collect())) == wanted


def test_no_task_reads_more_than_its_chunks(spark, tmp_path, small_chunks):
    """One file, one cell of which spans many chunks; records keep their numbers."""
    rows = [["n", "v"]] + [[str(i), "v\n" * (400 if i == 50 else 1)] for i in range(300)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    (tmp_path / "one.csv").write_text(out.getvalue())
    small_chunks(100)
    cut = chunks.pieces(spark, str(tmp_path), "\n")
    size = len(out.getvalue())
    tasks = cut.groupBy(F.spark_partition_id().alias("task")).agg(
        F.sum(F.octet_length("value") + 1).alias("bytes"), F.countDistinct("block").alias("chunks"))
    assert cut.select("block").distinct().count() > 10
    read = tasks.collect()
    assert sum(r.bytes for r in read) in (size, size + 1) and max(r.bytes for r in read) < size / 5
    found, _ = chunks.records(spark, str(tmp_path), "\n", chunks.csv_step, 0)
    got = {r.ord: r.value for r in found.collect()}
    assert len(got) == 301 and got[51] == '50,"' + "v\n" * 400 + '"'
    assert [got[i + 1].split(",")[0] for i in range(300)] == [str(i) for i in range(300)]


def test_starts_too_many_to_broadcast(spark, tmp_path, small_chunks, monkeypatch):
    monkeypatch.setattr(chunks, "BROADCAST_CHUNKS", 3)
    (tmp_path / "a.csv").write_bytes(random_csv(random.Random(5), 80).encode())
    wanted = sorted(map(tuple, one_task_table(spark, str(tmp_path)).collect()))
    small_chunks(50)
    assert sorted(map(tuple, tables.read_table(spark, str(tmp_path)).collect())) == wanted


SCHEMA = "slug string, n long, tags array<string>, more struct<a:string>"


def one_task_records(spark, path):
    values = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"),
        F.from_json("value", f"array<struct<{SCHEMA}>>", {"mode": "FAILFAST"}).alias("r"))
    rows = values.select("file", F.posexplode("r").alias("pos", "record")).orderBy(
        "file", "pos").select("record.*").collect()
    return [(i, *row) for i, row in enumerate(rows)]


def random_array(rng, n):
    texts = ["", "a,b", '"', "\\", "\\\"", "]", "}{", "[1,2]", "é\n,", "x" * 60, "\\u005d", ", "]
    rows = [None if rng.random() < 0.1 else {
        k: v for k, v in (("slug", rng.choice(texts)), ("n", rng.randrange(9)),
                          ("tags", [rng.choice(texts) for _ in range(rng.randrange(4))]),
                          ("more", rng.choice([None, {}, {"a": rng.choice(texts), "b": [{}, []]}])),
                          (rng.choice(texts), [{"x": [rng.choice(texts)]}]))
        if rng.random() < 0.8} for _ in range(n)]
    return json.dumps(rows, indent=rng.choice([None, 2, 0]), ensure_ascii=rng.random() < 0.5,
                      separators=rng.choice([(",", ":"), (" , ", ": ")]))


@pytest.mark.parametrize("size", [25, 100_000])
def test_json_arrays_equal_one_task_reader(spark, tmp_path, small_chunks, size):
    rng = random.Random(size)
    for i, text in enumerate([random_array(rng, 12), "[]", random_array(rng, 1), " [ \n ] \n",
                              "\n" + random_array(rng, 8) + " \n", "[null]", "[null, {}]"]):
        (tmp_path / f"{i}.json").write_bytes(text.encode())
    wanted = one_task_records(spark, str(tmp_path))
    small_chunks(size)
    found = tables.read_records(spark, str(tmp_path), SCHEMA).orderBy("ord").collect()
    assert [tuple(row) for row in found] == wanted


@pytest.mark.parametrize("text", [
    '{"slug": "a"}', '[{"slug": "a"}', '[{"slug": "a"}] x', '[{"slug": "a"},]', '[{"slug": "a"},,{}]',
    '[{"slug": "a"} x]', "[1]", '["a, b"]', "[{}],[{}]", "[{}] [{}]", '[{"slug": "a]', "x", "]["])
def test_what_is_no_array_is_an_error(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception):
        tables.read_records(spark, str(tmp_path), SCHEMA).collect()


def test_steps_equal_a_plain_reading():
    """States by character, from both starts."""
    rng = random.Random(3)
    for _ in range(3000):
        piece = "".join(rng.choices('"\\[]{}ab :', k=rng.randrange(12)))
        for state in (0, 1):
            inside, escaped, depth = state == 1, False, 0
            for c in piece:
                if inside:
                    if escaped:
                        escaped = False
                    elif c == "\\":
                        escaped = True
                    elif c == '"':
                        inside = False
                elif c == '"':
                    inside = True
                else:
                    depth += (c in "[{") - (c in "]}")
            if "\\" not in piece or inside or '"' in piece:
                assert chunks.json_step(piece, state) == (int(inside), depth), (piece, state)
