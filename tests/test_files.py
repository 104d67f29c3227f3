"""Corpora of one file per key: listing, packing, two-phase writes."""

import uuid

import pytest
from pyspark.sql import Row, functions as F

from pagetally.operators import quality
from pagetally.sources import corpus, files


def names(path):
    return sorted(p.name for p in path.rglob("*") if p.is_file() and not p.name.startswith("."))


def test_a_thousand_keys_round_trip(spark, tmp_path):
    path = tmp_path / "corpus"
    frame = spark.range(1000, numPartitions=7).select(
        F.col("id").cast("string").alias("slug"), F.when(F.col("id") % 10 > 0, F.concat(
            F.lit("é\r\ntext "), F.col("id").cast("string"))).alias("text"), F.lit(1).alias("extra"))
    corpus.write_corpus_files(frame, str(path), ".md")
    assert names(path) == sorted([f"{i}.md" for i in range(1000)] + ["_SUCCESS"])
    assert [p.name for p in path.iterdir() if p.is_dir()] == []
    found = {r.slug: (r.text, r.bytes) for r in corpus.read_corpus(spark, str(path), ".md").collect()}
    texts = {str(i): f"é\r\ntext {i}" if i % 10 else "" for i in range(1000)}
    assert found == {k: (t, len(t.encode())) for k, t in texts.items()}
    result = quality.check_corpus(corpus.read_corpus(spark, str(path), ".md"), "md", "Markdown").first()
    assert not result.is_valid and result.details["empty_files"].split(", ") == sorted(
        str(i) for i in range(0, 1000, 10))[:5]
    with pytest.raises(FileExistsError):
        corpus.write_corpus_files(frame, str(path), ".md")


def test_odd_names_and_folders(spark, tmp_path):
    keys = ["a/b", "100%", "_hidden", ".dot", "sp ace", "plus+", "é", "x=y", "%2F", "q?#&", "..", "a.md"]
    frame = spark.createDataFrame([(k, f"text of {k}") for k in keys], "slug string, text string")
    path = tmp_path / "odd folder=1+1"
    corpus.write_corpus_files(frame, str(path), ".md")
    found = {r.slug: r.text for r in corpus.read_corpus(spark, str(path), ".md", True).collect()}
    assert found == {k: f"text of {k}" for k in keys}
    by_spark = corpus._read_by_spark(spark, str(path), ".md", True)
    assert {r.slug: r.text for r in by_spark.collect()} == found
    deep = tmp_path / "deep"
    for name in ("in/a.html", "in/_no/b.html", "file=c.html/part-0.txt", ".d.html", "_SUCCESS",
                 "e.htm", ".html", "in/f.html"):
        (deep / name).parent.mkdir(parents=True, exist_ok=True)
        (deep / name).write_text("" if name == "in/f.html" else name)
    got = {r.slug: r.text for r in corpus.read_corpus(spark, f"file://{deep}").collect()}
    assert got == {"a": "in/a.html", "c": "file=c.html/part-0.txt", "f": ""}
    (tmp_path / "none").mkdir()
    assert corpus.read_corpus(spark, str(tmp_path / "none")).collect() == []


def test_files_are_packed_by_bytes(tmp_path):
    for i in range(30):
        (tmp_path / f"{i:02}.x").write_bytes(b"a" * (i % 3) * 1000)
    reader = files._Reader({"path": str(tmp_path), "suffix": ".x", "bytes": str(5 * files.OPEN_COST)})
    packed = reader.partitions()
    assert [k for p in packed for _, k in p.files] == [f"{i:02}" for i in range(30)]
    assert len(packed) > 6 and all(len(p.files) <= 5 for p in packed)


def test_a_task_that_fails_half_way_leaves_nothing(spark, tmp_path):
    """Attempts by hand: one dies half-way, its retry and a twin of another task finish."""
    path = tmp_path / "corpus"
    writer = files._Writer({"path": str(path), "suffix": ".md"})

    def rows(*keys, die=False):
        for key in keys:
            yield Row(slug=key, text=f"text {key}")
        if die:
            raise RuntimeError("lost")
    with pytest.raises(RuntimeError):
        writer.write(rows("a", "b", die=True))
    first = writer.write(rows("a", "b", "c"))
    second = writer.write(rows("d"))
    writer.write(rows("d"))                      # a twin whose message is not committed
    assert [p.name for p in path.iterdir() if not p.name.startswith("_")] == []
    writer.commit([first, None, second])
    assert names(path) == ["_SUCCESS", "a.md", "b.md", "c.md", "d.md"]
    assert not any(p.is_dir() for p in path.iterdir())


@pytest.mark.parametrize("keys", [["a", "b", None], ["a", ""], ["a", "b", "a"]])
def test_a_write_that_fails_leaves_nothing(spark, tmp_path, keys):
    path = tmp_path / uuid.uuid4().hex
    frame = spark.createDataFrame([(k, "t") for k in keys], "slug string, text string").repartition(3)
    with pytest.raises(Exception):
        corpus.write_corpus_files(frame, str(path))
    assert not path.exists() or names(path) == []
    assert corpus.read_corpus(spark, str(path)).collect() == [] if path.exists() else True
