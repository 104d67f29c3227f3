"""Document corpora: one text per key."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pagetally.functions.text import corpus_key
from pagetally.sources.files import file_system, read_files, write_files


def read_corpus(spark: SparkSession, path: str, suffix: str = ".html",
                escaped: bool = False) -> DataFrame:
    """``(slug, text, bytes)`` from a folder with one file per key; empty files are rows too.

    The key is the file name, or the value of the folder when a writer partitioned the
    corpus by ``<key><suffix>``; ``escaped`` names are those of :func:`write_corpus_files`. The
    files are listed once and packed by bytes into tasks. A store that only Spark's own readers
    reach is read through them; these skip empty files (see :func:`with_expected`). Keep a large
    corpus as a table: millions of small files cost more to list than to read.
    """
    try:
        file_system(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return _read_by_spark(spark, path, suffix, escaped)
    return read_files(spark, path, suffix, escaped)


def _read_by_spark(spark: SparkSession, path: str, suffix: str, escaped: bool) -> DataFrame:
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    # a path is percent-encoded by Spark, and an escaped name once more by its writer; a plus sign
    # stands for itself
    name = F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))
    slug = corpus_key(F.url_decode(name), suffix)
    if escaped:
        slug = F.url_decode(F.replace(slug, F.lit("+"), F.lit("%2B")))
    return files.filter(slug != "").select(
        slug.alias("slug"),
        F.col("value").alias("text"),
        F.octet_length("value").cast("bigint").alias("bytes"),
    )


def write_corpus_files(df: DataFrame, path: str, suffix: str = ".html") -> None:
    """``(slug, text)`` as one file per key, all of them or none.

    Files appear under their names when every task has written its own; a task that fails or runs
    twice leaves neither halves nor repeats. Characters that file names cannot hold are escaped.
    """
    write_files(df, path, suffix)


def with_expected(corpus: DataFrame, expected: DataFrame, key: str = "slug") -> DataFrame:
    """The corpus and an empty text for each expected key that it lacks.

    A key whose file is empty or was never written is then found by the checks. Keys are
    compared; no text is moved.
    """
    lacking = expected.select(F.col(key).alias("slug")).filter(F.col("slug").isNotNull()) \
        .join(corpus.select("slug"), "slug", "left_anti").distinct()
    return corpus.unionByName(lacking.select(
        "slug", F.lit("").alias("text"), F.lit(0).cast("bigint").alias("bytes")))


def write_corpus(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``(slug, text)`` as a Parquet table."""
    df.select("slug", "text").write.mode(mode).parquet(path)


def read_corpus_table(spark: SparkSession, path: str) -> DataFrame:
    """A corpus written by :func:`write_corpus`, with byte sizes."""
    table = spark.read.parquet(path)
    return table.select("slug", "text", F.octet_length("text").cast("bigint").alias("bytes"))


def corpus_inventory(df: DataFrame, component: str, text: str = "text") -> DataFrame:
    """Documents and empty documents of a corpus."""
    size = F.coalesce(F.octet_length(text), F.lit(0))
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(size == 0).alias("n_empty"),
    ).select(F.lit(component).alias("component"), "n", "n_empty")


def write_report(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Report lines as text files whose names sort in report order.

    The lines are range partitioned, so a long listing is written by many tasks.
    """
    (
        lines.repartitionByRange("section", "row").sortWithinPartitions("section", "row")
        .select("line").write.mode(mode).text(path)
    )
