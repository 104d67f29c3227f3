"""Token counts as rollups that are maintained by deltas.

A batch holds signed changes: inserts add a document's counts, deletes take them away, and a
revision does both. The changes of a batch are summed by source, language and tokenizer version
and appended as one folder of a Parquet log under the batch's name. Totals are the sum over the
log, so they are additive, need no old documents, and can be compacted.

A commit is idempotent: a batch name that is in the log is not written again, and a batch
counts once even where two writers both wrote it, since each attempt has a name of its own and
only the first whole one of a batch is read. Each attempt states in a mark row how many rows it
has. One of which only a part is there, as when a driver dies while files are published or a store
publishes them one by one, is not whole: it counts for nothing and its batch can be committed again.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, written
from .tokens import encoder

KEYS = ("source", "lang", "tokenizer")
AMOUNTS = ("documents", "tokens", "characters")
LOG = "source string, lang string, tokenizer string, documents long, tokens long, " \
      "characters long, batch string, rows long, attempt string"


def counted(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, source, lang, tokenizer, tokens, characters`` of whole texts, null as empty.

    ``bpe50k/1`` counts byte-level BPE ids, ``words/1`` runs of other than white space.
    """
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"),
                       F.col("lang").cast("string").alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if tokenizer.startswith("words/"):
        found = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
        rows = rows.withColumn("tokens", found.cast("long"))
    elif tokenizer.startswith("bpe50k/"):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encode = encoder()
            for batch in slices(batches, "text"):
                numbers = [len(encode(t)) for t in batch.column("text").to_pylist()]
                lengths = [len(t) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("source"), batch.column("lang"),
                     pa.array(numbers, pa.int64()), pa.array(lengths, pa.int64())],
                    names=["doc_id", "source", "lang", "tokens", "characters"])
        kind = dict(docs.dtypes)["doc_id"]
        rows = rows.mapInArrow(run, f"doc_id {kind}, source string, lang string, tokens long, "
                                    "characters long")
        return rows.withColumn("tokenizer", F.lit(tokenizer))
    else:
        raise ValueError(f"no tokenizer {tokenizer}")
    return rows.select("doc_id", "source", "lang", F.lit(tokenizer).alias("tokenizer"), "tokens",
                       F.length("text").cast("long").alias("characters"))


def changes(inserted: DataFrame | None = None, deleted: DataFrame | None = None,
            revised: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Signed counts of a batch; ``revised`` is (as counted before, as counted now)."""
    parts = [(1, inserted), (-1, deleted)]
    if revised is not None:
        parts += [(-1, revised[0]), (1, revised[1])]
    signed = [part.select(*KEYS, F.lit(sign).cast("long").alias("documents"),
                          (F.col("tokens") * sign).alias("tokens"),
                          (F.col("characters") * sign).alias("characters"))
              for sign, part in parts if part is not None]
    total = signed[0]
    for part in signed[1:]:
        total = total.unionByName(part)
    return total


class Rollup:
    """A log of committed batches at ``path``, which every executor must reach."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _log(self) -> DataFrame:
        try:
            return self.spark.read.schema(LOG).parquet(self.path)
        except Exception as problem:
            if "PATH_NOT_FOUND" in str(problem):
                return self.spark.createDataFrame([], LOG)
            raise

    def _whole(self) -> DataFrame:
        """``batch, attempt`` of the first whole attempt of each batch: one row a batch."""
        attempts = self._log().groupBy("batch", "attempt").agg(
            F.count(F.lit(1)).alias("found"), F.max("rows").alias("rows"))
        return attempts.filter(F.col("found") == F.col("rows")).groupBy("batch").agg(
            F.min("attempt").alias("attempt"))

    def committed(self, batch: str) -> bool:
        """Whether a whole attempt of the batch is in the log."""
        return not self._whole().filter(F.col("batch") == batch).isEmpty()

    def commit(self, batch: str, signed: DataFrame | Callable[[], DataFrame]) -> bool:
        """Append the sums of a batch; False, and nothing done, if it is there already.

        The sums, one row for each key, are kept first, so that the mark row can state how many
        there are. Each commit writes at least that row, so that an empty batch is committed too.
        Attempts are named by time: a later one of another writer does not displace the first.
        """
        if self.committed(batch):
            return False
        signed = signed() if callable(signed) else signed
        sums = written(signed.groupBy(*KEYS).agg(*(F.sum(a).alias(a) for a in AMOUNTS)), "sums")
        mark = self.spark.range(1).select(
            *(F.lit(None).cast("string").alias(k) for k in KEYS),
            *(F.lit(0).cast("long").alias(a) for a in AMOUNTS),
            F.lit(sums.count() + 1).cast("long").alias("rows"))
        # a folder for each attempt: two writers to one would take each other's unfinished files away
        sums.unionByName(mark, allowMissingColumns=True).withColumn("batch", F.lit(batch)) \
            .write.parquet(f"{self.path}/attempt={time.time_ns():020d}-{uuid.uuid4().hex}")
        return True

    def _once(self) -> DataFrame:
        return self._log().join(self._whole(), ["batch", "attempt"])

    def totals(self, *by: str) -> DataFrame:
        """Sums by ``by`` (source, language and tokenizer unless named); rows of nothing go."""
        by = by or KEYS
        nothing: Column = F.lit(True)
        for amount in AMOUNTS:
            nothing = nothing & (F.col(amount) == 0)
        sums = self._once().groupBy(*by).agg(*(F.sum(a).alias(a) for a in AMOUNTS))
        return sums.filter(~nothing)

    def batches(self) -> DataFrame:
        """``batch`` and its sums over all keys."""
        return self._once().groupBy("batch").agg(*(F.sum(a).alias(a) for a in AMOUNTS))
