"""Arrow and table helpers of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetally.session import scratch_path

#: Text bytes that a task handles at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 19
#: Rows of an Arrow batch, so that long texts do not add up in a Python worker.
BATCH_ROWS = 1000


def slices(batches: Iterable[pa.RecordBatch], column: str,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces of at most ``limit`` text bytes or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
        del batch
    pa.default_memory_pool().release_unused()


def bounded_batches(spark: SparkSession) -> SparkSession:
    """The session, with Arrow batches of at most ``BATCH_ROWS`` rows from now on."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    return spark


def as_bytes(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """A text column as UTF-8 bytes."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(docs: DataFrame, keep: Callable[[pa.RecordBatch], np.ndarray],
         column: str = "text") -> DataFrame:
    """The rows for whose slice ``keep`` gives True, with all columns and no shuffle."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, column):
            mask = keep(piece)
            if mask.all():
                yield piece
            elif mask.any():
                yield piece.filter(pa.array(mask))
    return docs.mapInArrow(run, docs.schema)


def remainder(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus \
        if isinstance(doc_id, str) else F.crc32(doc_id.cast("string").cast("binary")) % modulus
