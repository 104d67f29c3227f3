"""Run a step for files that arrived since the last run.

This is the incremental rule "skip what is done" with the source's own bookkeeping: the
stream's checkpoint remembers which files it has read, so nothing is compared with the
output. One call processes what is there and stops, like a batch run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pagetally.plans.steps import Step
from pagetally.session import shared_folder


def run_arrivals(spark: SparkSession, source: str, schema: str, step: Step, target: str,
                 name: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Apply ``step`` to new Parquet files under ``source`` and append to ``target``.

    The Parquet sink commits whole batches, so a run that is cut short neither loses nor
    repeats rows. ``name`` identifies the run's bookkeeping in the shared folder.
    """
    rows = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
    )
    query = (
        step(rows).writeStream.format("parquet").outputMode("append")
        .option("path", target)
        .option("checkpointLocation", f"{shared_folder(spark).rstrip('/')}/arrivals/{name}")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
