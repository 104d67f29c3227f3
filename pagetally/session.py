"""Session defaults and the shared folder used for durable intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "pagetally", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are tuned for.

    ``master`` and sizes are left to spark-submit on a cluster.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # recording the call site of every column expression doubles the time to build a plan
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # pages are large cells: keep one Arrow batch well below a worker's memory
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="pagetally-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint.

    Used where a frame feeds several outputs and must not be evaluated twice: row
    positions that depend on a physical order, or a costly user scorer.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, pruned when it is read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out to all cores when their source has fewer partitions than there are cores.

    For callers whose tables are small files of one row group; operators never call it.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 0 < df.rdd.getNumPartitions() < cores else df
