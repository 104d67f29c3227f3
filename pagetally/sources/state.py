"""Completed keys per step, as a log of saves that several runs may write.

A save is a folder of its own, named by a number, the time and a random part, so saves of two runs
never mix: the greatest whole name of a step is in force, and one of two interleaved saves wins as a
whole. A save states in a mark row how many keys it has; one of which a part is missing, as after a
crash, is passed over and the one before it stays in force. Nothing is rewritten: old saves are
removed once there are more than a few. The log is partitioned by save and step, so reading the
state opens the files of the saves in force only, and two runs never write to one folder, where the
first to finish would take the other's unfinished files away.
"""

from __future__ import annotations

import time
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from pagetally.sources.files import file_system

LOG_SCHEMA = "slug string, ts timestamp, keys bigint, save string, step string"
#: Saves, beside one a step, after which those that are out of force are removed.
KEEP_SAVES = 32
#: Saves in force that are named in a filter, which opens their folders only.
NAMED = 1000


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All saves. No log, or unreadable files in it, means nothing is recorded.

    Files that a removal takes away while they are read leave their saves incomplete.
    """
    empty = spark.createDataFrame([], LOG_SCHEMA)
    try:
        files = spark.read.schema(LOG_SCHEMA).option("ignoreCorruptFiles", "true").option(
            "ignoreMissingFiles", "true").parquet(path)
    except AnalysisException:
        return empty
    return files.select(*empty.columns)


def _append(rows: DataFrame, path: str) -> None:
    """``rows`` (step, slug, ts, keys) as one save; then what is out of force may go."""
    spark = rows.sparkSession
    found = read_log(spark, path).agg(
        F.max("save").alias("newest"), F.countDistinct("save").alias("n"),
        F.countDistinct("step").alias("steps")).first()
    number = int(found.newest.split("-")[0]) + 1 if found.newest else 1
    save = f"{number:012d}-{time.time_ns():020d}-{uuid.uuid4().hex}"
    rows.write.partitionBy("step").parquet(f"{path.rstrip('/')}/save={save}")
    if found.n >= KEEP_SAVES + found.steps:
        remove_old_saves(spark, path)


def save_checkpoint(keys: DataFrame, path: str) -> None:
    """Replace the key sets of the steps in ``keys(step, slug)``.

    Each step also gets a row with a null key, so that an empty set is recorded too; that row has
    the number of keys.
    """
    marks = keys.groupBy("step").agg(F.countDistinct("slug").alias("keys")).withColumn(
        "slug", F.lit(None).cast("string"))
    rows = keys.filter("slug is not null").select("step", "slug").distinct().unionByName(
        marks, allowMissingColumns=True)
    _append(rows.select("step", "slug", F.current_timestamp().alias("ts"), "keys"), path)


def clear_steps(spark: SparkSession, path: str, steps: list[str] | None = None) -> None:
    """Forget the listed steps, or all of them."""
    known = read_log(spark, path).select("step").distinct()
    if steps is not None:
        known = known.filter(F.col("step").isin(steps))
    _append(known.select(
        "step", F.lit(None).cast("string").alias("slug"), F.lit(None).cast("timestamp").alias("ts"),
        F.lit(0).cast("bigint").alias("keys")), path)


def _in_force(log: DataFrame) -> DataFrame:
    """``step, save``: the newest whole save of each step."""
    saves = log.groupBy("step", "save").agg(
        F.count("slug").alias("found"), F.max("keys").alias("keys"))
    return saves.filter("found = keys").groupBy("step").agg(F.max("save").alias("save"))


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """Save in force of every step: ``(step, slug, ts)``; a null key marks the save."""
    log = read_log(spark, path)
    force = _in_force(log)
    names = force.select("save").distinct().limit(NAMED + 1).collect()
    if len(names) <= NAMED:
        # a save may hold several steps, of which only some are in force by it
        log = log.filter(F.col("save").isin([row.save for row in names]))
    return log.join(force, ["step", "save"]).filter("ts is not null").select("step", "slug", "ts")


def remove_old_saves(spark: SparkSession, path: str) -> int:
    """Removes key sets older than the one in force of their step; how many went.

    Saves that are not whole but newer stay, since another run may be writing them. In a store
    that only Spark's own readers reach nothing is removed.
    """
    try:
        system, _ = file_system(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return 0
    try:
        files = spark.read.schema(LOG_SCHEMA).option("ignoreCorruptFiles", "true").parquet(path)
    except AnalysisException:
        return 0
    # .../save=<name>/step=<step>/<file>
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    placed = files.select("*", folder.alias("folder"))
    force = _in_force(files).withColumnRenamed("save", "newest")
    marked = placed.join(force, "step", "left").select(
        "save", "folder", F.coalesce(F.col("save") < F.col("newest"), F.lit(False)).alias("old"))
    steps = marked.groupBy("save", "folder").agg(F.max("old").alias("old"))
    saves = steps.groupBy("save").agg(
        F.min("old").alias("all_old"), F.collect_set(F.when(F.col("old"), F.col("folder"))).alias("folders"))
    removed = 0
    # one row per save; a save of which every step is out of force goes as a whole
    for row in saves.filter(F.size("folders") > 0).toLocalIterator():
        whole = [row.folders[0].rpartition("/")[0]] if row.all_old else row.folders
        for name in whole:
            inner = file_system(name)[1]
            if system.get_file_info(inner).type == fs.FileType.Directory:
                system.delete_dir(inner)
        removed += len(row.folders)
    return removed


def load_checkpoint(state: DataFrame, step: str) -> DataFrame:
    """Completed keys of one step; empty for an unknown step."""
    return state.filter((F.col("step") == step) & F.col("slug").isNotNull()).select("slug")


def completed(items: DataFrame, state: DataFrame, step: str, key: str = "slug") -> DataFrame:
    """Items whose key is recorded for the step."""
    done = load_checkpoint(state, step).withColumnRenamed("slug", key)
    return items.join(done, key, "left_semi")


def state_summary(state: DataFrame) -> DataFrame:
    """Completed keys and save time per step."""
    return state.groupBy("step").agg(
        F.count("slug").alias("completed"), F.max("ts").alias("ts"))
