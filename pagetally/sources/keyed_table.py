"""A table of one row per key that is updated by appending and merged when it is read.

An update writes its own rows and nothing else. Reading takes the newest row of each key among the
updates, and the rows of the base whose key no update has: a Bloom filter of the updates' keys, one
for each bucket of keys, lets most of the base pass as it is scanned, and only the rest is compared
with the keys themselves. Compaction writes a new base now and then.

A write counts once its manifest row is there, which is written last; a base says which updates it
holds. Writes have names of their own, in order of number and time, so writers do not mix.
"""

from __future__ import annotations

import time
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from pagetally.sources.files import file_system

MANIFEST = "name string, base boolean, covers array<string>, rows bigint"
#: Parts of the keys that have a filter each, bits a key, and tests of a key.
BUCKETS, BITS, TESTS = 64, 16, 5
#: Filters up to this size are broadcast; beyond it all keys of the base are compared.
FILTER_BYTES = 64 << 20


def _hash(key: str, seed: int) -> Column:
    return F.xxhash64(F.col(key), F.lit(seed))


def _places(key: str, bits: int) -> list[Column]:
    """The bits of a key in its bucket's filter."""
    first, step = (F.pmod(_hash(key, seed), F.lit(bits)) for seed in (1, 2))
    return [((first + F.lit(i) * step) % bits).cast("long") for i in range(TESTS)]


def key_filters(keys: DataFrame, key: str) -> tuple[DataFrame, int] | None:
    """``_bucket, _words`` of the keys' Bloom filters and their bits; None when they are too large.

    Every bucket has a filter; all are as large as the bucket with most keys needs.
    """
    bucketed = keys.select(key, F.pmod(_hash(key, 0), F.lit(BUCKETS)).alias("_bucket"))
    largest = bucketed.groupBy("_bucket").count().agg(F.max("count")).first()[0] or 0
    words = 1 << max(0, (largest * BITS // 64).bit_length())
    if words * 8 * BUCKETS > FILTER_BYTES:
        return None
    bits = words * 64
    marks = bucketed.select("_bucket", F.explode(F.array(*_places(key, bits))).alias("place")) \
        .groupBy("_bucket", F.floor(F.col("place") / 64).cast("int").alias("word")) \
        .agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 as int)))").alias("mask"))
    # as many rows as the checked size has words
    every = keys.sparkSession.range(BUCKETS * words).select(
        F.floor(F.col("id") / words).cast("long").alias("_bucket"),
        (F.col("id") % words).cast("int").alias("word"))
    dense = every.join(marks, ["_bucket", "word"], "left").groupBy("_bucket").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("word", F.coalesce("mask", F.lit(0)).alias("mask")))),
        lambda w: w["mask"]).alias("_words"))
    return dense, bits


def may_have(rows: DataFrame, key: str, filters: tuple[DataFrame, int]) -> DataFrame:
    """Adds ``_maybe``: False only for rows whose key is surely none of the filters' keys."""
    dense, bits = filters
    found = F.lit(True)
    for place in _places(key, bits):
        word = F.get("_words", F.floor(place / 64).cast("int"))
        found = found & (F.getbit(word, (place % 64).cast("int")) == 1)
    bucketed = rows.withColumn("_bucket", F.pmod(_hash(key, 0), F.lit(BUCKETS)))
    return bucketed.join(F.broadcast(dense), "_bucket").withColumn(
        "_maybe", F.col(key).isNotNull() & found).drop("_bucket", "_words")


class KeyedTable:
    """Rows of ``schema`` under ``path``, one per value of ``key``; null keys are never replaced."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: str | StructType) -> None:
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.schema = spark.createDataFrame([], schema).schema

    def _manifest(self) -> list:
        """Manifest rows in order; a few for each write since the last compaction."""
        try:
            rows = self.spark.read.schema(MANIFEST).option("recursiveFileLookup", "true").parquet(
                f"{self.path}/manifest")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(rows.collect(), key=lambda row: row.name)

    def _parts(self) -> tuple[str | None, list[str]]:
        """The newest base, and the updates that it does not hold, oldest first."""
        rows = self._manifest()
        bases = [row for row in rows if row.base]
        held = set(bases[-1].covers) if bases else set()
        return (bases[-1].name if bases else None,
                [row.name for row in rows if not row.base and row.name not in held])

    def _read(self, names: list[str]) -> DataFrame:
        paths = [f"{self.path}/data/{name}" for name in names]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else \
            self.spark.createDataFrame([], self.schema)

    def _write(self, rows: DataFrame, base: bool, covers: list[str]) -> str:
        manifest = self._manifest()
        number = max((int(row.name.split("-")[0]) for row in manifest), default=0) + 1
        name = f"{number:012d}-{time.time_ns():020d}-{uuid.uuid4().hex}"
        rows.select(*self.schema.names).write.parquet(f"{self.path}/data/{name}")
        n = self._read([name]).count()
        self.spark.createDataFrame([(name, base, covers, n)], MANIFEST).coalesce(1) \
            .write.parquet(f"{self.path}/manifest/{name}")
        return name

    def upsert(self, new: DataFrame) -> None:
        """Rows replace those of their keys; only ``new`` is written. Its keys are unique.

        Columns that ``new`` lacks are null.
        """
        self._write(new.select(*(
            F.col(f.name) if f.name in new.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in self.schema)), False, [])

    def _updates(self, names: list[str]) -> DataFrame:
        """The newest row of each key among updates, and all rows without a key."""
        if len(names) < 2:
            return self._read(names)
        key, rows = self.key, None
        for place, name in enumerate(names):
            part = self._read([name]).withColumn("_order", F.lit(place))
            rows = part if rows is None else rows.unionByName(part)
        rest = [n for n in self.schema.names if n != key]
        newest = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(
            F.struct(*rest, F.lit(1).alias("_")), "_order").alias("_row"))
        return newest.select(key, *(F.col("_row")[n].alias(n) for n in rest)).select(
            *self.schema.names).unionByName(
            rows.filter(F.col(key).isNull()).drop("_order"))

    def read(self) -> DataFrame:
        """The rows in force. Base rows move only when a filter says that they may be replaced."""
        base, names = self._parts()
        updates = self._updates(names)
        if base is None:
            return updates
        old = self._read([base])
        if not names:
            return old
        keys = self._read(names).select(self.key).filter(F.col(self.key).isNotNull()).distinct()
        filters = key_filters(keys, self.key)
        if filters is None:
            return old.join(keys, self.key, "left_anti").unionByName(updates)
        marked = may_have(old, self.key, filters)
        kept = marked.filter(~F.col("_maybe")).drop("_maybe")
        doubtful = marked.filter("_maybe").drop("_maybe").join(keys, self.key, "left_anti")
        return kept.unionByName(doubtful).unionByName(updates)

    def keys(self) -> DataFrame:
        """The keys that have a row."""
        base, names = self._parts()
        return self._read([*([base] if base else []), *names]).select(self.key) \
            .filter(F.col(self.key).isNotNull()).distinct()

    def compact(self) -> None:
        """Writes the rows in force as a new base and removes what it replaces.

        An update that another run adds meanwhile is not held by the new base and stays. Run one
        compaction at a time.
        """
        base, names = self._parts()
        if not names:
            return
        new = self._write(self.read(), True, names)
        try:
            system, root = file_system(self.path)
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
            return                      # a store that only Spark reaches keeps its old files
        rows = self._manifest()
        current = next(row for row in rows if row.name == new)
        # the manifest rows go first: data without one counts for nothing
        gone = [*current.covers, *([base] if base else [])]
        for folder in ("manifest", "data"):
            for name in gone:
                if system.get_file_info(f"{root}/{folder}/{name}").type == fs.FileType.Directory:
                    system.delete_dir(f"{root}/{folder}/{name}")

    def sizes(self) -> dict[str, int]:
        """Rows of each write that counts, by name."""
        base, names = self._parts()
        held = {base, *names}
        return {row.name: row.rows for row in self._manifest() if row.name in held}
