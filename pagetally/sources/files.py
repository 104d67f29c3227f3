"""Corpora of one file per key, as a data source that lists, packs, reads and writes the files.

Reading lists the files once, packs them by bytes into tasks, and gives empty files as rows like any
other. Writing has two phases: a task writes its files into a folder of its own below a staging
folder, and only when all tasks are done are the files of the attempts that count moved to their
place; an attempt that failed, or ran twice, leaves nothing.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, InputPartition,
                                    WriterCommitMessage)

# Workers get the code of this module with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SOURCE = "corpus_files"
SCHEMA = "slug string, text string, bytes bigint"
STAGING = "_staging-"
#: Bytes that opening a file is worth when files are packed.
OPEN_COST = 1 << 20
#: Files moved at once when a write is committed.
MOVES = 16


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path in it; an error for an unknown kind."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path.rstrip("/")
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + unquote(path.removeprefix("file:")).strip("/")
    found, inner = fs.FileSystem.from_uri(path)
    return found, inner.rstrip("/")


def escaped(key: str) -> str:
    """A key as a file name: ``%``, ``/`` and a leading ``.`` or ``_``, which hides files, as %XX."""
    name = key.replace("%", "%25").replace("/", "%2F").replace("\0", "%00")
    return f"%{ord(name[0]):02X}{name[1:]}" if name[:1] in (".", "_") else name


def key_of(path: str, suffix: str) -> str | None:
    """Key of a file: its name, or the value of the folder ``column=key`` that a writer made."""
    folder, _, name = path.rpartition("/")
    parent = folder.rpartition("/")[2]
    if "=" in parent and parent.endswith(suffix):
        name = parent.partition("=")[2]
    return name.removesuffix(suffix) or None if name.endswith(suffix) else None


@dataclass
class Files(InputPartition):
    """Files of one task: (path, key)."""

    files: list[tuple[str, str]]


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.suffix = options.get("suffix", "")
        self.target = int(options.get("bytes", 64 << 20))
        self.decode = options.get("escaped", "false").lower() == "true"

    def partitions(self) -> list[Files]:
        system, base = file_system(self.path)
        listed = system.get_file_info(fs.FileSelector(base, recursive=True))
        found = []
        for info in listed:
            inner = info.path[len(base):].strip("/")
            hidden = any(part[:1] in ("_", ".") for part in inner.split("/"))
            key = None if hidden or info.type != fs.FileType.File else key_of(
                "/" + inner, self.suffix)
            if key is not None:
                found.append((info.path, unquote(key) if self.decode else key, info.size))
        packed: list[Files] = []
        room = 0
        for path, key, size in sorted(found):
            cost = size + OPEN_COST
            if not packed or cost > room:
                packed.append(Files([]))
                room = self.target
            packed[-1].files.append((path, key))
            room -= cost
        return packed or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.path)
        keys, texts, sizes, held = [], [], [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(texts, pa.string()),
                 pa.array(sizes, pa.int64())], names=["slug", "text", "bytes"])

        for path, key in partition.files:
            with system.open_input_stream(path) as stream:
                data = stream.read()
            keys.append(key)
            texts.append(data.decode("utf-8", "replace"))
            sizes.append(len(data))
            held += len(data)
            if held > 1 << 23 or len(keys) >= 1000:
                yield batch()
                keys, texts, sizes, held = [], [], [], 0
        if keys:
            yield batch()


@dataclass
class _Written(WriterCommitMessage):
    """What a task's attempt has written."""

    folder: str
    names: list[str]


class _Writer(DataSourceWriter):
    def __init__(self, options: dict) -> None:
        self.path, self.suffix = options["path"], options.get("suffix", "")
        _, base = file_system(self.path)
        self.base, self.staging = base, f"{base}/{STAGING}{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> _Written:
        system, _ = file_system(self.path)
        folder = f"{self.staging}/{uuid.uuid4().hex}"
        system.create_dir(folder, recursive=True)
        names: set[str] = set()
        for row in iterator:
            if not row.slug:
                raise ValueError("a file needs a key")
            name = escaped(row.slug) + self.suffix
            if name in names:
                raise ValueError(f"key {row.slug!r} comes twice")
            names.add(name)
            with system.open_output_stream(f"{folder}/{name}") as stream:
                stream.write((row.text or "").encode())
        return _Written(folder, sorted(names))

    def commit(self, messages: list[_Written | None]) -> None:
        system, _ = file_system(self.path)
        moves = [(f"{m.folder}/{name}", name) for m in messages if m for name in m.names]
        seen: set[str] = set()
        for _, name in moves:
            if name in seen:
                self.abort(messages)
                raise ValueError(f"file {name!r} would be written twice")
            seen.add(name)
        with ThreadPoolExecutor(MOVES) as pool:
            list(pool.map(lambda move: system.move(move[0], f"{self.base}/{move[1]}"), moves))
        self._drop(system)
        with system.open_output_stream(f"{self.base}/_SUCCESS"):
            pass

    def abort(self, messages: list[_Written | None]) -> None:
        self._drop(file_system(self.path)[0])

    def _drop(self, system: fs.FileSystem) -> None:
        if system.get_file_info(self.staging).type == fs.FileType.Directory:
            system.delete_dir(self.staging)


class CorpusFiles(DataSource):
    """Options: ``path``, ``suffix``, ``bytes`` of a task's files, ``escaped`` file names."""

    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options)


def read_files(spark: SparkSession, path: str, suffix: str, escaped: bool = False) -> DataFrame:
    """``(slug, text, bytes)`` of the files with ``suffix``, empty ones included."""
    spark.dataSource.register(CorpusFiles)
    return spark.read.format(SOURCE).option("path", path).option("suffix", suffix).option(
        "escaped", str(escaped).lower()).load()


def write_files(df: DataFrame, path: str, suffix: str) -> None:
    """One file per row of ``(slug, text)`` in the folder ``path``, which must not exist.

    A null text is an empty file. A key that is null, empty or comes twice ends the write with an
    error and leaves nothing.
    """
    system, base = file_system(path)
    if system.get_file_info(base).type != fs.FileType.NotFound:
        raise FileExistsError(path)
    df.sparkSession.dataSource.register(CorpusFiles)
    df.select("slug", "text").write.format(SOURCE).option("path", path).option(
        "suffix", suffix).mode("append").save()
