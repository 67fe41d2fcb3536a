"""Label files of a mounted folder, listed and read on the executors."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

NAME = "boxloom_label_files"
SCHEMA = "path string, text string"
BATCH_FILES, BATCH_BYTES = 4096, 16_000_000


def _shown(name: str) -> bool:
    """Spark's readers pass over names that begin with a dot or an underscore."""
    return name[0] not in "._"


class Share(InputPartition):
    """Some of the files below a folder: those whose name falls to this share."""

    def __init__(self, folder: str, deep: bool, share: int, of: int):
        super().__init__((folder, share))
        self.folder, self.deep, self.share, self.of = folder, deep, share, of


class LabelFolder(DataSource):
    """Every .txt under ``path``, also empty ones. Options: ``shares`` (tasks that share a first-level folder)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return LabelReader(self.options)


class LabelReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.shares = options["path"], int(options.get("shares", "4"))

    def partitions(self) -> list[InputPartition]:
        """Only folders of the first level are looked at here; files are listed where they are read."""
        with os.scandir(self.root) as entries:
            folders = sorted(e.name for e in entries if _shown(e.name) and e.is_dir())
        return [Share(f, deep, k, self.shares) for f, deep in [("", False), *((f, True) for f in folders)] for k in range(self.shares)]

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        paths, texts, size = [], [], 0
        for path in self._files(partition.folder, partition.deep):
            if zlib.crc32(path.encode("utf-8", "surrogateescape")) % partition.of != partition.share:
                continue
            with open(os.path.join(self.root, path), "rb") as f:
                texts.append(f.read().decode("utf-8", "replace"))
            paths.append(path)
            size += len(texts[-1])
            if len(paths) >= BATCH_FILES or size >= BATCH_BYTES:
                yield self._batch(paths, texts)
                paths, texts, size = [], [], 0
        if paths:
            yield self._batch(paths, texts)

    def _files(self, folder: str, deep: bool) -> Iterator[str]:
        with os.scandir(os.path.join(self.root, folder)) as entries:
            for e in entries:
                if _shown(e.name):
                    path = f"{folder}/{e.name}" if folder else e.name
                    if e.is_dir():
                        if deep:
                            yield from self._files(path, True)
                    elif e.name.endswith(".txt"):
                        yield path

    def _batch(self, paths: list[str], texts: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.string())], ["path", "text"])


def mounted(spark: SparkSession, root: str) -> str | None:
    """The folder as a path of the machine, if it lies in a file system that every machine has mounted."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(path).toUri().getPath() if system.getScheme() == "file" else None
