"""Members of TAR and ZIP archives as a data source.

    register(spark)
    spark.read.format("archive").option("path", ...).option("suffixes", ".abc,.mid").load()

Rows are (archive, member, ordinal, size, content). A ZIP is cut into ranges of
members by its directory, an archive of another kind is one task's work. Names are
filtered before contents are read, and with `content=false` contents aren't read.
Archives are opened as local files, so they must lie on storage that all executors
mount; `members` reads them through Spark's file readers instead, whatever the store.
"""

from __future__ import annotations

import glob
import io
import os
import tarfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import ship

SCHEMA = "archive string, member string, ordinal int, size long, content binary"


class UnsafePath(ValueError):
    """A member name that would leave the target folder."""


def safe(name: str) -> str:
    if name.startswith(("/", "\\")) or ".." in name.replace("\\", "/").split("/") or (len(name) > 1 and name[1] == ":"):
        raise UnsafePath(name)
    return name


def walk(file, suffixes: tuple[str, ...] = (), content: bool = True, first: int = 0, last: int | None = None) -> Iterator[tuple[str, int, int, bytes | None]]:
    """(member, ordinal, size, content) of the regular files of an archive, given as a seekable file."""
    if zipfile.is_zipfile(file):
        file.seek(0)
        with zipfile.ZipFile(file) as z:
            for i, m in enumerate(z.infolist()[first:last], first):
                if not m.is_dir() and (not suffixes or m.filename.lower().endswith(suffixes)):
                    yield m.filename, i, m.file_size, z.read(m) if content else None
        return
    file.seek(0)
    with tarfile.open(fileobj=file, mode="r:*") as t:
        for i, m in enumerate(t):
            if m.isfile() and (not suffixes or m.name.lower().endswith(suffixes)):
                yield m.name, i, m.size, t.extractfile(m).read() if content else None


class _Range(InputPartition):
    def __init__(self, path: str, first: int, last: int | None):
        self.path, self.first, self.last = path, first, last


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"].removeprefix("file://")
        self.suffixes = tuple(s.strip().lower() for s in options.get("suffixes", "").split(",") if s.strip())
        self.content = options.get("content", "true").lower() != "false"
        self.members_a_task = int(options.get("members_a_task", "2000"))

    def partitions(self):
        paths = sorted(p for p in (glob.glob(self.path) or [self.path]) if os.path.isfile(p)) if not os.path.isdir(self.path) else sorted(os.path.join(self.path, x) for x in os.listdir(self.path))
        out = []
        for p in paths:
            if zipfile.is_zipfile(p):
                with zipfile.ZipFile(p) as z:
                    n = len(z.infolist())
                out += [_Range(p, i, i + self.members_a_task) for i in range(0, max(n, 1), self.members_a_task)]
            else:
                out.append(_Range(p, 0, None))
        return out

    def read(self, part):
        with open(part.path, "rb") as f:
            for member, ordinal, size, data in walk(f, self.suffixes, self.content, part.first, part.last):
                yield part.path, member, ordinal, size, data


class ArchiveSource(DataSource):
    @classmethod
    def name(cls):
        return "archive"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return ArchiveReader(dict(self.options))


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(ArchiveSource)


def members(spark: SparkSession, path: str, suffixes: tuple[str, ...] = (), content: bool = True) -> DataFrame:
    """The same rows, of archives that Spark's own reader loads from any store; an archive must fit in a task's memory."""
    ship(spark)

    def run(batches):
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for member, ordinal, size, body in walk(io.BytesIO(data), suffixes, content):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([member]), pa.array([ordinal], pa.int32()), pa.array([size], pa.int64()), pa.array([body], pa.binary())],
                        names=["archive", "member", "ordinal", "size", "content"],
                    )

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, SCHEMA)


def extensions(members: DataFrame, member: str = "member") -> DataFrame:
    """(extension, rows) over all members, most frequent first; '<none>' for names without one."""
    name = F.lower(F.substring_index(member, "/", -1))
    found = F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)
    kind = F.when(found != "", found).otherwise("<none>").alias("extension")
    return members.select(kind).groupBy("extension").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "extension")
