"""A change feed stored by version, as a Spark data source for batches and streams.

    register_change_feed(spark)
    spark.read.format("change_feed").option("startingVersion", 5).option("endingVersion", 9).load(folder)
    spark.readStream.format("change_feed").option("startingVersion", 5).load(folder)

``folder`` holds one folder ``_commit_version=<n>`` of Parquet files for each version: ``changes`` of a
``VersionedTable``, ``feed`` of a ``FeedHistory`` or the target of ``store_feed``.  Versions outside the bounds are
not listed into the scan.  Python only plans and hands on: Arrow batches go to Spark as they are
decoded, and a task holds one of them at a time.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from tidewell.operators.changes import CV

NAME = "change_feed"
SPLIT_BYTES = 128 << 20     # bytes of files in one task
BATCH_ROWS = 10_000
# the key under which Spark's Parquet writer keeps the schema of the rows (fixed value)
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


@dataclass
class Pieces(InputPartition):
    """What one task reads: (file, version, first byte, end) of each piece."""

    pieces: tuple

    def __init__(self, pieces):
        super().__init__(None)
        self.pieces = tuple(pieces)


class _Folder:
    """The versions of a feed: folder names and file sizes, from any file system that Arrow opens (mounted
    folders, HDFS, object stores)."""

    def __init__(self, path: str):
        self.fs, root = fs.FileSystem.from_uri(path)
        self.root = root.rstrip("/")

    def _names(self, path: str) -> list:
        return self.fs.get_file_info(fs.FileSelector(path, allow_not_found=True))

    def versions(self, first: int | None = None, last: int | None = None) -> list[int]:
        """Stored versions from ``first`` to ``last``, ascending."""
        found = [int(i.base_name.split("=")[1]) for i in self._names(self.root)
                 if i.type == fs.FileType.Directory and i.base_name.startswith(f"{CV}=") and i.base_name.split("=")[1].lstrip("-").isdigit()]
        return sorted(v for v in found if (first is None or v >= first) and (last is None or v <= last))

    def files(self, version: int) -> list[tuple[str, int]]:
        found = self._names(f"{self.root}/{CV}={version}")
        return sorted((i.path, i.size) for i in found
                      if i.type == fs.FileType.File and i.base_name.endswith(".parquet") and i.base_name[0] not in "._")

    def open(self, path: str) -> pq.ParquetFile:
        return pq.ParquetFile(self.fs.open_input_file(path), coerce_int96_timestamp_unit="us")

    def plan(self, versions: list[int], split: int) -> list[Pieces]:
        """Files cut into ranges of ``split`` bytes, small ones put together up to as many."""
        out, now, size = [], [], 0
        for v in versions:
            for path, length in self.files(v):
                for lo in range(0, max(length, 1), split):
                    hi = min(lo + split, length)
                    if now and size + hi - lo > split:
                        out.append(Pieces(now))
                        now, size = [], 0
                    now.append((path, v, lo, hi))
                    size += hi - lo
        return out + [Pieces(now)] if now else out

    def batches(self, schema: StructType, part: Pieces) -> Iterator[pa.RecordBatch]:
        """Rows of the row groups that begin inside the pieces, with the columns of ``schema``."""
        target = to_arrow_schema(schema)
        for path, version, lo, hi in part.pieces:
            file = self.open(path)
            meta = file.metadata
            groups = [g for g in range(meta.num_row_groups) if lo <= _start(meta.row_group(g)) < hi]
            have = set(file.schema_arrow.names)
            wanted = [f.name for f in target if f.name in have]
            for batch in file.iter_batches(BATCH_ROWS, groups, wanted) if groups else ():
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(version, f.type), n) if f.name == CV
                     else batch.column(f.name).cast(f.type) if f.name in have else pa.nulls(n, f.type) for f in target], schema=target)


def _start(group) -> int:
    """First byte of a row group."""
    c = group.column(0)
    return min(x for x in (c.dictionary_page_offset, c.data_page_offset) if x is not None)


def _bound(options: dict, name: str) -> int | None:
    text = options.get(name)
    if text is None:
        return None
    if not str(text).lstrip("-").isdigit():
        raise ValueError(f"{name} must be a version number, not {text!r}")
    return int(text)


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, source: "ChangeFeed"):
        self.rows, self.path, self.first, self.last, self.split = schema, source.path, source.first, source.last, source.split

    def partitions(self) -> list[Pieces]:
        folder = _Folder(self.path)
        # an empty list would make Spark ask for one partition without content
        return folder.plan(folder.versions(self.first, self.last), self.split) or [Pieces(())]

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        return _Folder(self.path).batches(self.rows, partition)


class _StreamReader(DataSourceStreamReader):
    """Offsets are versions: the last one that was read."""

    def __init__(self, schema: StructType, source: "ChangeFeed"):
        self.rows, self.path, self.first, self.last, self.split = schema, source.path, source.first, source.last, source.split

    def initialOffset(self) -> dict:
        first = self.first
        if first is None:
            first = min(_Folder(self.path).versions(), default=0)
        return {"version": first - 1}

    def latestOffset(self) -> dict:
        # before the first version there is nothing to read, and an offset must not move back
        return {"version": max(_Folder(self.path).versions(self.first, self.last), default=self.initialOffset()["version"])}

    def partitions(self, start: dict, end: dict) -> list[Pieces]:
        folder = _Folder(self.path)
        return folder.plan(folder.versions(start["version"] + 1, end["version"]), self.split)

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        return _Folder(self.path).batches(self.rows, partition)


class ChangeFeed(DataSource):
    """Format ``change_feed``; options ``startingVersion`` and ``endingVersion`` (both included, either may be
    absent) and ``splitBytes``.

    Without ``.schema(...)`` the columns are those of the newest stored version and ``_commit_version``; with it,
    only the named columns are decoded.  Columns that a version does not have are null in its rows.  A
    stream reads each version once, in micro-batches of whole versions; versions must appear in ascending order,
    as commits publish them.  A folder without versions needs a schema and gives no rows.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def __init__(self, options):
        super().__init__(options)
        if "path" not in options:
            raise ValueError("change_feed needs the folder of the versions: load(folder)")
        self.path = options["path"]
        self.first, self.last = _bound(options, "startingVersion"), _bound(options, "endingVersion")
        self.split = _bound(options, "splitBytes") or SPLIT_BYTES

    def schema(self) -> StructType:
        folder = _Folder(self.path)
        for v in reversed(folder.versions()):
            for path, _ in folder.files(v):
                arrow = folder.open(path).schema_arrow
                kept = (arrow.metadata or {}).get(SPARK_SCHEMA)
                rows = StructType.fromJson(json.loads(kept)) if kept else from_arrow_schema(arrow)
                return StructType([StructField(f.name, f.dataType, True) for f in rows if f.name != CV] + [StructField(CV, LongType())])
        raise ValueError(f"{self.path} holds no version to take the columns from; name them with schema()")

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(schema, self)

    def streamReader(self, schema: StructType) -> _StreamReader:
        return _StreamReader(schema, self)


def register_change_feed(spark: SparkSession) -> None:
    """Makes the format known to the session."""
    spark.dataSource.register(ChangeFeed)
