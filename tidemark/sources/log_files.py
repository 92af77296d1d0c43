"""Logs of lines as a data source with offsets: whole or as a stream, large files in ranges of bytes.

A range has the lines whose line feeds lie in it, however long they are, so ranges can be cut anywhere: each line belongs to one of them, and the
end of a file at some moment is an offset even while a line is being written.
"""

from __future__ import annotations

import io
import posixpath
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

NAME, SCHEMA = "log_files", "file string, position long, value string"

#: Bytes that one task reads, bytes of a look into a file, and bytes of lines that are handed on together.
RANGE, LOOK, LOT = 64 << 20, 1 << 20, 4 << 20


@dataclass
class Range(InputPartition):
    """Bytes start to end of a file. rest: also the last line, if no line feed ends it."""

    file: str
    start: int
    end: int
    rest: bool = False


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    """Where a path lies: a plain one is local, s3a means s3."""
    if path.startswith("s3a:"):
        path = "s3:" + path[4:]
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (pafs.LocalFileSystem(), path)


def sizes(path: str) -> dict[str, int]:
    """{name: bytes} of the files in a folder, or of one file; hidden ones and those whose names begin with _ are no logs."""
    store, place = _opened(path)
    top = store.get_file_info(place)
    if top.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [top] if top.is_file else store.get_file_info(pafs.FileSelector(place, recursive=True))
    parts = lambda f: posixpath.relpath(f.path, place).split("/") if not top.is_file else [f.base_name]
    return {"/".join(parts(f)): f.size for f in found if f.is_file and not any(p[0] in "._" for p in parts(f))}


def cut(file: str, start: int, end: int, most: int, rest: bool = False) -> list[Range]:
    """Ranges of about `most` bytes."""
    at = list(range(start, end, most))
    return [Range(file, a, b, rest and b == end) for a, b in zip(at, [*at[1:], end])]


def _begin(data, at: int) -> int:
    """Where the line begins that holds the byte before `at`, or that begins there: after the last line feed before it."""
    while at > 0:
        low = max(0, at - LOOK)
        data.seek(low)
        found = data.read(at - low).rfind(b"\n")
        if found >= 0:
            return low + found + 1
        at = low
    return 0


def lines(data, r: Range) -> Iterator[tuple[int, bytes]]:
    """(place, line) of a range; only lines are held that end in it, one at a time."""
    at, first = r.start, None
    while at < r.end and first is None:
        data.seek(at)
        part = data.read(min(LOOK, r.end - at))
        found = part.find(b"\n")
        first = at + found if found >= 0 else None
        at += len(part) or r.end
    if first is None and not (r.rest and r.end > r.start):
        return
    begin = _begin(data, r.start)
    data.seek(begin)
    reader = io.BufferedReader(data, LOOK)
    while begin < r.end:
        line = reader.readline(r.end - begin)
        if not line.endswith(b"\n") and not (r.rest and line):
            return
        yield begin, line.rstrip(b"\n").removesuffix(b"\r")
        begin += len(line)


def _rows(path: str, r: Range | None) -> Iterator[pa.RecordBatch]:
    """The lines of a range; Spark asks for one that is None where there are none."""
    if r is None:
        return
    store, place = _opened(path)
    place = place if store.get_file_info(place).is_file else posixpath.join(place, r.file)

    def batch(held: list[tuple[int, str]]) -> pa.RecordBatch:
        columns = [pa.array([r.file] * len(held)), pa.array([p for p, _ in held], pa.int64()), pa.array([v for _, v in held], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["file", "position", "value"])

    with store.open_input_file(place) as data:
        held, size = [], 0
        for at, line in lines(data, r):
            held.append((at, line.decode("utf-8", "replace")))
            size += len(line) + 1
            if size >= LOT:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)


class _Batch(DataSourceReader):
    def __init__(self, path: str, most: int):
        self.path, self.most = path, most

    def partitions(self) -> list[Range]:
        return [r for file, size in sorted(sizes(self.path).items()) for r in cut(file, 0, size, self.most, rest=True)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _rows(self.path, partition)


class _Stream(DataSourceStreamReader):
    """Offsets are the sizes of the files when a batch is planned."""

    def __init__(self, path: str, most: int):
        self.path, self.most = path, most

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        return sizes(self.path)

    def partitions(self, start: dict, end: dict) -> list[Range]:
        shorter = [file for file, size in end.items() if size < start.get(file, 0)]
        if shorter:
            raise ValueError(f"logs have become shorter: {sorted(shorter)[:5]}")
        return [r for file, size in sorted(end.items()) for r in cut(file, start.get(file, 0), size, self.most)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _rows(self.path, partition)

    def commit(self, end: dict) -> None:
        pass


class LogFiles(DataSource):
    """(file, position, value): the lines of all logs under `path`; position is the byte where a line begins. Option rangeBytes: bytes a task."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def _how(self) -> tuple[str, int]:
        return self.options["path"], int(self.options.get("rangeBytes", RANGE))

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Batch(*self._how())

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return _Stream(*self._how())


def log_lines(spark: SparkSession, path: str, stream: bool = False, range_bytes: int = RANGE) -> DataFrame:
    """(position, value): the lines of the logs under a path, as tables.json_lines gives them; position is (file, byte), which also orders a file's ranges.

    As a stream each line is given once, when its line feed is there, over restarts too. A whole read also has a last line that nothing ends. Bytes
    that are not UTF-8 become the replacement character; a carriage return before a line feed goes. No files: no rows; no such path:
    an error, and so is a file that shrinks under a stream. The offset of a stream names every file, so old logs are to be moved away in time.
    """
    spark.dataSource.register(LogFiles)
    reader = spark.readStream if stream else spark.read
    rows = reader.format(NAME).option("rangeBytes", str(range_bytes)).option("path", path).load()
    return rows.select(F.struct("file", "position").alias("position"), "value")
