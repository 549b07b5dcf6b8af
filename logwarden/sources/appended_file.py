"""Streaming source over files that only grow: whole new lines past an offset.

The offset is ``{path: bytes}`` and lives in the query's checkpoint. Offsets are
counted in bytes and always sit just after a newline; a partial last line waits
for the next batch, and a file shorter than its offset is read again from 0.
"""

from __future__ import annotations

import glob
import json
import os
from dataclasses import dataclass

from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

_TAIL_BLOCK = 64 * 1024
#: Tasks that a micro-batch is cut into before short ranges share one.
MOST_TASKS = 256
#: Bytes of the ranges that share a task.
TASK_BYTES = 64 * 1024 * 1024


@dataclass
class ByteRange:
    path: str
    start: int
    end: int


@dataclass
class ByteRanges(InputPartition):
    """The ranges that one task reads, one after the other."""

    ranges: list[ByteRange]


def _dealt(ranges: list[ByteRange], range_bytes: int) -> list[ByteRanges]:
    """Short ranges share tasks, as a task costs more than a range."""
    each = max(1, min(-(-len(ranges) // MOST_TASKS), TASK_BYTES // range_bytes))
    return [ByteRanges(ranges[at : at + each]) for at in range(0, len(ranges), each)]


def _last_line_end(path: str, floor: int) -> int:
    """Position after the last newline at or beyond ``floor``."""
    size = os.path.getsize(path)
    with open(path, "rb") as f:
        at = size
        while at > floor:
            begin = max(floor, at - _TAIL_BLOCK)
            f.seek(begin)
            newline = f.read(at - begin).rfind(b"\n")
            if newline >= 0:
                return begin + newline + 1
            at = begin
    return floor


class AppendedFileReader(DataSourceStreamReader):
    def __init__(self, options):
        self.pattern = options["path"]
        self.range_bytes = int(options.get("rangeBytes", 64 * 1024 * 1024))
        self.start = json.loads(options.get("startOffsets", "{}"))

    def _files(self) -> list[str]:
        return sorted(p for p in glob.glob(self.pattern) if os.path.isfile(p))

    def initialOffset(self) -> dict:
        return self.start

    def latestOffset(self) -> dict:
        return {path: _last_line_end(path, 0) for path in self._files()}

    def partitions(self, start: dict, end: dict):
        ranges = []
        for path, stop in sorted(end.items()):
            begin = start.get(path, 0)
            if begin > stop:
                begin = 0
            while begin < stop:
                cut = min(stop, begin + self.range_bytes)
                ranges.append(ByteRange(path, begin, cut))
                begin = cut
        return _dealt(ranges, self.range_bytes)

    def read(self, partition: ByteRanges):
        """Lines that start inside a range (its last may end beyond it)."""
        for part in partition.ranges:
            yield from self._lines(part)

    def _lines(self, part: ByteRange):
        with open(part.path, "rb") as f:
            at = 0
            if part.start > 0:
                f.seek(part.start - 1)
                at = part.start - 1 + len(f.readline())
            while at < part.end:
                line = f.readline()
                at += len(line)
                if not line.endswith(b"\n"):
                    break
                text = line.decode("utf-8", "replace").rstrip("\r\n")
                if text.strip():
                    yield (text,)


class AppendedFileBatchReader(DataSourceReader):
    """The whole lines up to ``endOffsets``; all of them by default."""

    def __init__(self, options):
        self.stream = AppendedFileReader(options)
        self.end = json.loads(options["endOffsets"]) if "endOffsets" in options else None

    def partitions(self):
        end = self.stream.latestOffset() if self.end is None else self.end
        return self.stream.partitions({}, end) or [ByteRanges([])]

    def read(self, partition: ByteRanges):
        return self.stream.read(partition)


class AppendedFileSource(DataSource):
    """Column ``value`` of ``spark.readStream`` or ``spark.read``, format ``appended_file``."""

    @classmethod
    def name(cls) -> str:
        return "appended_file"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> AppendedFileReader:
        return AppendedFileReader(self.options)

    def reader(self, schema) -> AppendedFileBatchReader:
        return AppendedFileBatchReader(self.options)


def current_offsets(pattern: str) -> dict[str, int]:
    """End of the last whole line of every matching file, as a start position."""
    return AppendedFileReader({"path": pattern}).latestOffset()


def read_appended_file(
    spark, pattern: str, range_bytes: int | None = None, start: dict[str, int] | None = None
):
    """Column ``value``. ``start`` counts only for a query without a checkpoint yet."""
    spark.dataSource.register(AppendedFileSource)
    reader = spark.readStream.format("appended_file").option("path", pattern)
    if range_bytes:
        reader = reader.option("rangeBytes", str(range_bytes))
    if start:
        reader = reader.option("startOffsets", json.dumps(start))
    return reader.load()


def read_lines_up_to(spark, pattern: str, end: dict[str, int], range_bytes: int | None = None):
    """Column ``value``: the whole lines that lie before the offsets ``end``."""
    spark.dataSource.register(AppendedFileSource)
    reader = spark.read.format("appended_file").option("path", pattern)
    if range_bytes:
        reader = reader.option("rangeBytes", str(range_bytes))
    return reader.option("endOffsets", json.dumps(end)).load()
