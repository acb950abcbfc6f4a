"""Capture files: many datagrams in one file, read in parallel and followed as they grow.

A frame is a marker, the arrival time in microseconds, the payload's length, a checksum and the
payload.  The checksum covers the frame's place in the file too, so that a payload which itself
holds frames is not mistaken for them.  A task reads the frames that begin in its range of bytes:
it looks for the first sound one, and does so again behind anything damaged or cut.

A stream remembers for each file where its last whole frame ends, one entry a file, so captures
are meant to be few and large.  Files are reached through Arrow's file systems: local paths and
``file:``, ``hdfs:`` and ``s3:`` addresses.  A write gives one file per task, which appears under
its name once the whole write has succeeded.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage,
)
from pyspark.sql.types import StructType

MARKER = b"\xf1\x25PKT\r\n\x00"
_HEAD = struct.Struct("<8sqII")  # marker, time, length, checksum
_SEALED = struct.Struct("<qqI")  # place, time, length
SUFFIX = ".capture"
#: A UDP datagram is no longer.
MAX_PAYLOAD = 1 << 16
SPLIT_BYTES = 1 << 26
_READ_BYTES = 1 << 22
_BATCH_FRAMES = 4096

SCHEMA = "source STRING, offset BIGINT, timestamp TIMESTAMP, payload BINARY"
_ARROW = pa.schema([
    ("source", pa.string()), ("offset", pa.int64()), ("timestamp", pa.timestamp("us", "UTC")), ("payload", pa.binary()),
])


def _checksum(place: int, time: int, payload: bytes) -> int:
    return zlib.crc32(payload, zlib.crc32(_SEALED.pack(place, time, len(payload))))


def frame(place: int, time: int, payload: bytes) -> bytes:
    """The bytes of a datagram at ``place`` of a capture file."""
    if len(payload) > MAX_PAYLOAD:
        raise ValueError(f"a payload of {len(payload)} bytes is no datagram")
    return _HEAD.pack(MARKER, time, len(payload), _checksum(place, time, payload)) + payload


class _Bytes:
    """Any stretch of a file, read in large pieces."""

    def __init__(self, file):
        self.file, self.base, self.held = file, 0, b""

    def at(self, place: int, size: int) -> bytes:
        low = place - self.base
        if low < 0 or low + size > len(self.held):
            self.file.seek(place)
            self.base, self.held, low = place, self.file.read(max(size, _READ_BYTES)), 0
        return self.held[low : low + size]

    def next_marker(self, place: int, end: int) -> int:
        """First place of a marker from ``place`` on; ``end`` or beyond if there is none before."""
        while place < end:
            piece = self.at(place, _READ_BYTES)
            found = piece.find(MARKER)
            if found >= 0:
                return place + found
            if len(piece) < len(MARKER):
                return end
            place += len(piece) - len(MARKER) + 1
        return place


def frames(file, start: int, end: int) -> Iterator[tuple[int, int, bytes]]:
    """(place, time, payload) of the sound frames that begin in ``[start, end)``."""
    source, place = _Bytes(file), start
    while place < end:
        head = source.at(place, _HEAD.size)
        if len(head) == _HEAD.size and head.startswith(MARKER):
            _, time, size, checksum = _HEAD.unpack(head)
            payload = source.at(place + _HEAD.size, size) if size <= MAX_PAYLOAD else b""
            if len(payload) == size and checksum == _checksum(place, time, payload):
                yield place, time, payload
                place += _HEAD.size + size
                continue
        place = source.next_marker(place + 1, end)


def whole_end(file, size: int, known: int) -> int:
    """Where the last whole frame of the first ``size`` bytes ends; ``known`` if none does behind it."""
    reach = 2 * (_HEAD.size + MAX_PAYLOAD)
    while True:
        start = max(known, size - reach)
        ends = [p + _HEAD.size + len(payload) for p, _, payload in frames(file, start, size)]
        ends = [e for e in ends if e <= size]
        if ends or start == known:
            return max([known, *ends])
        reach *= 2  # a long damaged stretch


def _located(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def _files(path: str) -> list[tuple[str, int]]:
    """(path, size) of a capture file, or of all capture files in a folder."""
    system, inner = _located(path)
    info = system.get_file_info(inner)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    return sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.base_name.endswith(SUFFIX))


@dataclass
class Range(InputPartition):
    """The frames of ``file`` that begin in ``[start, end)``."""

    file: str
    start: int
    end: int


def _ranges(file: str, start: int, end: int, split: int) -> list[Range]:
    return [Range(file, low, min(end, low + split)) for low in range(start, end, split)]


def _read(path: str, part: Range) -> Iterator[pa.RecordBatch]:
    system, _ = _located(path)
    rows: list[tuple[int, int, bytes]] = []

    def batch() -> pa.RecordBatch:
        places, times, payloads = zip(*rows)
        columns = [[part.file] * len(rows), places, pa.array(times).cast(pa.timestamp("us", "UTC")), payloads]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)

    with system.open_input_file(part.file) as file:
        for found in frames(file, part.start, part.end):
            rows.append(found)
            if len(rows) == _BATCH_FRAMES:
                yield batch()
                rows.clear()
    if rows:
        yield batch()


class _Reader(DataSourceReader):
    def __init__(self, path: str, split: int):
        self.path, self.split = path, split

    def partitions(self) -> Sequence[Range]:
        return [r for file, size in _files(self.path) for r in _ranges(file, 0, size, self.split)] or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition) if partition.file else iter(())


class _StreamReader(DataSourceStreamReader):
    def __init__(self, path: str, split: int):
        self.path, self.split, self.known = path, split, {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        system, _ = _located(self.path)
        for name, size in _files(self.path):
            before = self.known.get(name, 0)
            if size > before:
                with system.open_input_file(name) as file:
                    self.known[name] = whole_end(file, size, before)
        return dict(self.known)

    def partitions(self, start: dict, end: dict) -> Sequence[Range]:
        return [r for file in sorted(end) for r in _ranges(file, start.get(file, 0), end[file], self.split)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition)

    def commit(self, end: dict) -> None:
        pass


@dataclass
class _Written(WriterCommitMessage):
    unfinished: str | None
    finished: str | None


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        system, folder = _located(self.path)
        name = f"part-{uuid.uuid4().hex}{SUFFIX}"
        unfinished, place = f"{folder}/.{name}.unfinished", 0
        rows = (row for batch in iterator for row in zip(
            batch.column("timestamp").cast(pa.int64()).to_pylist(), batch.column("payload").to_pylist()))
        first = next(rows, None)
        if first is None:
            return _Written(None, None)
        system.create_dir(folder, recursive=True)
        with system.open_output_stream(unfinished) as file:
            row = first
            while row is not None:
                packed = frame(place, row[0] or 0, row[1] or b"")
                file.write(packed)
                place += len(packed)
                row = next(rows, None)
        return _Written(unfinished, f"{folder}/{name}")

    def commit(self, messages) -> None:
        system, _ = _located(self.path)
        for message in messages:
            if message is not None and message.unfinished:
                system.move(message.unfinished, message.finished)

    def abort(self, messages) -> None:
        system, _ = _located(self.path)
        for message in messages:
            if message is not None and message.unfinished:
                system.delete_file(message.unfinished)


class CaptureSource(DataSource):
    """Format ``capture``: options ``path`` (a file or folder) and ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return "capture"

    def schema(self) -> str:
        return SCHEMA

    def _split(self) -> int:
        return int(self.options.get("splitBytes", SPLIT_BYTES))

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], self._split())

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(self.options["path"], self._split())

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("captures are only appended to")
        return _Writer(self.options["path"])


def read(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """All datagrams of a capture file or folder; large files are read by several tasks."""
    spark.dataSource.register(CaptureSource)
    return spark.read.format("capture").option("splitBytes", split_bytes).load(path)


def read_stream(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Datagrams as files are added and grow; a restart goes on where the checkpoint is."""
    spark.dataSource.register(CaptureSource)
    return spark.readStream.format("capture").option("splitBytes", split_bytes).load(path)


def write(datagrams: DataFrame, path: str) -> None:
    """Add datagrams (``timestamp``, ``payload``) as capture files; a NULL time is the epoch."""
    datagrams.sparkSession.dataSource.register(CaptureSource)
    datagrams.select("timestamp", "payload").write.format("capture").mode("append").save(path)
