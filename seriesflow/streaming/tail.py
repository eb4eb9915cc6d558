"""Live text tail (A10): a streaming source of lines appended to files, by byte offsets.

Every file of a folder may grow while the stream runs. An offset is, for each
file, the byte after its last whole line; a batch reads the bytes between two
offsets, in parts of ``PART_BYTES`` that begin and end at lines. A line is read
when its newline has arrived, once: a restarted query goes on from the offset
in its checkpoint, and a part that is read again gives the same rows. Files are
read through Arrow's file systems, so the folder may be local, HDFS or an object store; no port is opened.
"""

from __future__ import annotations

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from seriesflow.functions.text import decode_line

PART_BYTES, BLOCK = 16 << 20, 1 << 16
FORMAT = "seriesflow_line_tail"


class Part(InputPartition):
    """The lines of a file that begin in [low, high)."""

    def __init__(self, path: str, low: int, high: int):
        super().__init__((path, low, high))
        self.path, self.low, self.high = path, low, high


class LineTailReader(DataSourceStreamReader):
    def __init__(self, path: str, part_bytes: int):
        self.uri, self.part_bytes, self.known = path if "://" in path else f"file://{path}", part_bytes, {}

    def _folder(self):
        return pafs.FileSystem.from_uri(self.uri)

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Of each file the byte after its last newline."""
        system, folder = self._folder()
        out = {}
        for info in system.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
            if info.type == pafs.FileType.File and not info.base_name.startswith((".", "_")):
                end = self._whole_lines(system, info.path, info.size, self.known.get(info.base_name, 0))
                if end:
                    out[info.base_name] = self.known[info.base_name] = end
        return out

    @staticmethod
    def _whole_lines(system, path: str, size: int, known: int) -> int:
        with system.open_input_file(path) as f:
            high = size
            while high > known:
                low = max(known, high - BLOCK)
                f.seek(low)
                at = f.read(high - low).rfind(b"\n")
                if at >= 0:
                    return low + at + 1
                high = low
        return known

    def partitions(self, start: dict, end: dict) -> list[Part]:
        return [Part(name, low, min(low + self.part_bytes, high)) for name, high in sorted(end.items())
                for low in range(start.get(name, 0), high, self.part_bytes)]

    def read(self, part: Part):
        """Batches of (file, position, raw); a line belongs to the part where it begins."""
        system, folder = self._folder()
        with system.open_input_file(f"{folder}/{part.path}") as f:
            at, rest = part.low, b""
            if at:  # the line that goes on here belongs to the part before
                f.seek(at - 1)
                before = f.read(1)
                while before != b"\n":
                    block = f.read(BLOCK)
                    cut = block.find(b"\n")
                    at += len(block) if cut < 0 else cut + 1
                    before = b"\n" if cut >= 0 or not block else b""
            f.seek(at)
            while at < part.high:
                block = f.read(BLOCK)
                if not block:
                    return
                lines = (rest + block).split(b"\n")
                rest = lines.pop()
                places, raws = [], []
                for line in lines:
                    if at >= part.high:
                        break
                    places.append(at)
                    raws.append(line)
                    at += len(line) + 1
                if raws:
                    yield pa.RecordBatch.from_arrays([pa.array([part.path] * len(raws)), pa.array(places, pa.int64()), pa.array(raws, pa.binary())],
                                                     names=["file", "position", "raw"])


class LineTail(DataSource):
    """``spark.readStream.format(FORMAT).load(folder)``: file, position, raw."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "file string, position bigint, raw binary"

    def streamReader(self, schema) -> LineTailReader:
        return LineTailReader(self.options["path"], int(self.options.get("part_bytes", PART_BYTES)))


def read_text_stream(spark: SparkSession, path: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """A10 for raw text files that grow: one row a line, decoded and stripped (G1), the device being the file's
    name, ``seq`` the line's place in it, and the event time its arrival."""
    spark.dataSource.register(LineTail)
    raw = spark.readStream.format(FORMAT).option("part_bytes", part_bytes).load(path)
    return raw.select(F.col("file").alias("device"), F.current_timestamp().alias("event_ts"), F.col("position").alias("seq"), decode_line("raw").alias("line"))
