"""A stream over files that grow: each line once, also those that are appended to a file already read.

Spark's file stream takes a file as a whole and never looks at it again. Here the
offset of a stream is, for each file, how far whole lines go and a hash of the
file's first bytes. A micro-batch reads the bytes between two offsets, a large
stretch in several tasks. A file that was cut, or that begins otherwise than
before, is another file under an old name and is read from its start. A line
counts once its line feed is written.

Offsets are all that is kept, in the query's checkpoint, so that a restart goes on
where the last batch ended. What a file loses before a batch has read it is lost.
Paths may be of any store that Arrow's filesystems open.
"""

from __future__ import annotations

import fnmatch
import hashlib
import posixpath
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NAME = "growing_lines"
SCHEMA = "path string, position bigint, value string"
#: First bytes of a file by which it is known again.
HEAD = 1024
#: Bytes that are read at once, and looked through from the end for a line feed.
STEP = 1 << 16


@dataclass
class Stretch(InputPartition):
    """Lines of a file that begin in ``start`` <= position < ``stop``; ``opens`` if a line begins at ``start``."""

    path: str
    start: int
    stop: int
    opens: bool


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace(":/", ":///", 1))


class _Files:
    """The files that a source follows."""

    def __init__(self, options: dict):
        self.root, self.pattern = options["path"], options.get("pattern", "*")
        self.newest = options.get("newest", "false").lower() == "true"
        self.chunk = int(options.get("chunkbytes", 64 << 20))
        self.store, self.base = _filesystem(self.root)

    def listed(self) -> list[fs.FileInfo]:
        """Files of the pattern at any depth, hidden ones left out; with ``newest`` the last changed one alone."""
        info = self.store.get_file_info(self.base)
        if info.type == fs.FileType.File:
            return [info]
        found = self.store.get_file_info(fs.FileSelector(self.base, allow_not_found=True, recursive=True))
        kept = [x for x in found if x.type == fs.FileType.File and fnmatch.fnmatch(x.base_name, self.pattern) and not self._hidden(x.path)]
        if self.newest and kept:
            kept = [max(kept, key=lambda x: (x.mtime_ns or 0, x.path))]
        return kept

    def _hidden(self, path: str) -> bool:
        return any(part[0] in "._" for part in posixpath.relpath(path, self.base).split("/"))

    def whole_lines(self, info: fs.FileInfo) -> int:
        """Bytes up to the last line feed."""
        with self.store.open_input_file(info.path) as file:
            end = info.size
            while end > 0:
                start = max(0, end - STEP)
                at = file.read_at(end - start, start).rfind(b"\n")
                if at >= 0:
                    return start + at + 1
                end = start
        return 0

    def head(self, path: str, n: int) -> str:
        with self.store.open_input_file(path) as file:
            return hashlib.sha256(file.read_at(n, 0)).hexdigest()

    def state(self, info: fs.FileInfo) -> dict:
        position = self.whole_lines(info)
        n = min(HEAD, position)
        return {"position": position, "head": n, "hash": self.head(info.path, n) if n else ""}

    def stretches(self, path: str, start: int, stop: int) -> Iterator[Stretch]:
        for low in range(start, stop, self.chunk):
            yield Stretch(path, low, min(low + self.chunk, stop), low == start)

    def read(self, part: Stretch) -> Iterator[tuple[str, int, str]]:
        """The stretch's lines; the last may go on beyond it, and the first belongs to the stretch before unless a line begins there."""
        with self.store.open_input_file(part.path) as file:
            at, rest = part.start, b""
            if not part.opens:  # from the byte before, so that a line that begins at the start is seen to begin
                at -= 1
            skip, begin = not part.opens, at
            while begin < part.stop:
                data = file.read_at(STEP, at)
                if not data:
                    return
                at += len(data)
                rest += data
                lines = rest.split(b"\n")
                rest = lines.pop()
                for line in lines:
                    if not skip:
                        yield part.path, begin, line.decode("utf-8", "replace").removesuffix("\r")
                    skip = False
                    begin += len(line) + 1
                    if begin >= part.stop:
                        return


class GrowingLines(DataSource):
    """``spark.readStream.format("growing_lines")``; options ``path``, ``pattern``, ``newest`` and ``chunkBytes``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _BatchReader(self.options)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _StreamReader(self.options)


class _BatchReader(DataSourceReader):
    """Whole lines as they are now."""

    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[Stretch]:
        files = _Files(self.options)
        return [part for info in files.listed() for part in files.stretches(info.path, 0, files.whole_lines(info))]

    def read(self, partition: Stretch) -> Iterator[tuple]:
        yield from _Files(self.options).read(partition) if partition is not None else ()


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        files = _Files(self.options)
        return {info.path: files.state(info) for info in files.listed()}

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        files = _Files(self.options)
        out: list[Stretch] = []
        for path, now in sorted(end.items()):
            before = start.get(path, {"position": 0, "head": 0, "hash": ""})
            grown = now["position"] >= before["position"] and self._same_head(files, path, before, now)
            out += files.stretches(path, before["position"] if grown else 0, now["position"])
        return out

    @staticmethod
    def _same_head(files: _Files, path: str, before: dict, now: dict) -> bool:
        if not before["head"]:
            return True
        if before["head"] == now["head"]:
            return before["hash"] == now["hash"]
        return files.head(path, before["head"]) == before["hash"]

    def read(self, partition: Stretch) -> Iterator[tuple]:
        yield from _Files(self.options).read(partition)

    def commit(self, end: dict) -> None:
        """Nothing is held beside the offsets."""


def registered(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(GrowingLines)
    return spark


def follow(spark: SparkSession, path: str, pattern: str = "*", newest: bool = False, chunk_bytes: int = 64 << 20) -> DataFrame:
    """(path, position, value) as a stream: the lines of files of a name at any depth, as they come.

    ``position`` is the byte at which a line begins, so lines of a file are ordered
    by it. With ``newest`` only the file that was changed last is followed.
    """
    reader = registered(spark).readStream.format(NAME).option("pattern", pattern).option("newest", str(newest).lower())
    return reader.option("chunkBytes", chunk_bytes).load(path)


def follow_json(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*", newest: bool = False) -> DataFrame:
    """(path, position, raw_line, ...) of the same: lines that aren't blank and hold JSON, with the schema's fields."""
    lines = follow(spark, path, pattern, newest).where((F.trim("value") != "") & F.try_parse_json("value").isNotNull())
    parsed = lines.select("path", "position", F.col("value").alias("raw_line"), F.from_json("value", schema).alias("x"))
    return parsed.select("path", "position", "raw_line", *(F.col("x")[f].alias(f) for f in schema.fieldNames()))
