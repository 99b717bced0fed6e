"""JSON lines in committed files: a reader sees all lines of a batch or none, and each batch once.

Each task writes a file of its own under ``data``. When all tasks are done, one
small manifest that names their files is written beside and renamed to
``commits/<query>-<batch>.json``: that rename is the commit. Files that no
manifest names don't count, so a task that died, ran twice or was given up
leaves neither a gap nor a repeat. A batch that is committed again (a stream
that goes on from its checkpoint) finds its manifest, drops its new files and
changes nothing.

``query`` is the name under which a stream's batches count, and has to stay with
its checkpoint: a stream that begins anew takes another name. A write without a
batch number is a batch of its own. Values hold no line feed; JSON text doesn't.
Paths may be of any store that Arrow's filesystems open and whose rename is atomic.
"""

from __future__ import annotations

import json
import posixpath
import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming.query import StreamingQuery

from .tail import _filesystem

NAME = "committed_lines"
DATA, COMMITS = "data", "commits"


@dataclass
class Written(WriterCommitMessage):
    """A file that a task has written in full, and its lines."""

    name: str
    lines: int


class _Store:
    """The files of a sink."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.files, self.root = _filesystem(self.path)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        """One file; a null value is no line."""
        name, lines = f"{uuid.uuid4().hex}.jsonl", 0
        self.files.create_dir(f"{self.root}/{DATA}", recursive=True)
        with self.files.open_output_stream(f"{self.root}/{DATA}/{name}") as out:
            for batch in batches:
                values = [v for v in batch.column("value").to_pylist() if v is not None]
                if any("\n" in v for v in values):
                    raise ValueError("a line holds a line feed")
                out.write("".join(v + "\n" for v in values).encode())
                lines += len(values)
        return Written(name, lines)

    def commit(self, label: str, messages: list[Written]) -> bool:
        """Names the files of a batch; False if the batch was committed before."""
        target = f"{self.root}/{COMMITS}/{label}.json"
        if self.files.get_file_info(target).type != fs.FileType.NotFound:
            self.drop([m.name for m in messages])
            return False
        self.files.create_dir(f"{self.root}/{COMMITS}", recursive=True)
        fresh = f"{self.root}/{COMMITS}/.{uuid.uuid4().hex}"
        with self.files.open_output_stream(fresh) as out:
            out.write(json.dumps({"files": [{"name": m.name, "lines": m.lines} for m in messages if m.lines]}).encode())
        self.files.move(fresh, target)
        self.drop([m.name for m in messages if not m.lines])
        return True

    def drop(self, names: list[str]) -> None:
        for name in names:
            self.files.delete_file(f"{self.root}/{DATA}/{name}")

    def _listed(self, folder: str) -> list[fs.FileInfo]:
        return self.files.get_file_info(fs.FileSelector(f"{self.root}/{folder}", allow_not_found=True))

    def named(self) -> list[str]:
        """Files of all manifests."""
        out: list[str] = []
        for info in sorted(self._listed(COMMITS), key=lambda x: x.base_name):
            if not info.base_name.startswith("."):
                with self.files.open_input_file(info.path) as file:
                    out += [x["name"] for x in json.loads(file.read())["files"]]
        return out

    def sweep(self, older: float) -> int:
        """Deletes files that no manifest names and that are older than so many seconds; returns how many."""
        known, limit = set(self.named()), (time.time() - older) * 1e9
        lost = [x.base_name for x in self._listed(DATA) if x.base_name not in known and (x.mtime_ns or 0) <= limit]
        self.drop(lost)
        return len(lost)


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.label = options["path"], f"{options.get('query') or 'write'}-{int(options['batch']):012d}" if "batch" in options else f"write-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return _Store(self.path).write(iterator)

    def commit(self, messages: list[Written | None]) -> None:
        _Store(self.path).commit(self.label, [m for m in messages if m is not None])

    def abort(self, messages: list[Written | None]) -> None:
        _Store(self.path).drop([m.name for m in messages if m is not None])


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict):
        self.path, self.query = options["path"], options["query"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return _Store(self.path).write(iterator)

    def commit(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        _Store(self.path).commit(f"{self.query}-{batchId:012d}", [m for m in messages if m is not None])

    def abort(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        _Store(self.path).drop([m.name for m in messages if m is not None])


class CommittedLines(DataSource):
    """``write.format("committed_lines")`` and ``writeStream``; options ``path``, ``query`` and, for single batches, ``batch``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "value string"

    def writer(self, schema: T.StructType, overwrite: bool) -> _Writer:
        return _Writer(dict(self._checked(schema, overwrite)))

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> _StreamWriter:
        return _StreamWriter(dict(self._checked(schema, overwrite)))

    def _checked(self, schema: T.StructType, overwrite: bool) -> dict:
        if schema.names != ["value"] or not isinstance(schema[0].dataType, T.StringType):
            raise ValueError("the sink takes one column, value string")
        if overwrite:
            raise ValueError("committed lines are only appended")
        if not re.fullmatch(r"[\w.]*", self.options.get("query", "")):
            raise ValueError("a query's name is of letters, digits, _ and .")
        return self.options


def _lines(rows: DataFrame) -> DataFrame:
    rows.sparkSession.dataSource.register(CommittedLines)
    return rows.select(F.to_json(F.struct(*(F.col(f"`{c}`") for c in rows.columns)), {"ignoreNullFields": "false"}).alias("value"))


def append_committed(rows: DataFrame, path: str, query: str = "write", batch: int | None = None) -> None:
    """Rows appended as one commit; with a batch number, once however often it is called."""
    writer = _lines(rows).write.format(NAME).mode("append").option("path", path).option("query", query)
    (writer if batch is None else writer.option("batch", batch)).save()


def stream_committed(rows: DataFrame, path: str, checkpoint: str, query: str) -> StreamingQuery:
    """A stream appended in one commit a micro-batch, until what is there is read; returns the query."""
    writer = _lines(rows).writeStream.format(NAME).outputMode("append").option("path", path).option("query", query)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_committed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of the commits up to now; no commit, no rows."""
    store = _Store(path)
    names = store.named()
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json([posixpath.join(store.path, DATA, n) for n in names])


def sweep(path: str, older_seconds: float = 7 * 86_400) -> int:
    """Deletes what tasks left that died, once it is so old that no write under way can still name it; returns the number of files."""
    return _Store(path).sweep(older_seconds)
