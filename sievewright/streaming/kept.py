"""Tables that a stream keeps up to date by writing what is new: a base, deltas and their compaction.

Each micro-batch writes one folder with its own rows, reduced to the last of each
key; nothing that is kept is rewritten. Every ``compact_every`` batches the base and
the deltas so far become the next base. A reader takes the newest base and the
deltas after it, so that it reads each key a bounded number of times. A batch that
runs again replaces its own folder and changes nothing; a folder counts only with
the mark that Spark sets when it is whole.

A query whose checkpoint is lost counts its batches from 0 again. It then writes to
a new epoch, after the folders of those before, and overwrites none of them. Folders
that a newer base replaces stay until ``vacuum``, for readers that are under way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.dedupe import latest


class KeptTable:
    """A table at ``path`` with one row a key, the last by ``order``; without a key, the last ``most`` rows of all."""

    def __init__(self, spark: SparkSession, path: str, key: str | None, order: list[str], most: int | None = None, compact_every: int = 16):
        if (key is None) == (most is None):
            raise ValueError("a table keeps the last row of each key or the last rows of all")
        self.spark, self.path, self.key, self.order, self.most, self.compact_every = spark, path.rstrip("/"), key, order, most, compact_every

    # folders are <path>/<epoch>-<batch>-<base|delta>; names of one width sort in the order of writing

    def _folder(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _files(self):
        return self._folder("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def folders(self) -> list[str]:
        """Names of whole folders in the order of writing; of a batch the delta comes before the base."""
        files, root = self._files(), self._folder("")
        if not files.exists(root):
            return []
        names = [x.getPath().getName() for x in files.listStatus(root)]
        known = [n for n in names if n.endswith(("-base", "-delta")) and files.exists(self._folder(f"{n}/_SUCCESS"))]
        return sorted(known, key=lambda n: (n[:-len(n.split("-")[2])], n.endswith("base")))

    def current(self) -> list[str]:
        """The newest base and the deltas after it."""
        names = self.folders()
        bases = [i for i, n in enumerate(names) if n.endswith("base")]
        return [n for n in names[bases[-1] if bases else 0 :] if n.endswith("delta")] + ([names[bases[-1]]] if bases else [])

    def _last(self, rows: DataFrame) -> DataFrame:
        if self.key is not None:
            return latest(rows, self.key, self.order).select(rows.columns)
        return rows.orderBy(*(F.desc(c) for c in self.order)).limit(self.most)

    def read(self) -> DataFrame | None:
        """The table as it is now; None before the first batch."""
        names = self.current()
        return self._last(self.spark.read.parquet(*(f"{self.path}/{n}" for n in names))) if names else None

    def epoch(self, fresh: bool) -> int:
        epochs = [int(n.split("-")[0]) for n in self.folders()]
        return max(epochs, default=-1) + 1 if fresh or not epochs else max(epochs)

    def merge(self, epoch: int) -> Callable[[DataFrame, int], None]:
        """What a query does with each micro-batch."""

        def write(batch: DataFrame, number: int) -> None:
            name = f"{epoch:06d}-{number:012d}"
            self._last(batch).write.mode("overwrite").parquet(f"{self.path}/{name}-delta")
            if number % self.compact_every == self.compact_every - 1:
                # a base of a batch that runs again is whole or is written anew from the same folders
                names = [n for n in self.current() if n != f"{name}-base"]
                if f"{name}-base" not in self.folders():
                    self._last(self.spark.read.parquet(*(f"{self.path}/{n}" for n in names))).write.mode("overwrite").parquet(f"{self.path}/{name}-base")

        return write

    def follow(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """A query over what is there that keeps the table up to date."""
        from .runs import over_what_is_there

        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/metadata")
        fresh = not where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
        writer = stream.writeStream.foreachBatch(self.merge(self.epoch(fresh))).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
        return over_what_is_there(writer.start, self.spark)

    def vacuum(self) -> int:
        """Removes folders that the newest base replaces; returns how many."""
        files, kept = self._files(), set(self.current())
        old = [n for n in self.folders() if n not in kept]
        for name in old:
            files.delete(self._folder(name), True)
        return len(old)
