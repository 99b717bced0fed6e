"""What the operators of this subpackage share on the driver."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Where no checkpoint folder is set (a local session, as in tests) a
    temporary folder is made and set; on a cluster the setting has to be there.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return sc._jsc.sc().getCheckpointDir().get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
    sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get()


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: short lineage, and it outlives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    return read_again(df.sparkSession, path, df.schema)


def read_again(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table at ``path``, which ``discard`` can remove."""
    found = spark.read.schema(schema).parquet(path)
    found.written_to = path
    return found


def discard(df: DataFrame) -> None:
    """Removes a written table that nothing lazy reads any more."""
    sc = df.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(df.written_to)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of rows that go to Python at once within ``small_batches``.
BATCH_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is run within sends rows to Python by BATCH_BYTES, as batches lie outside of the heap and are held several times on their way."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of tables that are written: it does so once the driver has collected its garbage, which may take half an hour."""
    for _ in range(2):  # what the first round frees still names the files
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A number for each id and text, null ones too: rows that share it are repeats of one document."""
    return F.xxhash64(F.col(id_col), F.col(text_col).cast("string"))


def host_key(column: Column) -> Column:
    """A text key that keeps null apart from every string."""
    return F.when(column.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), column))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 50_000) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows or more, from sorted batches, that no group of equal keys crosses."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        table = pa.Table.from_batches(held)
        last = np.ones(n, bool)
        for key in keys:
            column = table[key].combine_chunks().to_numpy()
            last &= column == column[-1]
        cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        if cut:
            yield table.slice(0, cut)
        held, n = table.slice(cut).combine_chunks().to_batches(), n - cut
    if n:
        yield pa.Table.from_batches(held)
