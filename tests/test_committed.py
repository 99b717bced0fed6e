"""Committed lines: one commit a batch, replays, dead tasks, and streams that go on."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sievewright.sources import committed

SCHEMA = "id bigint, text string"


def ids(spark, path):
    return sorted(r.id for r in committed.read_committed(spark, path, SCHEMA).collect())


def frame(spark, low, high):
    return spark.range(low, high, 1, 3).select("id", F.when(F.col("id") % 2 == 0, F.lit('a\n"é')).alias("text"))


def test_batches_are_written_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert ids(spark, path) == []
    committed.append_committed(frame(spark, 0, 10), path, "q", 0)
    committed.append_committed(frame(spark, 10, 12), path, "q", 1)
    committed.append_committed(frame(spark, 0, 10), path, "q", 0)  # a repeat
    assert ids(spark, path) == list(range(12))
    committed.append_committed(frame(spark, 12, 13), path)
    committed.append_committed(frame(spark, 13, 13), path)
    assert ids(spark, path) == list(range(13))
    assert len(os.listdir(f"{path}/data")) == len(committed._Store(path).named())  # nothing is left beside
    assert {r.text for r in committed.read_committed(spark, path, SCHEMA).collect()} == {'a\n"é', None}


def test_a_failed_write_leaves_nothing_to_read(spark, tmp_path):
    path = str(tmp_path / "t")
    committed.append_committed(frame(spark, 0, 4), path, "q", 0)
    bad = spark.range(0, 40, 1, 4).select(F.when(F.col("id") == 39, F.raise_error(F.lit("dead"))).otherwise(F.col("id").cast("string")).alias("text"), "id")
    with pytest.raises(Exception, match="dead"):
        committed.append_committed(bad, path, "q", 1)
    assert ids(spark, path) == [0, 1, 2, 3]
    committed.append_committed(frame(spark, 4, 6), path, "q", 1)
    assert ids(spark, path) == list(range(6))
    with open(f"{path}/data/orphan.jsonl", "w") as out:
        out.write(json.dumps({"id": 99}) + "\n")
    assert ids(spark, path) == list(range(6)) and committed.sweep(path) == 0
    assert committed.sweep(path, 0) >= 1 and ids(spark, path) == list(range(6))
    assert not os.path.exists(f"{path}/data/orphan.jsonl")


def test_streams_go_on_and_replay(spark, tmp_path):
    src, path, checkpoint = (str(tmp_path / x) for x in ("src", "t", "c"))
    for low in (0, 10):
        frame(spark, low, low + 10).write.mode("append").parquet(src)
        stream = spark.readStream.schema(SCHEMA).parquet(src)
        committed.stream_committed(stream, path, checkpoint, "s").awaitTermination()
        assert ids(spark, path) == list(range(low + 10))
    # the last batch is committed to the sink, but its mark in the checkpoint is lost
    last = max(int(x) for x in os.listdir(f"{checkpoint}/commits") if x.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{name}"):
            os.remove(f"{checkpoint}/commits/{name}")
    committed.stream_committed(spark.readStream.schema(SCHEMA).parquet(src), path, checkpoint, "s").awaitTermination()
    assert ids(spark, path) == list(range(20))


def test_what_the_sink_refuses(spark, tmp_path):
    rows = frame(spark, 0, 1)
    with pytest.raises(Exception, match="only appended"):
        committed._lines(rows).write.format(committed.NAME).mode("overwrite").option("path", str(tmp_path)).save()
    with pytest.raises(Exception, match="one column"):
        committed._lines(rows)
        rows.write.format(committed.NAME).mode("append").option("path", str(tmp_path)).save()
    with pytest.raises(Exception, match="line feed"):
        rows.select(F.lit("a\nb").alias("value")).write.format(committed.NAME).mode("append").option("path", str(tmp_path)).save()
