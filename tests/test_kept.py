"""Kept tables: what a batch writes, what a replay and a lost checkpoint do."""

import pytest
from pyspark.sql import functions as F

from sievewright.streaming.kept import KeptTable

SCHEMA = "run_id string, seq bigint, status string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def state(table):
    return {r.run_id: (r.seq, r.status) for r in table.read().collect()}


def test_batches_write_their_own_keys(spark, tmp_path):
    table = KeptTable(spark, str(tmp_path / "t"), "run_id", ["seq"], compact_every=3)
    assert table.read() is None
    write = table.merge(table.epoch(True))
    want = {}
    for number in range(8):
        rows = [(f"r{i % 4}", 10 * number + i, f"s{number}") for i in range(number % 3 + 1)]
        write(frame(spark, rows + rows[:1]), number)
        want |= {r[0]: r[1:] for r in rows}
        assert state(table) == want
        assert spark.read.parquet(f"{tmp_path}/t/{0:06d}-{number:012d}-delta").count() == len({r[0] for r in rows})
        before = table.folders()
        write(frame(spark, rows), number)
        assert state(table) == want and table.folders() == before
    assert len(table.current()) == 3  # a base and two deltas
    assert table.vacuum() == 7 and state(table) == want and table.vacuum() == 0


def test_late_rows_do_not_win(spark, tmp_path):
    table = KeptTable(spark, str(tmp_path / "t"), "run_id", ["seq"])
    write = table.merge(0)
    write(frame(spark, [("a", 5, "new")]), 0)
    write(frame(spark, [("a", 3, "old"), (None, 1, "x")]), 1)
    assert state(table) == {"a": (5, "new"), None: (1, "x")}


def test_the_last_rows_of_all(spark, tmp_path):
    table = KeptTable(spark, str(tmp_path / "t"), None, ["seq"], most=5, compact_every=2)
    write = table.merge(0)
    for number in range(5):
        write(frame(spark, [("r", 3 * number + i, "s") for i in range(3)]), number)
        assert sorted(r.seq for r in table.read().collect()) == list(range(max(0, 3 * number - 2), 3 * number + 3))
    with pytest.raises(ValueError):
        KeptTable(spark, "x", "k", ["seq"], most=1)


def test_streams_and_a_lost_checkpoint(spark, tmp_path):
    table = KeptTable(spark, str(tmp_path / "t"), "run_id", ["seq"], compact_every=2)

    def run(part, checkpoint):
        frame(spark, part).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        table.follow(stream, str(tmp_path / checkpoint)).awaitTermination(90)

    run([("a", 1, "x"), ("b", 1, "x")], "c1")
    run([("a", 2, "y")], "c1")
    assert state(table) == {"a": (2, "y"), "b": (1, "x")}
    spark.createDataFrame([("kept", 9, "k")], SCHEMA).write.parquet(f"{tmp_path}/t/{0:06d}-{999:012d}-delta")
    run([("a", 3, "z")], "c2")
    assert state(table) == {"a": (3, "z"), "b": (1, "x"), "kept": (9, "k")}
    assert {n.split("-")[0] for n in table.folders()} == {"000000", "000001"}
    assert table.read().where(F.col("run_id") == "kept").count() == 1
