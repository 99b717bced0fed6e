"""Files that grow, are cut or replaced, and queries that start again."""

import pytest
from pyspark.sql import functions as F

from sievewright import schemas as S
from sievewright.sources import tail


@pytest.fixture
def run(spark, tmp_path):
    """Runs the stream over what is there and gives the values of all batches so far."""

    def go(folder, name="q", **options):
        out = str(tmp_path / f"{name}-out")
        stream = tail.follow(spark, str(folder), **options)
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / f"{name}-check")).trigger(availableNow=True).start()
        query.awaitTermination(120)
        return [r.value for r in spark.read.schema(tail.SCHEMA).parquet(out).orderBy("path", "position", "value").collect()]

    return go


def test_appended_lines_come_once(run, tmp_path):
    logs = tmp_path / "logs"
    (logs / "r1").mkdir(parents=True)
    file = logs / "r1" / "events.jsonl"
    file.write_text("a\nb\n")
    assert run(logs) == ["a", "b"]
    assert run(logs) == ["a", "b"]
    with file.open("a") as f:
        f.write("c\nhal")
    assert run(logs) == ["a", "b", "c"]
    with file.open("a") as f:
        f.write("f\n\n")
    (logs / "r2").mkdir()
    (logs / "r2" / "events.jsonl").write_text("z\n")
    assert run(logs) == ["a", "b", "c", "half", "", "z"]


def test_a_cut_or_replaced_file_starts_over(run, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    file = logs / "e"
    file.write_text("one\ntwo\nthree\n")
    assert run(logs) == ["one", "two", "three"]
    file.write_text("one\n")
    assert sorted(run(logs)) == ["one", "one", "three", "two"]
    file.write_text("other\nlines\nand more of them\n")
    assert sorted(run(logs)) == sorted(["one", "one", "two", "three", "other", "lines", "and more of them"])
    file.unlink()
    assert len(run(logs)) == 7


def test_newest_file_and_pattern(run, tmp_path):
    import os

    logs = tmp_path / "logs"
    logs.mkdir()
    for i, name in enumerate(("a.log", "b.log", "c.txt", "_hidden.log")):
        (logs / name).write_text(f"{name}\n")
        os.utime(logs / name, (1_000_000 + i, 1_000_000 + i))
    assert run(logs, pattern="*.log", newest=True) == ["b.log"]
    os.utime(logs / "a.log", (2_000_000, 2_000_000))
    assert run(logs, pattern="*.log", newest=True) == ["a.log", "b.log"]
    assert run(logs, "all", pattern="*.log") == ["a.log", "b.log"]
    assert run(tmp_path / "none", "none") == []


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 64, 10_000])
def test_stretches_of_any_size(spark, tmp_path, chunk):
    """Lines lie whole in one stretch, wherever it is cut."""
    lines = ["", "é", "x" * 9, "\r", "", "日本", "end\r", "y" * 200]
    (tmp_path / "f").write_bytes("".join(x + "\n" for x in lines).encode() + b"no line feed")
    rows = tail.registered(spark).read.format(tail.NAME).option("chunkBytes", chunk).load(str(tmp_path / "f")).orderBy("position").collect()
    assert [r.value for r in rows] == [x.removesuffix("\r") for x in lines]
    assert [r.position for r in rows] == [len("".join(x + "\n" for x in lines[:i]).encode()) for i in range(len(lines))]


def test_lines_longer_than_a_read(spark, tmp_path):
    lines = ["a" * (3 * tail.STEP), "b", "c" * (tail.STEP - 1)]
    (tmp_path / "f").write_text("\n".join(lines) + "\n" + "d" * 2 * tail.STEP)
    rows = tail.registered(spark).read.format(tail.NAME).load(str(tmp_path / "f")).orderBy("position").collect()
    assert [r.value for r in rows] == lines


def test_json_lines(spark, tmp_path):
    (tmp_path / "events.jsonl").write_text('{"run_id": "x", "status": "ok"}\n\nbroken {\n{"run_id": "y"}\n')
    stream = tail.follow_json(spark, str(tmp_path), S.RUN_STATE, "*.jsonl").select("run_id", F.length("raw_line").alias("n"))
    query = stream.writeStream.format("memory").queryName("followed").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted(map(tuple, spark.table("followed").collect())) == [("x", 31), ("y", 15)]
