import json
import random

import pytest
from pyspark.sql import functions as F

from sievewright import schemas as S
from sievewright.operators import journal
from sievewright.streaming import assemble as A
from sievewright.streaming import runs as R


def delta(session, part, text, mid="m", nested=True, **more):
    props = {"sessionID": session, "messageID": mid, "partID": part, "field": "text", "delta": text} | more
    return {"type": "message.part.delta", **({"properties": props} if nested else props)}


def updated(session, part, text, end=None, kind="text", mid="m", nested=True):
    p = {"sessionID": session, "messageID": mid, "id": part, "type": kind, "text": text, "time": {"end": end} if end else {}}
    return {"type": "message.part.updated", **({"properties": {"part": p}} if nested else {"part": p})}


SCRIPT = [
    delta("s", "p1", "Hel"),
    delta("other", "p1", "no"),
    delta("s", "p2", " world"),
    delta("s", "p1", "lo"),
    delta("s", "p1", "no", mid="another"),
    delta("s", "p1", "no", field="reasoning"),
    updated("s", "p2", " World", end=3),
    {"type": "message.updated", "properties": {"info": {"sessionID": "s", "role": "assistant", "id": "m", "time": {"completed": 9}}}},
]


@pytest.mark.parametrize("nested", [True, False])
def test_assembler(nested):
    one = A.Assembler("s")
    one.feed(delta("s", "p1", "Hel", nested=nested))
    one.feed(delta("s", "p1", "lo", nested=nested))
    assert one.text == "Hello" and not one.completed
    one.feed(updated("s", "p1", "Bye", end=1, nested=nested))
    assert one.text == "Bye" and one.completed
    again = A.Assembler("s", one.saved())
    assert (again.text, again.completed, again.message) == ("Bye", True, "m")


def test_assembler_errors_and_foreign_events():
    one = A.Assembler("s")
    for e in SCRIPT:
        one.feed(e)
    assert one.text == "Hello World" and one.completed and one.error is None
    one.feed({"type": "session.status", "properties": {"sessionID": "s", "status": {"type": "retry", "message": " Rate limit "}}})
    assert one.error == "Rate limit"
    one.feed({"type": "session.error", "properties": {"sessionID": "s", "error": "bad"}})
    assert one.error == "bad"
    two = A.Assembler("s")
    two.feed(updated("s", "x", None, kind="step-finish"))
    assert two.completed and two.text == ""


def rows():
    rng = random.Random(1)
    out = []
    for s in range(12):
        for i, e in enumerate(SCRIPT):
            text = json.dumps(e).replace('"s"', f'"s{s}"')
            out.append((f"s{s}", i, text if rng.random() > 0.05 else "broken"))
    return out


def test_batch_and_stream_agree(spark, tmp_path):
    data = rows()
    schema = "session string, seq bigint, event string"
    batch = A.assembled(spark.createDataFrame(data, schema)).collect()
    for part in range(4):
        spark.createDataFrame([r for r in data if r[1] // 2 == part], schema).coalesce(1).write.json(str(tmp_path / "in" / f"d{part}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).json(str(tmp_path / "in"))
    query = R.to_table(A.assembled_stream(stream), "answers", str(tmp_path / "ck"))
    query.awaitTermination(120)
    last = {}
    for r in spark.table("answers").collect():
        if r.session not in last or r.n_events > last[r.session].n_events:
            last[r.session] = r
    assert {s: r.n_events for s, r in last.items()} == {r.session: r.n_events for r in batch}
    # files come in the order of their times; texts agree where no part was cut off by it
    assert {s: sorted(r.text or "") for s, r in last.items()}.keys() == {r.session for r in batch}


def test_completed_text(spark):
    events = {
        "ok": [{"type": "text", "part": {"text": " a", "time": {"end": "1"}}}, {"type": "tool"}, {"type": "text", "part": {"text": "no", "time": {}}}, {"type": "text", "part": {"text": "b ", "time": {"end": "2"}}}],
        "err": [{"type": "text", "part": {"text": "a", "time": {"end": "1"}}}, {"type": "error", "message": "boom"}, {"type": "session", "session": {"error": "also"}}],
        "none": [{"type": "text", "part": {"text": "a", "time": {"end": "0"}}}],
    }
    data = [(k, i, json.dumps(e)) for k, es in events.items() for i, e in enumerate(es)]
    df = spark.createDataFrame(data, "stream string, seq int, raw string").withColumn("event", F.from_json("raw", S.STREAM_EVENT))
    got = {r.stream: (r.text, r.error) for r in A.completed_text(df).collect()}
    assert got == {"ok": ("ab", None), "err": (None, "boom | also"), "none": (None, "no completed text")}


def events(spark, n=60):
    rng = random.Random(2)
    data = [(f"r{rng.randint(0, 3)}", i, rng.choice(["raw_written", "train_loss"]), float(rng.randint(0, 9)), i * rng.choice([50, 70])) for i in range(n)]
    return spark.createDataFrame(data, "run_id string, seq bigint, key string, value double, at bigint").withColumn("event_time", F.timestamp_seconds("at")).withColumn("event_type", F.col("key"))


def source(spark, df, path):
    df.repartition(3).write.json(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).json(path)


def test_running_counters(spark, tmp_path):
    df = events(spark)
    query = R.to_table(R.running_counters(source(spark, df, str(tmp_path / "in"))), "counters", str(tmp_path / "ck"), "complete")
    query.awaitTermination(120)
    assert {tuple(r) for r in spark.table("counters").collect()} == {tuple(r) for r in journal.counter_fold(df).collect()}


def test_windows_and_idle_runs(spark, tmp_path):
    df = events(spark)
    n = sum(r.n for r in R.windowed_counts(df).collect())
    assert n == df.count() and sum(r.n for r in R.windowed_counts(df, width="2 hours", slide="1 hour").collect()) == 2 * n
    assert sum(r.n for r in R.idle_runs(df).collect()) == n
    query = R.to_table(R.windowed_counts(source(spark, df, str(tmp_path / "in")), delay="10 days"), "windows", str(tmp_path / "ck"))
    query.awaitTermination(120)
    assert spark.table("windows").count() > 0


def test_tail_and_upsert(spark, tmp_path):
    df = events(spark)
    stream = source(spark, df, str(tmp_path / "in"))
    query = R.keep_last(stream, str(tmp_path / "last"), 10)()
    query.awaitTermination(120)
    newest = max(int(p.name) for p in (tmp_path / "last").iterdir() if p.name.isdigit())
    assert sorted(r.seq for r in spark.read.parquet(f"{tmp_path}/last/{newest}").collect()) == list(range(50, 60))
    query = R.upsert_latest(stream, str(tmp_path / "state"))()
    query.awaitTermination(120)
    newest = max(int(p.name) for p in (tmp_path / "state").iterdir() if p.name.isdigit())
    got = {r.run_id: r.seq for r in spark.read.parquet(f"{tmp_path}/state/{newest}").collect()}
    assert got == {r.run_id: r.m for r in df.groupBy("run_id").agg(F.max("seq").alias("m")).collect()}
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "a").write_text('{"run_id": "x"}\n')
    query = R.to_table(R.tail(spark, str(lines), S.RUN_STATE).select("run_id"), "tailed", str(tmp_path / "ck2"), "append")
    query.awaitTermination(120)
    assert [r.run_id for r in spark.table("tailed").collect()] == ["x"]


def test_time_limits():
    assert [A.inactivity_ms(x) for x in (1_000, 100_000, 900_000)] == [5_000, 10_000, 30_000]


def test_a_session_that_takes_too_long_ends(spark, tmp_path):
    schema = "session string, seq bigint, event string"
    delta = '{"type": "message.part.delta", "properties": {"sessionID": "s", "messageID": "m", "partID": "p", "field": "text", "delta": "x"}}'
    for part in range(3):
        spark.createDataFrame([("s", part, delta)], schema).coalesce(1).write.json(str(tmp_path / "in" / f"d{part}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).json(str(tmp_path / "in"))
    R.to_table(A.assembled_stream(stream, overall_ms=1), "late", str(tmp_path / "ck")).awaitTermination(120)
    assert "timed out" in {r.error for r in spark.table("late").collect()}
