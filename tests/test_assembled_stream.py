"""The assembler as a stream with state: state variables, timers, restarts."""

import json
import time

import pytest
from pyspark.sql import functions as F

from sievewright.streaming import assemble as A
from sievewright.streaming import runs as R

SCHEMA = "session string, seq bigint, event string"


def delta(session, part, text):
    return json.dumps({"type": "message.part.delta", "properties": {"sessionID": session, "messageID": "m", "partID": part, "field": "text", "delta": text}})


def updated(session, part, text, end=None):
    return json.dumps({"type": "message.part.updated", "properties": {"part": {"sessionID": session, "messageID": "m", "id": part, "type": "text", "text": text, "time": {"end": end} if end else {}}}})


def feed(spark, folder, number, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.json(f"{folder}/d{number}")


def run(spark, folder, name, checkpoint, **limits):
    """The rows that one run over what is there makes; a later run goes on from the checkpoint."""
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).json(str(folder))
    rows = []
    writer = A.assembled_stream(stream, **limits).writeStream.outputMode("update").foreachBatch(lambda batch, _: rows.extend(batch.collect()))
    R.over_what_is_there(writer.option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start, spark).awaitTermination(90)
    return rows


def test_state_goes_on_after_a_restart(spark, tmp_path):
    folder, check = tmp_path / "in", tmp_path / "check"
    feed(spark, folder, 0, [("s", 0, delta("s", "a", "Hel")), ("t", 0, delta("t", "a", "x"))])
    assert {(r.session, r.text) for r in run(spark, folder, "first", check)} == {("s", "Hel"), ("t", "x")}
    feed(spark, folder, 1, [("s", 1, delta("s", "b", " world")), ("s", 2, delta("s", "a", "lo"))])
    feed(spark, folder, 2, [("s", 3, updated("s", "b", " World", 3))])
    found = [(r.session, r.text, r.completed, r.n_events) for r in run(spark, folder, "second", check)]
    assert sorted(found) == [("s", "Hello World", True, 4), ("s", "Hello world", False, 3)]
    known = {r.key.session: r.value.value for r in spark.read.format("statestore").option("stateVarName", "known").load(str(check)).collect()}
    assert (known["s"].message, known["s"].completed, known["s"].n, known["t"].n) == ("m", True, 4, 1)
    pieces = spark.read.format("statestore").option("stateVarName", "pieces").load(str(check)).where(F.col("key.session") == "s").collect()
    assert sum(len(r.list_value) if "list_value" in r.__fields__ else 1 for r in pieces) == 4


def test_many_pieces_are_joined(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    n = A.PIECES // 2 + 1
    for number in range(3):
        feed(spark, folder, number, [("s", number * n + i, delta("s", f"p{i % 2}", str(i % 10))) for i in range(n)])
    last = max(run(spark, folder, "joined", tmp_path / "check"), key=lambda r: r.n_events)
    one = A.Assembler("s")
    for number in range(3):
        for i in range(n):
            one.feed(json.loads(delta("s", f"p{i % 2}", str(i % 10))))
    assert last.text == one.text and last.n_events == 3 * n
    known = spark.read.format("statestore").option("stateVarName", "known").load(str(tmp_path / "check")).first().value.value
    assert known.n_pieces < n + 3


def test_silent_sessions_time_out(spark, tmp_path):
    """The timer fires in the micro-batches after; a complete answer ends without a row."""
    folder, check = tmp_path / "in", tmp_path / "check"
    feed(spark, folder, 0, [("late", 0, delta("late", "a", "half")), ("done", 0, updated("done", "a", "all", 1))])
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).json(str(folder))
    made = A.assembled_stream(stream, inactive_ms=1500)
    query = made.writeStream.format("memory").queryName("silent").outputMode("update").option("checkpointLocation", str(check)).trigger(processingTime="300 milliseconds").start()
    try:
        for _ in range(240):
            rows = spark.table("silent").collect()
            if any(r.error == "timed out" for r in rows):
                break
            time.sleep(0.5)
        assert sorted((r.session, r.text, r.completed, str(r.error)) for r in rows) == [("done", "all", True, "None"), ("late", "half", False, "None"), ("late", "half", False, "timed out")]
        time.sleep(3)  # the micro-batch ends
    finally:
        query.stop()
    assert spark.read.format("statestore").option("stateVarName", "known").load(str(check)).count() == 0


@pytest.mark.parametrize("event", ["{", "[]", "null", '{"type": 5}', '{"type": "message.part.delta"}', '{"type": "message.part.updated", "part": 5}', '{"type": "message.updated", "properties": {"info": {}}}'])
def test_events_that_do_nothing(event):
    assert [A.Answer().move(m) for m in A.moves("s", [event, None, ""])] in ([], [None])


def test_a_session_and_batch_sends_each_message_once():
    """Without Spark: what a processor asks of states and timers, each time a message to the JVM."""
    calls = []

    class State:
        def __init__(self, name):
            self.name, self.held = name, None

        def __getattr__(self, what):
            def call(*value):
                calls.append(f"{self.name} {what}")
                if what == "appendList":
                    self.held = [*(self.held or []), *value[0]]
                elif value:
                    self.held = value[0]
                return iter(self.held) if self.name == "pieces" and what == "get" else self.held

            return call

    class Handle:
        def getValueState(self, name, *_):
            return State(name)

        getListState = getValueState

        def registerTimer(self, at):
            calls.append("timer")

        def deleteTimer(self, at):
            calls.append("no timer")

    class Clock:
        def getCurrentProcessingTimeInMs(self):
            return 1_000

    from pyspark.sql import Row

    one = A.SessionAnswers(5_000, 60_000, 120_000)
    one.init(Handle())
    event = '{"type": "message.part.delta", "properties": {"sessionID": "s", "messageID": "m", "partID": "p", "field": "text", "delta": "%s"}}'
    (row,) = one.handleInputRows(("s",), iter([Row(session="s", seq=2, event=event % "b"), Row(session="s", seq=1, event=event % "a")]), Clock())
    assert (row.text, row.n_events) == ("ab", 2)
    assert calls == ["known get", "pieces appendList", "known update", "timer"]
    calls.clear()
    (row,) = one.handleInputRows(("s",), iter([Row(session="s", seq=3, event=event % "c")]), Clock())
    assert (row.text, row.n_events) == ("abc", 3)
    assert calls == ["known get", "pieces get", "pieces appendList", "known update", "no timer", "timer"]
