"""Answers assembled from event streams, in batch and as a stateful streaming operator."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from ..functions.patterns import RETRYABLE


def completed_text(events: DataFrame) -> DataFrame:
    """(stream, text, error) of rows (stream, seq, event struct): the completed text parts joined in order and trimmed.

    Any error event makes an error of the stream, and so does a stream without a
    completed part.
    """
    e = F.col("event")
    part = F.when((e["type"] == "text") & (F.coalesce(e["part"]["time"]["end"], F.lit("")).isin("", "0") == F.lit(False)) & (e["part"]["text"] != ""), e["part"]["text"])
    error = F.when(e["type"] == "error", F.coalesce(e["message"], e["error"], F.lit("stream error"))).when(e["type"] == "session", e["session"]["error"])
    gathered = events.select("stream", "seq", part.alias("part"), error.alias("error")).groupBy("stream").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("part").isNotNull(), F.struct("seq", "part")))), lambda x: x["part"]), "").alias("joined"),
        F.count("part").alias("n"),
        F.slice(F.transform(F.array_sort(F.collect_list(F.when(F.col("error").isNotNull(), F.struct("seq", "error")))), lambda x: x["error"]), 1, 3).alias("errors"),
    )
    failed = F.when(F.size("errors") > 0, F.array_join("errors", " | ")).when(F.col("n") == 0, "no completed text")
    return gathered.select("stream", F.when(failed.isNull(), F.regexp_replace("joined", r"(?U)^\s+|\s+$", "")).alias("text"), failed.alias("error"))


# ---------------------------------------------------------------- what an event does to an answer
#
# Each kind of event is read by one function of (event, properties, session), which
# gives a move (what, message, part, text) or None. What a move does is said once,
# in ``Answer.move``, for tables and streams alike.

Move = tuple[str, object, object, object]


def _object(value: object) -> dict:
    return value if isinstance(value, dict) else {}


def _status(event: dict, props: dict, session: str) -> Move | None:
    status = _object(props.get("status"))
    message = status.get("message") if status.get("type") == "retry" else None
    if props.get("sessionID") == session and isinstance(message, str) and any(p in message.lower() for p in RETRYABLE):
        return "fail", None, None, message.strip()
    return None


def _failed(event: dict, props: dict, session: str) -> Move | None:
    if props.get("sessionID") != session:
        return None
    error = props.get("error")
    return "fail", None, None, error if isinstance(error, str) else json.dumps(error, sort_keys=True) if error else "session error"


def _message(event: dict, props: dict, session: str) -> Move | None:
    info = props["info"] if isinstance(props.get("info"), dict) else event.get("info") or props
    if info.get("sessionID") != session or info.get("role") != "assistant":
        return None
    return "complete" if _object(info.get("time")).get("completed") is not None else "see", info.get("id"), None, None


def _delta(event: dict, props: dict, session: str) -> Move | None:
    if props.get("sessionID") != session:
        return None
    shown = props.get("field") == "text" and props.get("delta")
    return "append" if shown else "see", props.get("messageID"), props.get("partID"), props.get("delta")


def _part(event: dict, props: dict, session: str) -> Move | None:
    part = props["part"] if isinstance(props.get("part"), dict) else event.get("part") or props
    if not isinstance(part, dict) or part.get("sessionID") != session:
        return None
    what = "see"
    if part.get("id") and part.get("type") == "text":
        what = "replace" if _object(part.get("time")).get("end") is None else "finish"
    elif part.get("id") and part.get("type") == "step-finish":
        what = "complete"
    return what, part.get("messageID"), part.get("id"), part.get("text")


KINDS = {"session.status": _status, "session.error": _failed, "message.updated": _message, "message.part.delta": _delta, "message.part.updated": _part}


def moves(session: str, raw: Iterator[str | None]) -> Iterator[Move]:
    """The moves of events in JSON; what isn't an object or of no known kind makes none."""
    for text in raw:
        try:
            event = json.loads(text) if text else None
        except ValueError:
            continue
        if isinstance(event, dict) and (found := move_of(event, session)):
            yield found


def move_of(event: dict, session: str) -> Move | None:
    kind = event.get("type")
    read = KINDS.get(kind) if isinstance(kind, str) else None
    return read(event, _object(event.get("properties")) or event, session) if read else None


class Answer:
    """What is known of an answer but its texts: the message that it is, whether it is complete, and the last error."""

    def __init__(self, message: str | None = None, completed: bool = False, error: str | None = None):
        self.message, self.completed, self.error = message, completed, error

    def move(self, move: Move) -> tuple[str, str, bool] | None:
        """Takes a move; a piece of text (part, text, whether it replaces the part) is handed back."""
        what, message, part, text = move
        if what == "fail":
            self.error = text
            return None
        if isinstance(message, str) and message and not self.message:
            self.message = message  # the first message that is seen is the answer; others are ignored
        if self.message and message != self.message:
            return None
        self.completed |= what in ("complete", "finish")
        if what in ("append", "replace", "finish") and isinstance(part, str) and part and isinstance(text, str):
            return part, text, what != "append"
        return None


class Texts:
    """Parts in the order of their first text."""

    def __init__(self, parts: dict[str, list[str]] | None = None):
        self.parts = parts or {}

    def add(self, part: str, text: str, replaces: bool) -> None:
        held = self.parts.setdefault(part, [])
        if replaces:
            held.clear()
        held.append(text)

    @property
    def text(self) -> str:
        return "".join(x for held in self.parts.values() for x in held)


class Assembler:
    """The answer of one session: deltas append to a part, updates replace it, parts stand in the order of their first text."""

    def __init__(self, session: str, saved: str | None = None):
        self.session, state = session, json.loads(saved) if saved else {}
        self.answer, self.texts = Answer(**state.get("answer", {})), Texts(state.get("texts"))

    def saved(self) -> str:
        return json.dumps({"answer": self.answer.__dict__, "texts": self.texts.parts})

    message = property(lambda self: self.answer.message)
    completed = property(lambda self: self.answer.completed)
    error = property(lambda self: self.answer.error)
    text = property(lambda self: self.texts.text)

    def feed(self, event: dict) -> None:
        move = move_of(event, self.session)
        piece = self.answer.move(move) if move else None
        if piece:
            self.texts.add(*piece)


OUTPUT = "session string, text string, completed boolean, error string, n_events bigint"
def inactivity_ms(overall_ms: int) -> int:
    """How long a session may be silent: a tenth of what it may take, from 5 to 30 seconds."""
    return max(5_000, min(30_000, overall_ms // 10))


def assembled(events: DataFrame) -> DataFrame:
    """(session, text, completed, error, n_events) of rows (session, seq, event as JSON), for batch tables."""

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        done = Assembler(key[0])
        for move in moves(key[0], rows.sort_values("seq")["event"]):
            piece = done.answer.move(move)
            if piece:
                done.texts.add(*piece)
        return pd.DataFrame({"session": [key[0]], "text": [done.text], "completed": [done.completed], "error": [done.error], "n_events": [len(rows)]})

    return events.where("session is not null").select("session", "seq", "event").groupBy("session").applyInPandas(one, OUTPUT)


#: The store that keeps states of several variables.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Pieces of an answer that its list may hold before they are joined.
PIECES = 1000


class SessionAnswers(StatefulProcessor):
    """The state of a session: a value of what is known of the answer, and a list of its pieces of text.

    A micro-batch appends its pieces to the list and writes no text anew, but for
    every ``PIECES`` pieces, which are joined to one a part. A timer stands at the
    time when the session has been silent or open for too long.
    """

    def __init__(self, silent_ms: int, overall_ms: int, keep_ms: int):
        self.silent, self.overall, self.keep = silent_ms, overall_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "message string, completed boolean, error string, n bigint, n_pieces bigint, started bigint, wake bigint", self.keep)
        self.pieces = handle.getListState("pieces", "part string, text string, replaces boolean", self.keep)

    # each access to a state or a timer is a message to the JVM, so that none is made twice for a session and micro-batch

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        message, completed, error, n, held, started, wake = self.known.get() or (None, False, None, 0, 0, now, None)
        answer = Answer(message, completed, error)
        if now - started >= self.overall:
            yield from self._ended(key, n, answer, wake)
            return
        events = sorted(rows, key=lambda row: (row.seq is None, row.seq))
        fresh = [piece for move in moves(key[0], (row.event for row in events)) if (piece := answer.move(move))]
        n, texts = n + len(events), self._texts(held)
        for piece in fresh:
            texts.add(*piece)
        if held + len(fresh) > PIECES:
            joined = [(part, "".join(said), True) for part, said in texts.parts.items()]
            self.pieces.put(joined)
            held = len(joined)
        elif fresh:
            self.pieces.appendList(fresh)
            held += len(fresh)
        next_wake = max(now + 1, min(now + self.silent, started + self.overall))
        self.known.update((answer.message, answer.completed, answer.error, n, held, started, next_wake))
        self._wake(wake, next_wake)
        yield Row(session=key[0], text=texts.text, completed=answer.completed, error=answer.error, n_events=n)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        known = self.known.get()
        if known:
            message, completed, error, n, _, _, wake = known
            yield from self._ended(key, n, Answer(message, completed, error), wake)

    def _ended(self, key: tuple, n: int, answer: Answer, wake: int | None) -> Iterator[Row]:
        text = self._texts().text
        self.known.clear()
        self.pieces.clear()
        self._wake(wake, None)
        if not answer.completed:
            yield Row(session=key[0], text=text, completed=False, error="timed out", n_events=n)

    def _texts(self, held: int = 1) -> Texts:
        texts = Texts()
        for part, text, replaces in self.pieces.get() if held else ():
            texts.add(part, text, replaces)
        return texts

    def _wake(self, before: int | None, at: int | None) -> None:
        """Moves the session's one timer."""
        if before is not None:
            self.handle.deleteTimer(before)
        if at is not None:
            self.handle.registerTimer(at)

    def close(self) -> None:
        pass


def assembled_stream(events: DataFrame, inactive_ms: int | None = None, overall_ms: int = 300_000) -> DataFrame:
    """The same over a stream: a row for each session and micro-batch that has events of it.

    A session without events for ``inactive_ms`` (by default as ``inactivity_ms``
    has it), or open for ``overall_ms`` since its first one, gives a last row with
    the error ``timed out``, unless it was completed, and its state goes. States
    that no timer clears go after twice that time. The session's state store is
    set to ``STORE``, which streams of several state variables need.
    """
    silent = inactivity_ms(overall_ms) if inactive_ms is None else inactive_ms
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    rows = events.where("session is not null").select("session", "seq", "event")
    return rows.groupBy("session").transformWithState(SessionAnswers(silent, overall_ms, max(2 * overall_ms, 60_000)), OUTPUT, "Update", "ProcessingTime")
