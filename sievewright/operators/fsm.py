"""The run's state machine over ordered events, and other folds that depend on what was accepted before.

Whether an event is legal depends on the phase that the legal events before it
led to. The machine's events are composed as maps of states, block by block, so that
a run is replayed by many tasks. Other folds walk a key's rows in order in the task
that has them: sorted partitions are streamed through, one state at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S

_MOVES = {(phase, event): after for phase, event, after in S.TRANSITIONS}
#: Events that set a status and leave the phase.
_REQUESTS = {"REQUEST_STOP": "STOPPED", "REQUEST_PAUSE": "PAUSED", "REQUEST_RESUME": "RUNNING"}
#: Phases from which training can't be asked for while collecting.
_GATES = {"TRAINING", "EVALUATING"}


def fold_by(rows: DataFrame, key: str, order: list[str], schema: str, start: Callable[[], dict], step: Callable[[dict, tuple], dict], columns: list[str]) -> DataFrame:
    """A fold over each key's rows in order: ``step(state, row)`` gives the new columns of each row and changes the state.

    Rows of a key are sorted to one task, which holds one state at a time; the
    order is total by the columns given.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = list(dict.fromkeys([key, *order, *columns]))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for batch in batches:
            made = []
            for row in batch[names].itertuples(index=False, name="Row"):
                k = getattr(row, key)
                if state is None or k != now:
                    now, state = k, start()
                made.append(step(state, row))
            yield pd.concat([batch[names].reset_index(drop=True), pd.DataFrame(made)], axis=1)

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
    ordered = rows.select(*names).where(F.col(key).isNotNull()).repartition(n, key).sortWithinPartitions(key, *order)
    return ordered.mapInPandas(walk, f"{kinds}, {schema}")


#: A state is the phase's number times ``_WIDTH`` plus the status's; 0 stands for a status that nothing has set.
_PHASES = sorted({p for before, _, after in S.TRANSITIONS for p in (before, after)} | {"ERROR", "INITIALIZING"})
_STATUSES = ["IDLE", "RUNNING", "COMPLETED", "STOPPED", "PAUSED", "ERROR"]
_WIDTH = len(_STATUSES) + 1
#: Events, and blocks of them, that are composed or replayed at once.
FAN = 256


def _code(phase: str, status: str | None = None) -> int:
    return _PHASES.index(phase) * _WIDTH + (0 if status is None else 1 + _STATUSES.index(status))


def _effects(event: str, collecting: bool) -> list[int]:
    """The state after an event for each phase before it; where it is illegal, the phase alone."""
    if event in _REQUESTS:
        return [_code(p, _REQUESTS[event]) for p in _PHASES]
    if event == "ERROR":
        return [_code("ERROR", "ERROR")] * len(_PHASES)
    out = []
    for phase in _PHASES:
        after = _MOVES.get((phase, event))
        if event == "TRAIN_NOW" and collecting and phase in _GATES:
            after = None
        out.append(_code(phase) if after is None else _code(after, "COMPLETED" if after == "COMPLETE" else "RUNNING"))
    return out


def effect(event: Column, mode: Column) -> Column:
    """What an event does to a run, as an array of codes by phase; unknown and null events do nothing."""
    known = sorted({e for _, e, _ in S.TRANSITIONS} | set(_REQUESTS) | {"ERROR"})
    literal = lambda codes: F.array(*map(F.lit, codes))
    out = literal([_code(p) for p in _PHASES])
    for name in known:
        free, gated = _effects(name, False), _effects(name, True)
        done = literal(free) if free == gated else F.when(F.coalesce(mode == "COLLECT", F.lit(False)), literal(gated)).otherwise(literal(free))
        out = F.when(event == name, done).otherwise(out)
    return out


def after(state: Column, effects: Column) -> Column:
    """The state that effects make of a state: the status stays where they set none."""
    made = F.get(effects, F.floor(state / _WIDTH).cast("int"))
    return made + F.when(made % _WIDTH == 0, state % _WIDTH).otherwise(0)


def replay_machine(events: DataFrame) -> DataFrame:
    """Events (run_id, seq, event, mode) with ``phase`` and ``status`` after each, and whether it was ``legal``.

    An illegal event changes nothing. A request to stop sets the status alone.
    Rows of a null run are left out; nulls of ``seq`` come first.

    An event is a map of states, and maps compose. Events are numbered in order,
    ``FAN`` in a row are a block, ``FAN`` blocks are a block of the next level, and
    so on; a run's events of a block are composed to one map. From the last level
    down, each block's state at its start follows from the maps before it in its
    own parent. So no group has more than ``FAN`` members, whatever the length of
    a run, and a single run is replayed by as many tasks as there are blocks.
    """
    from .ordering import positioned

    rows = events.where(F.col("run_id").isNotNull()).select("run_id", "seq", "event", "mode")
    levels = 1
    n = rows.count()
    while FAN**levels < n:
        levels += 1
    leaves = positioned(rows, "seq", "_at").select("run_id", F.struct(F.col("_at").alias("at"), effect(F.col("event"), F.col("mode")).alias("map"), "seq", "event", "mode").alias("kid"))
    nothing = F.array(*(F.lit(_code(p)) for p in _PHASES))
    blocks = []
    for _ in range(levels):
        grouped = leaves.groupBy("run_id", F.floor(F.col("kid.at") / FAN).cast("bigint").alias("at")).agg(F.array_sort(F.collect_list("kid")).alias("kids"))
        composed = F.aggregate("kids", nothing, lambda f, kid: F.transform(f, lambda state: after(state, kid["map"])))
        blocks.append(grouped)
        leaves = grouped.select("run_id", F.struct("at", composed.alias("map")).alias("kid"))
    starts = leaves.select("run_id", "kid.at", F.lit(_code("INITIALIZING", "IDLE")).alias("state"))
    for grouped in reversed(blocks):
        began = F.struct(F.col("state").alias("state"), F.array().cast("array<int>").alias("before"))
        step = lambda acc, kid: F.struct(after(acc["state"], kid["map"]).alias("state"), F.array_append(acc["before"], acc["state"]).alias("before"))
        befores = F.aggregate("kids", began, step, lambda acc: acc["before"])
        each = grouped.join(starts.select("run_id", "at", "state"), ["run_id", "at"]).select("run_id", F.explode(F.arrays_zip(F.col("kids"), befores.alias("before"))).alias("x"))
        starts = each.select("run_id", "x.kids", F.col("x.kids.at").alias("at"), F.col("x.before").alias("state"))
    done = after(F.col("state"), F.col("kids.map"))
    name = lambda names, i: F.element_at(F.array(*map(F.lit, names)), i.cast("int"))
    return starts.select(
        "run_id", "kids.seq", "kids.event", "kids.mode",
        name(_PHASES, F.floor(done / _WIDTH) + 1).alias("phase"),
        name(_STATUSES, done % _WIDTH).alias("status"),
        (F.get("kids.map", F.floor(F.col("state") / _WIDTH).cast("int")) % _WIDTH != 0).alias("legal"),
    )


def legality(events: DataFrame, spark: SparkSession) -> DataFrame:
    """Events (run_id, seq, phase, event) with ``next_phase`` by the table of moves, null for an illegal one."""
    return events.join(F.broadcast(S.transitions(spark)), ["phase", "event"], "left").withColumn("legal", F.col("next_phase").isNotNull())


def can_train(mode: Column, phase: Column) -> Column:
    """Whether training is allowed: always in the mode TRAIN, at rest in the mode COLLECT."""
    return F.coalesce((mode == "TRAIN") | ((mode == "COLLECT") & phase.isin("COMPLETE", "INITIALIZING")), F.lit(False))


def rate_limited(attempts: DataFrame, seconds: float = 300.0) -> DataFrame:
    """Attempts (key, seq, at in seconds) with ``accepted``: none within the time after the last accepted one."""

    def step(state: dict, row: tuple) -> dict:
        ok = state["last"] is None or row.at - state["last"] >= seconds
        if ok:
            state["last"] = row.at
        return {"accepted": ok}

    return fold_by(attempts, "key", ["at", "seq"], "accepted boolean", lambda: {"last": None}, step, [])


def token_bucket(requests: DataFrame, rate: float = 5.0, burst: int = 10) -> DataFrame:
    """Requests (key, seq, at in seconds) with ``accepted``: a bucket of ``burst`` tokens, refilled at ``rate`` a second."""

    def step(state: dict, row: tuple) -> dict:
        last = row.at if state["at"] is None else state["at"]
        state["tokens"] = min(float(burst), state["tokens"] + max(0.0, row.at - last) * rate)
        state["at"] = row.at
        ok = state["tokens"] >= 1.0
        if ok:
            state["tokens"] -= 1.0
        return {"accepted": ok}

    return fold_by(requests, "key", ["at", "seq"], "accepted boolean", lambda: {"tokens": float(burst), "at": None}, step, [])
