"""The machine as composed maps against a plain walk."""

import random

import pytest

from sievewright import schemas as S
from sievewright.operators import fsm

SCHEMA = "run_id string, seq int, event string, mode string"


def walked(rows):
    moves = {(p, e): after for p, e, after in S.TRANSITIONS}
    requests = {"REQUEST_STOP": "STOPPED", "REQUEST_PAUSE": "PAUSED", "REQUEST_RESUME": "RUNNING"}
    states, out = {}, []
    for run, seq, event, mode in sorted((r for r in rows if r[0] is not None), key=lambda r: r[1]):
        phase, status = states.get(run, ("INITIALIZING", "IDLE"))
        legal = True
        if event in requests:
            status = requests[event]
        elif event == "ERROR":
            phase = status = "ERROR"
        else:
            after = moves.get((phase, event))
            if event == "TRAIN_NOW" and mode == "COLLECT" and phase in ("TRAINING", "EVALUATING"):
                after = None
            legal = after is not None
            if legal:
                phase, status = after, "COMPLETED" if after == "COMPLETE" else "RUNNING"
        states[run] = phase, status
        out.append((run, seq, event, mode, phase, status, legal))
    return out


def made(n, runs, seed):
    rng = random.Random(seed)
    events = sorted({e for _, e, _ in S.TRANSITIONS}) + ["STAGE_COMPLETE"] * 8 + ["ERROR", "REQUEST_STOP", "REQUEST_PAUSE", "REQUEST_RESUME", "nothing", None]
    return [(rng.choice(runs), i, rng.choice(events), rng.choice(["COLLECT", "TRAIN", None])) for i in range(n)]


@pytest.mark.parametrize("fan, runs", [(256, ["a", "b", "c"]), (3, ["one"]), (4, ["a", "b", None])])
def test_blocks_of_any_size(spark, fan, runs, monkeypatch):
    """One run of all rows is replayed over several levels of blocks."""
    monkeypatch.setattr(fsm, "FAN", fan)
    rows = made(150, runs, fan)
    found = [tuple(r) for r in fsm.replay_machine(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(found, key=lambda r: r[1]) == walked(rows)


def test_no_python_and_no_rows(spark):
    frame = spark.createDataFrame(made(20, ["a"], 1), SCHEMA)
    plan = fsm.replay_machine(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan
    assert fsm.replay_machine(frame.limit(0)).collect() == []
