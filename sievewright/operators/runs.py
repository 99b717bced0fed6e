"""Run catalogues, statuses, and lookups by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedupe import latest, prefer
from .validate import required


def resolved_status(stop: Column, status: Column, last_error: Column, health: Column, run_id: Column, generated: Column, requests: Column, steps: Column) -> Column:
    """stopped, the run's own status, error, running or idle, by what the state tells first."""
    active = (F.coalesce(generated, F.lit(0)) > 0) | (F.coalesce(requests, F.lit(0)) > 0) | (F.coalesce(steps, F.lit(0)) > 0)
    named = F.coalesce(run_id, F.lit("")) != ""
    return (
        F.when(F.coalesce(stop, F.lit(False)), "stopped")
        .when(status.isin("running", "completed", "stopped", "error"), status)
        .when((F.coalesce(last_error, F.lit("")) != "") | (F.coalesce(health, F.lit("")) == "degraded"), "error")
        .when(named & active, "running")
        .otherwise("idle")
    )


def health(status: Column) -> Column:
    return F.when(status == "error", "error").otherwise("ok")


def catalogue(local: DataFrame, remote: DataFrame | None = None) -> DataFrame:
    """Runs by id, local states before remote ones, the newest first; missing columns have their defaults."""
    both = prefer(local, remote, "run_id") if remote is not None else local
    defaults = {"status": F.lit("unknown"), "current_round": F.lit(0), "stop_requested": F.lit(False)}
    for name, value in defaults.items():
        both = both.withColumn(name, F.coalesce(F.col(name), value) if name in both.columns else value)
    return both.orderBy(F.desc("modified"), "run_id")


def latest_states(reports: DataFrame) -> DataFrame:
    """The last report of each run, by ``seq``."""
    return latest(reports, "run_id", ["seq"])


def matched(requests: DataFrame, responses: DataFrame, strict: bool = True) -> DataFrame:
    """Requests (id) with their responses (id, seq, output); of a repeated id the last counts.

    A request without a response fails the query, or has a null output if not
    ``strict``.
    """
    last = responses.groupBy("id").agg(F.max_by("output", "seq").alias("output"))
    joined = requests.join(last.withColumn("_there", F.lit(True)), "id", "left")
    if strict:
        joined = required(joined, F.when(F.col("_there").isNull(), F.concat(F.lit("no response: "), F.coalesce(F.col("id").cast("string"), F.lit("null")))))
    return joined.drop("_there")


def system_and_turns(messages: Column) -> Column:
    """(system, turns): the first system message, and the messages of other roles."""
    system = F.try_element_at(F.filter(messages, lambda m: m["role"] == "system"), F.lit(1))["content"]
    return F.struct(system.alias("system"), F.filter(messages, lambda m: m["role"] != "system").alias("turns"))


def last_of_role(messages: Column, role: str) -> Column:
    return F.try_element_at(F.filter(messages, lambda m: m["role"] == role), F.lit(-1))["content"]


def role_lines(messages: Column) -> Column:
    """``role: content`` of all messages, a line each."""
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")


def as_parts(messages: Column) -> Column:
    """Messages as (role, parts of texts)."""
    return F.transform(messages, lambda m: F.struct(m["role"].alias("role"), F.array(F.struct(m["content"].alias("text"))).alias("parts")))
