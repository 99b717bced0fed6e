"""The event journal: folds of deltas, hash chains, replay, durations and histograms.

Events carry ``run_id`` and ``seq``, their place in the run's journal. Windows
are partitioned by run; folds sum before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import text


def sanitized(events: DataFrame) -> DataFrame:
    """Events with the journal's fields alone; messages redacted and truncated, paths truncated."""
    columns = [F.col(k) if k in events.columns else F.lit(None).cast(S.JOURNAL_EVENT[k].dataType).alias(k) for k in S.JOURNAL_KEYS]
    rest = [c for c in ("seq", "event_time", "raw_line") if c in events.columns]
    kept = events.select(*columns, *rest)
    paths = F.transform("artifact_paths", lambda p: text.truncate(p, text.PATH_LENGTH))
    return kept.withColumn("message", text.truncate(text.redact(F.col("message"), None), text.MESSAGE_LENGTH)).withColumn("artifact_paths", paths)


def as_lines(events: DataFrame) -> DataFrame:
    """(run_id, seq, line): events as JSON without null fields."""
    return events.select("run_id", "seq", F.to_json(F.struct(*S.JOURNAL_KEYS)).alias("line"))


def redacted_state(state: DataFrame, allowed: list[str]) -> DataFrame:
    """The allowed columns of run states, their texts redacted and cut at 100 characters."""
    return state.select(*(text.sanitize(F.col(c), state.schema[c].dataType, text.PATH_LENGTH).alias(c) for c in allowed if c in state.columns))


def counter_fold(deltas: DataFrame, known: list[str] | None = None, last: list[str] = S.LAST_WRITE_COUNTERS) -> DataFrame:
    """(run_id, key, value) of deltas (run_id, seq, key, value): sums, but for keys that the last event sets.

    With ``known``, other keys are left out.
    """
    rows = deltas if known is None else deltas.where(F.col("key").isin(known))
    return rows.groupBy("run_id", "key").agg(
        F.when(F.col("key").isin(last), F.max_by("value", "seq")).otherwise(F.sum("value")).alias("value"),
    )


def deltas_of(events: DataFrame, column: str) -> DataFrame:
    """(run_id, seq, key, value) of a map column of events."""
    return events.select("run_id", "seq", F.explode(F.col(column)).alias("key", "value"))


def pivoted(folded: DataFrame, keys: list[str]) -> DataFrame:
    """One row per run with a column per key, 0 where it has none."""
    return folded.groupBy("run_id").agg(*(F.coalesce(F.max(F.when(F.col("key") == k, F.col("value"))), F.lit(0.0)).alias(k) for k in keys))


def with_cost(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """``usage`` (model, input_tokens, output_tokens) with ``estimated_cost_usd``; 0 for a model without a price.

    ``prices`` has one row per model, a table that people write by hand.
    """
    cost = F.col("input_tokens") / 1_000_000 * F.col("input_price") + F.col("output_tokens") / 1_000_000 * F.col("output_price")
    joined = usage.join(prices, "model", "left")
    return joined.withColumn("estimated_cost_usd", F.coalesce(cost, F.lit(0.0))).drop("input_price", "output_price")


def round_metrics(rounds: DataFrame) -> DataFrame:
    """(run_id, round, raw, clean, rejected, train, val) from rows (run_id, round, kind)."""
    n = lambda kind: F.count_if(F.col("kind") == kind)
    return rounds.groupBy("run_id", "round").agg(n("raw").alias("raw"), n("clean").alias("clean"), F.greatest(n("raw") - n("clean"), F.lit(0)).alias("rejected"), n("train").alias("train"), n("val").alias("val"))


def progress(counters: DataFrame, train_steps: int) -> DataFrame:
    """Rates of a run's counters (one row per run) and the share of training done, in percent."""
    def rate(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(0.0)

    return counters.select(
        "run_id",
        rate(F.col("teacher_generated"), F.col("teacher_generated") + F.col("teacher_failed")).alias("success_rate"),
        rate(F.col("validated_ok"), F.col("raw_written")).alias("validation_rate"),
        rate(F.col("test_pass"), F.col("test_pass") + F.col("test_fail")).alias("test_pass_rate"),
        F.least(F.lit(100.0), 100.0 * F.col("train_step") / train_steps).alias("train_progress"),
    )


def line_hash(line: Column) -> Column:
    """SHA-256 of a line and its line feed."""
    return F.sha2(F.concat(line, F.lit("\n")), 256)


def chain_check(lines: DataFrame, raw: str = "raw_line") -> DataFrame:
    """``lines`` (run_id, seq, prev_hash, raw_line) with ``expected`` and ``chained``.

    The first line's predecessor is the run's id; each other's is the hash of the
    line before. Only a hash of each line is kept by the window.
    """
    hashed = lines.withColumn("_hash", line_hash(F.col(raw)))
    before = F.lag("_hash").over(Window.partitionBy("run_id").orderBy("seq"))
    return hashed.withColumn("expected", F.coalesce(before, F.col("run_id"))).withColumn("chained", F.coalesce(F.col("prev_hash") == F.col("expected"), F.lit(False))).drop("_hash")


def chained(events: DataFrame) -> DataFrame:
    """(run_id, seq, prev_hash, line): events (the journal's columns and seq) as lines, each with the hash of the one before.

    A line's hash depends on all before, so runs are the unit of work: a run's
    rows come sorted to one task, which keeps one hash at a time.
    """
    keys = [k for k in S.JOURNAL_KEYS if k != "prev_hash"]
    bodies = events.select("run_id", "seq", F.to_json(F.struct(*keys)).alias("body"))
    n = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run, prev = None, ""
        for batch in batches:
            hashes, lines = [], []
            for r, body in zip(batch["run_id"], batch["body"], strict=True):
                if r != run:
                    run, prev = r, r
                hashes.append(prev)
                lines.append(f'{body[:-1]},"prev_hash":"{prev}"}}')
                prev = hashlib.sha256((lines[-1] + "\n").encode()).hexdigest()
            yield pd.DataFrame({"run_id": batch["run_id"], "seq": batch["seq"], "prev_hash": hashes, "line": lines})

    ordered = bodies.where("run_id is not null").repartition(n, "run_id").sortWithinPartitions("run_id", "seq")
    return ordered.mapInPandas(link, "run_id string, seq bigint, prev_hash string, line string")


def replay_state(event_type: Column, stage: Column) -> Column:
    """The state that an event sets, or null."""
    return F.coalesce(*(F.when((event_type == t) & (F.lit(True) if s is None else stage == s), F.lit(state)) for t, s, state in S.REPLAY_STATES))


def replay(events: DataFrame) -> DataFrame:
    """``events`` with ``state``, the last that an event set, IDLE before any."""
    window = Window.partitionBy("run_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mapped = F.last(replay_state(F.col("event_type"), F.col("stage")), ignorenulls=True).over(window)
    return events.withColumn("state", F.coalesce(mapped, F.lit("IDLE")))


def final_states(events: DataFrame) -> DataFrame:
    """(run_id, final_state, max_round, n_events), without a sort: the last event that sets a state counts."""
    state = replay_state(F.col("event_type"), F.col("stage"))
    return events.groupBy("run_id").agg(
        F.coalesce(F.max_by(state, F.when(state.isNotNull(), F.col("seq"))), F.lit("IDLE")).alias("final_state"),
        F.max(F.coalesce("round", F.lit(0))).alias("max_round"),
        F.count("*").alias("n_events"),
    )


def stage_durations(events: DataFrame, time: str = "event_time") -> DataFrame:
    """(run_id, round, stage, started, ended, duration_ms): each stage start paired with the next event of its stage, if that is its end."""
    window = Window.partitionBy("run_id", "round", "stage").orderBy("seq")
    paired = events.where(F.col("event_type").isin("stage_start", "stage_end")).select(
        "run_id", "round", "stage", "event_type", F.col(time).alias("started"), F.lead("event_type").over(window).alias("_next"), F.lead(time).over(window).alias("ended")
    )
    ms = (F.unix_micros(F.col("ended").cast("timestamp")) - F.unix_micros(F.col("started").cast("timestamp"))) / 1000
    return paired.where("event_type = 'stage_start' and _next = 'stage_end'").select("run_id", "round", "stage", "started", "ended", ms.cast("bigint").alias("duration_ms"))


def idle_gaps(events: DataFrame, time: str = "event_time", seconds: int = 600) -> DataFrame:
    """(run_id, idle_from, idle_until, idle_seconds): pauses between a run's events above the bound."""
    after = F.lead(time).over(Window.partitionBy("run_id").orderBy(time, "seq"))
    gaps = events.select("run_id", F.col(time).alias("idle_from"), after.alias("idle_until"))
    length = (F.unix_micros(F.col("idle_until").cast("timestamp")) - F.unix_micros(F.col("idle_from").cast("timestamp"))) / 1e6
    return gaps.withColumn("idle_seconds", length).where(F.col("idle_seconds") > seconds)


def event_histogram(events: DataFrame, totals: bool = False) -> DataFrame:
    """(stage, level, n), with subtotals (nulls) if asked for."""
    grouped = events.rollup("stage", "level") if totals else events.groupBy("stage", "level")
    return grouped.agg(F.count("*").alias("n"))


def last_event_time(events: DataFrame) -> DataFrame:
    """(run_id, last_ts) by place in the journal."""
    return events.groupBy("run_id").agg(F.max_by("ts", "seq").alias("last_ts"))


def distinct_over(frames: list[DataFrame], column: str) -> DataFrame:
    """(n): distinct values of a column over several tables."""
    return reduce(DataFrame.unionByName, (f.select(column) for f in frames)).agg(F.countDistinct(column).alias("n"))


def outcome_counts(rows: DataFrame, key: str) -> DataFrame:
    """(key, n)."""
    return rows.groupBy(key).agg(F.count("*").alias("n"))


def content_hash(lines: DataFrame, order: str = "seq", value: str = "value") -> DataFrame:
    """(record_count, dataset_hash) of ordered lines: SHA-256 over the hashes of blocks of lines.

    The hash depends on every line and on their order, but each block is hashed
    where it lies, and only block hashes, 64 characters for ``block`` lines, meet.
    """
    block = 100_000
    hashed = lines.select(F.floor(F.col(order) / block).alias("block"), F.col(order).alias("at"), line_hash(F.col(value)).alias("h"))
    blocks = hashed.groupBy("block").agg(F.count("*").alias("n"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "h"))), lambda x: x["h"]), ""), 256).alias("h"))
    return blocks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("record_count"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "h"))), lambda x: x["h"]), ""), 256).alias("dataset_hash"))


def without_conflicts(lines: DataFrame) -> DataFrame:
    """Lines (path, line_no, value) without merge markers and the other side's lines: ours stay."""
    mark = F.when(F.col("value").startswith("<<<<<<<"), "ours").when(F.col("value").startswith("======="), "theirs").when(F.col("value").startswith(">>>>>>>"), "none")
    window = Window.partitionBy("path").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = lines.withColumn("_mark", mark)
    # a separator outside of a conflict ends nothing
    opened = F.last(F.when(F.col("_mark") != "theirs", F.col("_mark")), ignorenulls=True).over(window)
    state = F.last("_mark", ignorenulls=True).over(window)
    kept = marked.withColumn("_open", F.coalesce(opened, F.lit("none"))).withColumn("_state", F.coalesce(state, F.lit("none")))
    return kept.where("_mark is null and (_open = 'none' or _state = 'ours')").drop("_mark", "_open", "_state")
