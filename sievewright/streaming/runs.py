"""Run state over event streams: folds, idle runs, windows and tails."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from ..operators import journal
from ..sources.tail import follow_json


def tail(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*", newest: bool = False) -> DataFrame:
    """(path, position, raw_line, ...): JSON lines under a path as a stream, also those appended to files that were read before.

    The checkpoint of the query remembers how far each file was read.
    """
    return follow_json(spark, path, schema, pattern, newest)


def running_counters(deltas: DataFrame) -> DataFrame:
    """(run_id, key, value) as in the batch fold; for the output modes update and complete."""
    return journal.counter_fold(deltas)


def idle_runs(events: DataFrame, time: str = "event_time", seconds: int = 600, delay: str = "10 minutes") -> DataFrame:
    """(run_id, active_from, idle_from, n): sessions of a run's events that no event followed within the gap."""
    gap = F.session_window(time, f"{seconds} seconds")
    return events.withWatermark(time, delay).groupBy("run_id", gap.alias("w")).agg(F.count("*").alias("n"), F.max(time).alias("idle_from")).select("run_id", F.col("w.start").alias("active_from"), "idle_from", "n")


def windowed_counts(events: DataFrame, time: str = "event_time", width: str = "1 hour", slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """(started, event_type, n) by tumbling or sliding windows; events later than the delay are left out of streams."""
    return events.withWatermark(time, delay).groupBy(F.window(time, width, slide or width).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("started"), "event_type", "n")


def keep_last(events: DataFrame, table: str, n: int, order: str = "seq") -> Callable[[], StreamingQuery]:
    """A query that keeps the last ``n`` events in a Parquet table, merged with each micro-batch."""
    spark = events.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        before = spark.read.parquet(f"{table}/{number - 1}") if number else batch.limit(0)
        before.unionByName(batch).orderBy(F.desc(order)).limit(n).write.mode("overwrite").parquet(f"{table}/{number}")

    return lambda: events.writeStream.foreachBatch(merge).option("checkpointLocation", f"{table}/_checkpoint").trigger(availableNow=True).start()


def upsert_latest(reports: DataFrame, table: str) -> Callable[[], StreamingQuery]:
    """A query that keeps each run's last report (run_id, seq, ...) in a Parquet table."""
    from ..operators.runs import latest_states

    spark = reports.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        before = spark.read.parquet(f"{table}/{number - 1}") if number else batch.limit(0)
        latest_states(before.unionByName(batch)).select(batch.columns).write.mode("overwrite").parquet(f"{table}/{number}")

    return lambda: reports.writeStream.foreachBatch(merge).option("checkpointLocation", f"{table}/_checkpoint").trigger(availableNow=True).start()


def over_what_is_there(start: Callable[[], StreamingQuery], spark: SparkSession) -> StreamingQuery:
    """Starts a query that ends once it has read what is there.

    Timers of processing time would ask for another micro-batch for ever; such a
    query has none without data, so that timers that fall due wait for its next run.
    """
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        return start()  # a query keeps the settings that it was started with
    finally:
        spark.conf.set(setting, before)


def to_batches(stream: DataFrame, path: str, checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Runs a stream over what is there into a Parquet folder for each micro-batch, ``batch=<number>``.

    A micro-batch that runs again replaces its folder, so each row is kept once.
    """

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return over_what_is_there(writer.start, stream.sparkSession)


def to_table(stream: DataFrame, name: str, checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Runs a stream over what is there into a table in memory, as tests and small reports want it."""
    writer = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return over_what_is_there(writer.start, stream.sparkSession)
