"""Sinks: JSON lines, verbatim lines, state tables and sealed datasets."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import crypto
from ..functions import json as J
from ..operators.journal import content_hash


def json_lines(rows: DataFrame, path: str, order: str | None = None, mode: str = "error", ascii_only: bool = False) -> None:
    """A JSON object a line, in the order of a column over all files; with ``ascii_only``, other characters as escapes."""
    columns = [c for c in rows.columns if c != order] if order and order not in S.RAW_KEYS else rows.columns
    out = rows.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"), *([F.col(order).alias("_at")] if order else []))
    if order:
        out = out.orderBy("_at")
    out = out.select(ascii_escaped("value").alias("value") if ascii_only else "value")
    out.write.mode(mode).text(path)


def ascii_escaped(column: str) -> Column:
    """A JSON text with every character beyond ASCII as an escape of its UTF-16 units."""
    units = lambda c: F.concat(F.lit("\\u"), F.array_join(F.regexp_extract_all(F.lower(F.hex(F.encode(c, "UTF-16BE"))), F.lit("([0-9a-f]{4})"), F.lit(1)), "\\u"))
    runs = F.regexp_extract_all(F.col(column), F.lit(r"([\x00-\x7F]+|[^\x00-\x7F]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.when(r.rlike(r"^[\x00-\x7F]"), r).otherwise(units(r))), "")


def verbatim(rows: DataFrame, path: str, raw: str = "raw", order: list[str] | None = None, mode: str = "error") -> None:
    """Lines as they were read, in order."""
    ordered = rows.orderBy(*order) if order else rows
    ordered.select(F.col(raw).alias("value")).write.mode(mode).text(path)


def append_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def replace_table(rows: DataFrame, path: str) -> None:
    """Replaces a table: the new one is written beside it in full, then takes its name; the old one goes last.

    Readers see the old table, for the moment of two renames none, then the new
    one; a write that fails leaves the old one. In a store without renames of
    folders the last step is a copy.
    """
    spark = rows.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target, fresh, old = (jvm.org.apache.hadoop.fs.Path(path + end) for end in ("", f"-{uuid.uuid4().hex}", f"-{uuid.uuid4().hex}"))
    rows.write.parquet(fresh.toString())
    files = target.getFileSystem(conf)
    if files.exists(target) and not files.rename(target, old):
        raise OSError(f"can't move {path}")
    if not files.rename(fresh, target):
        raise OSError(f"can't name {path}")
    files.delete(old, True)


def append_stream(rows: DataFrame, path: str, checkpoint: str):
    """A stream appended to JSON files in micro-batches; returns the query."""
    return rows.writeStream.format("json").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def manifest(lines: DataFrame, run_id: str, key: str, created_at: str, version: str = "1", runtime: int = 0, events: int = 0, guardrails: dict[str, str] | None = None, order: str = "seq", value: str = "value") -> DataFrame:
    """One row (manifest, signature): the canonical JSON of a dataset's manifest and its HMAC."""
    hashed = content_hash(lines, order, value)
    snapshot = F.create_map(*[F.lit(x) for pair in sorted((guardrails or {}).items()) for x in pair]) if guardrails else F.create_map().cast("map<string,string>")
    row = hashed.select(
        F.lit(run_id).alias("run_id"),
        F.lit(version).alias("engine_version"),
        F.lit(created_at).alias("created_at"),
        F.lit(S.JOURNAL_VERSION).alias("schema_version"),
        F.concat(F.lit("sha256:"), "dataset_hash").alias("dataset_hash"),
        F.col("record_count").cast("bigint").alias("record_count"),
        F.lit("sha256:pending").alias("replay_hash"),
        F.lit("root").alias("signing_key_id"),
        F.lit("VERIFIED").alias("final_state"),
        F.lit(runtime).cast("bigint").alias("total_runtime_sec"),
        F.lit(events).cast("bigint").alias("event_count"),
        snapshot.alias("guardrail_snapshot"),
    )
    text = row.select(J.canonical(S.MANIFEST_KEYS).alias("manifest"))
    return text.select("manifest", crypto.hmac_sha256(F.col("manifest"), key).alias("signature"))


def seal(lines: DataFrame, path: str, run_id: str, key: str, created_at: str, order: str = "seq", value: str = "value") -> None:
    """Writes a dataset's lines in order, its manifest and signature under ``path``/``run_id``; an existing run is never overwritten."""
    verbatim(lines, f"{path}/{run_id}/dataset", value, [order])
    manifest(lines, run_id, key, created_at, order=order, value=value).write.json(f"{path}/{run_id}/manifest")
