"""Positions, splits, samples and batches without sorting all rows in one task.

A global position is made in two steps: rows are cut by the order column into
ranges, ranges are counted, and each row's place in its range is added to the
rows before the range. A value that fills several ranges is cut further by a hash
of the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import arrays, text


def _ranges(spark: SparkSession) -> int:
    return 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounds_below(value: Column, bounds: list, kind: str = "bigint") -> Column:
    """How many of the sorted bounds are below the value, by bisection; 0 for null."""
    if not bounds:
        return F.lit(0)
    array = F.split(F.lit(",".join(map(str, bounds))), ",").cast(f"array<{kind}>")
    start = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))

    def step(acc: Column, _: Column) -> Column:
        middle = ((acc["low"] + acc["high"]) / 2).cast("int")
        above = value > F.get(array, middle)
        done = acc["low"] >= acc["high"]
        return F.struct(F.when(done | ~above, acc["low"]).otherwise(middle + 1).alias("low"), F.when(done | above, acc["high"]).otherwise(middle).alias("high"))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(len(bounds).bit_length() + 1)), start, step, lambda acc: acc["low"])
    return F.when(value.isNull(), F.lit(0)).otherwise(found)


def row_hash(rows: DataFrame) -> Column:
    """A hash of the whole row; maps count by their entries."""
    return F.xxhash64(*(F.map_entries(f"`{c}`") if t.startswith("map<") else F.col(f"`{c}`") for c, t in rows.dtypes))


def ranged(rows: DataFrame, order: str, ranges: int | None = None, tie: str | None = None) -> DataFrame:
    """``rows`` with ``_tie``, a hash of the row (or the number ``tie``), and ``_range``, which rises with ``order`` (a number, nulls first) and then with the hash."""
    n = ranges or _ranges(rows.sparkSession)
    cuts = [i / n for i in range(1, n)]
    stats = rows.agg(F.percentile_approx(order, cuts, max(10_000, 20 * n)).alias("cuts"), F.count("*").alias("n"), F.count(order).alias("valued")).first() if cuts else None
    bounds = (stats.cuts if stats else None) or []
    # rows without an order have as many ranges of their own, before all others, as their number asks for
    nulls = -(-(stats.n - stats.valued) * n // stats.n) if stats and stats.n else 0
    share_of = lambda k: F.floor((F.col("_tie") / F.lit(2.0**64) + 0.5) * k)
    distinct = sorted(set(bounds))
    times = [bounds.count(b) for b in distinct]
    most = max(times, default=1)
    tied = rows.withColumn("_tie", F.col(tie) if tie else row_hash(rows))
    first = share_of(nulls) - (nulls + 1) if nulls else F.lit(0)
    if not distinct:
        return tied.withColumn("_range", first.cast("bigint"))
    kind = rows.schema[order].dataType.simpleString()
    at = tied.withColumn("_below", bounds_below(F.col(order), distinct, kind))
    # a bound that is met several times has so many ranges of its own, behind the values below it
    bound, share = (F.get(F.split(F.lit(",".join(map(str, x))), ",").cast(f"array<{k}>"), F.col("_below")) for x, k in ((distinct, kind), (times, "int")))
    own = F.when((share > 1) & (F.col(order) == bound), 1 + share_of(share)).otherwise(0)
    number = F.col("_below").cast("bigint") * (most + 2) + F.coalesce(own, F.lit(0))
    return at.withColumn("_range", F.when(F.col(order).isNull(), first).otherwise(number).cast("bigint")).drop("_below")


def positioned(rows: DataFrame, order: str, name: str = "position", ranges: int | None = None, tie: str | None = None) -> DataFrame:
    """``rows`` with their place from 0 in ascending ``order``, a column of numbers; nulls come first, equal ones by a hash of the row or by ``tie``."""
    cut = ranged(rows, order, ranges, tie)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy("_range").count().select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(F.col(order).asc_nulls_first(), "_tie")) - 1
    return cut.join(F.broadcast(counts), "_range").withColumn(name, (F.col("_before") + place).cast("bigint")).drop("_range", "_before", "_tie")


def validation_rows(total: int, ratio: float, minimum: int = 1) -> int:
    """Rows for validation: the share, rounded down, but ``minimum`` at least; none of fewer than two rows."""
    return 0 if total < 2 else max(minimum, int(total * ratio))


def split_tail(rows: DataFrame, order: str, ratio: float = 0.1) -> DataFrame:
    """``rows`` with ``split``: the last share of them in order is ``val``, all before ``train``.

    Only the order column and a hash of each row are moved to find the border.
    Rows without an order come first; equal rows stay on one side.
    """
    total = rows.count()
    held = validation_rows(total, ratio)
    if not held:
        return rows.withColumn("split", F.lit("train"))
    placed = positioned(rows.select(F.col(order).alias("_v"), row_hash(rows).alias("_h")), "_v", "_at", tie="_h")
    border = placed.where(F.col("_at") == total - held).first()
    ahead = F.col(order) > F.lit(border._v) if border._v is not None else F.col(order).isNotNull()
    late = F.coalesce(ahead, F.lit(False)) | (F.col(order).eqNullSafe(F.lit(border._v)) & (row_hash(rows) >= border._h))
    return rows.withColumn("split", F.when(late, "val").otherwise("train"))


def hash_order(key: Column, seed: int = 42) -> Column:
    """A fixed pseudo-random order: the first 15 hex digits of MD5 over seed and key, as a number."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 15), 16, 10).cast("bigint")


def split_shuffled(rows: DataFrame, key: str, ratio: float = 0.1, seed: int = 42) -> DataFrame:
    """``rows`` with ``split``: a share of them, by a seeded hash of the key, is ``val``; one at least."""
    total = rows.count()
    held = max(1, int(total * ratio))
    placed = positioned(rows.withColumn("_h", hash_order(F.col(key), seed)), "_h", "_at")
    return placed.withColumn("split", F.when(F.col("_at") < held, "val").otherwise("train")).drop("_h", "_at")


def top(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows; each task hands on ``n`` at most."""
    return rows.orderBy(*order).limit(n)


def last_events(events: DataFrame, n: int, order: str = "seq") -> DataFrame:
    return top(events, [F.desc(order)], n)


def newest(rows: DataFrame, time: str = "modified", tie: str = "path") -> DataFrame:
    return top(rows, [F.desc(time), F.asc(tie)], 1)


def shuffled_limit(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    return top(rows, [hash_order(F.col(key), seed), F.col(key)], n)


def top_by_group(rows: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def latest_checkpoint(names: DataFrame, column: str = "name", numeric: bool = False) -> DataFrame:
    """The last checkpoint's name: by text, or by the number in it."""
    number = F.regexp_extract(F.col(column), r"(\d+)$", 1).try_cast("bigint")
    best = F.max_by(F.col(column), F.struct(number, F.col(column))) if numeric else F.max(column)
    return names.agg(best.alias(column))


def per_repo_budget(max_requests: Column, repos: Column, rounds: Column) -> Column:
    """Samples for each repository and round: the whole part of the share, one at least."""
    return F.greatest(F.lit(1), F.floor(max_requests / F.greatest(repos * rounds, F.lit(1))))


def batches(rows: DataFrame, order: str, size: int, columns: list[str]) -> DataFrame:
    """(batch, items): runs of ``size`` rows in order, each an array of structs."""
    placed = positioned(rows, order, "_at")
    grouped = placed.groupBy(F.floor(F.col("_at") / size).alias("batch"))
    return grouped.agg(F.array_sort(F.collect_list(F.struct("_at", *columns))).alias("items")).select("batch", F.transform("items", lambda x: F.struct(*(x[c].alias(c) for c in columns))).alias("items"))


def training_batches(rows: DataFrame, order: str, size: int, ids: str = "ids", pad: int = 0, most: int = 2048) -> DataFrame:
    """``rows`` with ``batch`` and the training arrays of their token ids, filled up to the longest of their batch of ``size`` rows in order."""
    placed = positioned(rows, order, "_at").withColumn("batch", F.floor(F.col("_at") / size)).drop("_at")
    longest = F.max(F.least(F.size(ids), F.lit(most))).over(Window.partitionBy("batch"))
    return placed.withColumn("_length", longest).withColumn("x", arrays.training_arrays(F.col(ids), F.col("_length"), pad, most)).select(*rows.columns, "batch", "x.*")


def batch_requests(samples: DataFrame, order: str, size: int, max_tokens: int = 256) -> DataFrame:
    """(batch, request): one request for each ``size`` samples (id, instruction, input) in order."""
    return batches(samples, order, size, ["id", "instruction", "input"]).select("batch", text.batch_request(F.col("items"), max_tokens).alias("request"))


def specs(spark: SparkSession, n: int, codes: list[str], seed: int = 42, round_no: int = 1) -> DataFrame:
    """``n`` generation requests: id, task type, instruction and template, and a code sample, chosen by a seeded hash."""
    index = F.col("idx")
    pick = lambda salt, k: hash_order(F.concat(F.lit(f"{salt}:"), index.cast("string")), seed) % k
    tasks = spark.createDataFrame([(i, *t) for i, t in enumerate(S.TEMPLATES)], "task bigint, task_type string, instruction string, template string")
    rows = spark.range(n).withColumnRenamed("id", "idx").withColumn("task", pick("task", len(S.TEMPLATES))).withColumn("code", F.element_at(F.array(*map(F.lit, codes)), (pick("code", len(codes)) + 1).cast("int")))
    return rows.join(F.broadcast(tasks), "task").select(F.format_string("round_%d_%04d", F.lit(round_no), index).alias("id"), "idx", "task_type", "instruction", "template", "code")
