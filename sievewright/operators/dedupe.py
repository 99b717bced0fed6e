"""Exact and near-exact deduplication where the first row wins.

The row that stays is a minimum by the order columns, taken in each task before
the one shuffle, so that a key that a third of all rows have is a row per task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import crypto
from ..functions.json import first_object

GRAM = 5
TOP = 10


def first_of(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """(order columns) of the first row of each key; rows of a null key are one key."""
    return rows.groupBy(*key).agg(F.min(F.struct(*order)).alias("_first")).select(*key, "_first.*")


def keep_first(rows: DataFrame, key: Column, order: list[str], columns: list[str] | None = None) -> DataFrame:
    """The first row of each key (null is a key too), with ``columns`` or all of its columns.

    Where order columns alone are asked for, only these travel. They may repeat or be null: nulls come first, and of rows with equal
    order the one with the least hash of the row stays.
    """
    from .ordering import row_hash

    names = columns or rows.columns
    if set(names) <= set(order):
        # the order columns of equal rows are equal, so that the least of them is the row
        least = rows.groupBy(key.alias("_key")).agg(F.min(F.struct(*order)).alias("_row"))
        return least.select(*(F.col("_row")[c].alias(c) for c in names))
    picked = F.struct(*(F.col(f"`{c}`") for c in names))
    found = rows.groupBy(key.alias("_key")).agg(F.min_by(picked, F.struct(*order, row_hash(rows).alias("_tie"))).alias("_row"))
    return found.select(*(F.col("_row")[c].alias(c) for c in names))


def exact_key(instruction: str = "instruction", output: str = "output") -> Column:
    return crypto.sample_hash(F.col(instruction), F.col(output))


def global_key(instruction: str = "instruction", input_text: str = "input", output: str = "output") -> Column:
    return crypto.global_hash(F.col(instruction), F.col(input_text), F.col(output))


@F.pandas_udf(T.StringType())
def _top_grams(text: pd.Series) -> pd.Series:
    def key(s: str | None) -> str:
        t = "".join((s or "").lower().split())
        if len(t) < GRAM:
            return t
        # Counter keeps the order of first occurrence among equal counts
        counts = Counter(map("".join, zip(*(t[i:] for i in range(GRAM)), strict=False)))
        return "".join(sorted(g for g, _ in counts.most_common(TOP)))

    return text.map(key, na_action=None)


def fuzzy_key(text: Column) -> Column:
    """SHA-256 of the ten most frequent character 5-grams of a text, in lower case and without white space.

    Grams are sorted; of equal counts, those that come first count. A text of
    fewer than five characters is its own key.
    """
    return F.sha2(_top_grams(text), 256)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _most_frequent(grams: Column) -> Column:
    """The TOP most frequent of an array of strings, the first ones of equal counts, in no order: runs of the sorted array are counted."""

    def of(all_grams: Column, ordered: Column) -> Column:
        first = F.transform(ordered, lambda g, i: F.when((i == 0) | (F.get(ordered, i - 1) != g), i))
        return _let(F.filter(first, lambda i: i.isNotNull()), lambda starts: runs(all_grams, ordered, starts))

    def runs(all_grams: Column, ordered: Column, starts: Column) -> Column:
        counts = F.transform(starts, lambda at, i: F.struct((F.coalesce(F.get(starts, i + 1), F.size(ordered)) - at).alias("n"), F.get(ordered, at).alias("g")))
        return _let(counts, lambda c: _let(F.get(F.sort_array(F.transform(c, lambda x: x["n"]), False), F.lit(TOP - 1)), lambda least: chosen(all_grams, c, least)))

    def chosen(all_grams: Column, counts: Column, least: Column) -> Column:
        more = F.transform(F.filter(counts, lambda x: x["n"] > least), lambda x: x["g"])
        even = F.transform(F.filter(counts, lambda x: x["n"] == least), lambda x: x["g"])
        # an intersection has the order of its first array
        some = _let(more, lambda m: F.concat(m, F.slice(F.array_intersect(all_grams, even), F.lit(1), TOP - F.size(m))))
        return F.when(least.isNull(), F.transform(counts, lambda x: x["g"])).otherwise(some)

    return _let(grams, lambda g: _let(F.sort_array(g), lambda ordered: of(g, ordered)))


def fuzzy_key_builtin(rows: DataFrame, id_col: str, text: Column) -> DataFrame:
    """(id, fuzzy key) as ``fuzzy_key``, in built-in functions alone, where the text lies: nothing is shuffled."""
    squeezed = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s+", "")

    def key(t: Column) -> Column:
        grams = _let(F.split(t, ""), lambda c: F.transform(F.slice(c, F.lit(1), F.size(c) - (GRAM - 1)), lambda x, i: F.concat(x, *(F.get(c, i + k) for k in range(1, GRAM)))))
        return F.when(F.length(t) < GRAM, t).otherwise(F.array_join(F.array_sort(_most_frequent(grams)), ""))

    return rows.select(F.col(id_col).alias("id"), F.sha2(_let(squeezed, key), 256).alias("fuzzy"))


def dedupe_samples(samples: DataFrame, order: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """The first of each group of samples with one fuzzy key of instruction and output.

    Equal texts have equal keys, so exact duplicates go with them.
    """
    text = F.concat(F.coalesce(F.col("instruction"), F.lit("")), F.coalesce(F.col("output"), F.lit("")))
    return keep_first(samples, fuzzy_key(text), order or ["seq"], columns)


def dedupe_global(samples: DataFrame, order: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """The first line of each (instruction, input, output) over all files, in the order of path and line."""
    return keep_first(samples, global_key(), order or ["path", "line_no"], columns)


def distinct_strings(rows: DataFrame, column: str, order: str = "seq") -> DataFrame:
    """(column, order) of the first occurrence of each string."""
    return rows.groupBy(column).agg(F.min(order).alias(order))


def unseen(rows: DataFrame, seen: DataFrame, key: str = "hash") -> DataFrame:
    """Rows whose key isn't among those seen."""
    return rows.join(seen.select(key).distinct(), key, "left_anti")


def unseen_objects(rows: DataFrame, seen: DataFrame, text: str = "response", order: str = "seq") -> DataFrame:
    """Rows whose first JSON object is new: not among the hashes seen, and the first of its kind."""
    hashed = rows.withColumn("hash", F.sha2(first_object(F.col(text)), 256)).where("hash is not null")
    return keep_first(unseen(hashed, seen), F.col("hash"), [order])


def stream_unseen(rows: DataFrame, key: str, time: str, delay: str = "1 hour") -> DataFrame:
    """A stream without repeats of a key within the delay."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def dedupe_ratio(rows: DataFrame, key: Column) -> DataFrame:
    """(total, distinct_keys, ratio); the ratio of no rows is 1."""
    counts = rows.select(key.alias("k")).agg(F.count("*").alias("total"), F.countDistinct(F.coalesce("k", F.lit(""))).alias("distinct_keys"))
    return counts.withColumn("ratio", F.when(F.col("total") > 0, F.col("distinct_keys") / F.col("total")).otherwise(1.0))


def pool(rows: DataFrame, column: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` of the distinct values, in an order that the seed shuffles."""
    return rows.select(column).distinct().orderBy(F.xxhash64(F.lit(seed), F.col(column)), column).limit(n)


def prefer(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """The rows of both by key, those of ``first`` where both have it."""
    both = first.withColumn("_rank", F.lit(0)).unionByName(second.withColumn("_rank", F.lit(1)), allowMissingColumns=True)
    columns = [c for c in both.columns if c not in (key, "_rank")]
    best = both.groupBy(key).agg(F.min_by(F.struct(*columns), "_rank").alias("_x"))
    return best.select(key, *(F.col("_x")[c].alias(c) for c in columns))


def latest(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key."""
    columns = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_x")).select(key, *(F.col("_x")[c].alias(c) for c in columns))
