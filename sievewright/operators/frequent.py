"""The most frequent character n-grams of a corpus, exactly, without a shuffle of every gram.

First pass: each task keeps a summary of at most ``counters`` grams (Misra-Gries, in its mergeable
form: the count that is left out last is taken off all). A count in a summary is too low by what
was taken off, and no gram outside of it occurs more often than that. Summed over tasks,
each gram of the corpus has a lower bound and a common error E.

With L the k-th largest lower bound, the k-th most frequent gram occurs L times or more. If L > E,
every gram that does is in some summary, and has a bound of L - E at least: these are the
candidates. The second pass counts the candidates alone, in all texts. If L <= E, as with
texts without frequent grams, the bounds tell nothing and all grams are counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Grams in the summary of a task, and candidates that are broadcast (some 10 MB); more of them are joined as Spark sees fit.
COUNTERS = 1 << 16
FEW = 100_000
#: Code points that are counted at once.
SLICE = 1 << 21
#: Grams of no text: the row that carries a task's error.
SUMMARY = "gram string, n bigint, error bigint"


def _slices(texts: list[str], size: int, most: int) -> Iterator[list[str]]:
    """Texts in groups of bounded length; a long one in pieces that share ``size`` - 1 code points."""
    held, length = [], 0
    for text in texts:
        for start in range(0, max(1, len(text) - size + 1), most):
            piece = text[start : start + most + size - 1]
            if len(piece) < size:
                continue
            if held and length + len(piece) > most:
                yield held
                held, length = [], 0
            held.append(piece)
            length += len(piece)
    if held:
        yield held


def gram_table(texts: list[str], size: int, most: int = SLICE) -> Iterator[tuple[list[str], np.ndarray]]:
    """Distinct grams and their counts, of groups of texts: code points are ranked, and ranks packed into one number a gram."""
    for held in _slices(texts, size, most):
        joined = "".join(held)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        letters, ranks = np.unique(codes, return_inverse=True)
        span = len(letters)
        key = ranks[: len(ranks) - size + 1].astype(np.int64)
        wide = span
        for i in range(1, size):
            if wide >= 2**62 // span:
                distinct, key = np.unique(key, return_inverse=True)
                wide = len(distinct)
            key = key * span + ranks[i : len(ranks) - size + 1 + i]
            wide *= span
        # grams that begin in the last code points of a text would reach into the next
        inside = np.ones(len(key), bool)
        ends = np.cumsum([len(t) for t in held])[:-1]
        for i in range(1, size):
            inside[ends - i] = False
        at = np.flatnonzero(inside)
        _, first, counts = np.unique(key[at], return_index=True, return_counts=True)
        yield [joined[p : p + size] for p in at[first].tolist()], counts


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t for t in batch.column(0).to_pylist() if t]


def _counted(rows: DataFrame, column: str, size: int) -> DataFrame:
    """(gram, n): counts of parts of the texts, several of a gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grams, counts in gram_table(_texts(batch), size):
                yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array(counts, pa.int64())], ["gram", "n"])

    return rows.select(column).mapInArrow(run, "gram string, n bigint")


def reduced(summary: dict[str, int], counters: int) -> tuple[dict[str, int], int]:
    """The summary cut to ``counters`` grams, and what was taken off each."""
    if len(summary) <= counters:
        return summary, 0
    counts = np.fromiter(summary.values(), np.int64, len(summary))
    off = int(np.partition(counts, len(counts) - counters - 1)[len(counts) - counters - 1])
    return {g: n - off for g, n in summary.items() if n > off}, off


def summaries(rows: DataFrame, column: str, size: int, counters: int = COUNTERS) -> DataFrame:
    """(gram, n, error): the summary of each task, and a row without a gram that holds its error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, error = {}, 0
        for batch in batches:
            for grams, counts in gram_table(_texts(batch), size):
                for gram, n in zip(grams, counts.tolist(), strict=True):
                    summary[gram] = summary.get(gram, 0) + n
                summary, off = reduced(summary, counters)
                error += off
        names, counts = [*summary, None], [*summary.values(), 0]
        for i in range(0, len(names), 10_000):
            part = names[i : i + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array(counts[i : i + 10_000], pa.int64()), pa.array([error if g is None else 0 for g in part], pa.int64())], ["gram", "n", "error"])

    return rows.select(column).mapInArrow(run, SUMMARY)


def candidates(found: DataFrame, k: int) -> DataFrame | None:
    """(gram) that may be among the ``k`` most frequent, of summaries; None where the bounds can't tell."""
    bounds = found.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("error").alias("error"))
    error = bounds.where("gram is null").agg(F.coalesce(F.sum("error"), F.lit(0))).first()[0]
    largest = bounds.where("gram is not null").select("n").orderBy(F.desc("n")).limit(k).agg(F.count("*").alias("k"), F.min("n").alias("n")).first()
    least = largest.n if largest.k == k else 0
    if error and least <= error:
        return None
    return bounds.where((F.col("n") >= least - error) & F.col("gram").isNotNull()).select("gram")


def top_grams(rows: DataFrame, column: str, k: int, size: int = 5, counters: int = COUNTERS) -> DataFrame:
    """(rank, gram, n): the ``k`` most frequent n-grams of ``size`` code points over all texts, ties by the gram.

    Texts that are null or shorter than a gram have none; fewer grams than ``k`` are all returned. ``column`` is a string.
    """
    counted = _counted(rows, column, size)
    # the summaries are read three times
    found = summaries(rows, column, size, counters).persist()
    wanted = candidates(found, k)
    if wanted is not None:
        few = wanted.count() <= FEW
        counted = counted.join(F.broadcast(wanted) if few else wanted, "gram", "left_semi")
    totals = counted.groupBy("gram").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "gram").limit(k)
    ranked = totals.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "gram"))).alias("top"))  # k rows
    return ranked.select(F.posexplode("top").alias("at", "x")).select((F.col("at") + 1).alias("rank"), F.col("x.gram").alias("gram"), (-F.col("x.m")).alias("n"))
