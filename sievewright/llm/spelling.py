"""Spelling variants grouped by bands of a letter-parity mask.

A word's mask has a bit for each residue of code points modulo ``BITS``: whether
letters of that residue occur an odd number of times. One edit flips at most two
bits, so that of three bands of the mask at least one is equal. Words of equal
bands and of lengths that differ by one at most are candidates. One edit also
leaves the first or the last half of a word as it is, which cuts the groups of a
band further: a group is a band's value, a length and one half of the word. Each
pair is taken in the first group that it shares, masks that differ in over two
bits are left out, and the others are verified letter by letter.

Groups of over ``SPLIT`` words are cut into blocks by a hash of the word, and blocks
meet in pairs, so that no task gets a whole one. They are found by counting, first
by halves alone, so no pair is lost. Groups are compared in numpy, in slices
of a bounded number of pairs; pairs stay in their task but for those that are near.

``near_words`` and ``roots`` work on any table of words and counts. A null word is
left out, the empty word is a word, words may be of any length and alphabet, and
rows that repeat a word add up. An empty table gives no rows. Only the named
columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import shuffle_partitions, table, whole_groups, written
from ._text import mix, ranges

#: Bits of a mask, in three bands of equal width.
BITS = 96
#: Words of a group from which it is cut into blocks, and about the words of a block.
SPLIT = 4096
#: Pairs that are compared at once.
PAIRS = 1 << 20
#: Distinct words that a task holds before it hands on their counts.
HELD = 200_000

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_RATIO = 10
#: One occurrence in so many is misspelt by ``misspelt_counts``.
MISSPELT = 31

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_WORD = re.compile(f"[{LETTERS}]{{{LEAST_LENGTH},}}")


def misspelt_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of letters of whole texts, a share of them with a letter deleted, with their counts.

    Which words of a document lose which letter follows from a checksum of id and
    word, so all occurrences in a document fare alike and are counted first.
    Words of fewer than ``LEAST_LENGTH`` letters are left out before they are
    counted. A null text has no words; a null id is written as an empty one.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                start = zlib.crc32(f"{number}:".encode()) if number is not None else zlib.crc32(b":")
                # bytes.lower changes A-Z alone
                for word, n in Counter(_WORD.findall(text.encode().lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % MISSPELT == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < LEAST_LENGTH:
                            continue
                    total[word] += n
                if len(total) > HELD:
                    yield _counts(total)
                    total.clear()
        yield _counts(total)

    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _counts(total: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])


class Letters:
    """Words as one array of code points, with what a comparison needs of each."""

    def __init__(self, words: list[str]):
        self.points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.starts = np.cumsum(self.lengths) - self.lengths
        owner = np.repeat(np.arange(len(words)), self.lengths)
        bit = (self.points % BITS).astype(np.int64)
        odd = (np.bincount(owner * BITS + bit, minlength=len(words) * BITS) & 1).astype(np.uint8).reshape(-1, BITS)
        # neighbouring letters go to different bands, so that each band gets common ones
        self.bands = np.stack([np.packbits(odd[:, band::3], axis=1).view(">u4").ravel().astype(np.uint32) for band in range(3)])
        longest = int(self.lengths.max(initial=0))
        powers = np.cumprod(np.full(longest + 1, _BASE), dtype=np.uint64)
        self._inverse = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(longest, _INVERSE), dtype=np.uint64)])
        place = np.arange(len(self.points)) - np.repeat(self.starts, self.lengths)
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((self.points.astype(np.uint64) + np.uint64(1)) * powers[place], dtype=np.uint64)])

    def part(self, start: np.ndarray, length: np.ndarray, which: np.ndarray) -> np.ndarray:
        """A hash of ``length`` letters of words from place ``start``, equal for equal letters at any place."""
        at = self.starts[which] + start
        return mix((self._sums[at + length] - self._sums[at]) * self._inverse[start] + length.astype(np.uint64))

    def one_edit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether exactly one edit makes word ``b`` of ``a``; ``b`` is as long or longer by one."""
        first = self._equal_until(a, np.zeros(len(a), np.int64), b, np.zeros(len(a), np.int64))
        grown = self.lengths[b] - self.lengths[a]
        rest_a, rest_b = first + (grown == 0), first + 1
        ends = rest_a + self._equal_until(a, np.minimum(rest_a, self.lengths[a]), b, np.minimum(rest_b, self.lengths[b]))
        return (first < self.lengths[b]) & (ends >= self.lengths[a])

    def _equal_until(self, a: np.ndarray, from_a: np.ndarray, b: np.ndarray, from_b: np.ndarray) -> np.ndarray:
        """How many letters are equal from places of ``a`` and ``b`` on."""
        out = np.zeros(len(a), np.int64)
        most = np.minimum(self.lengths[a] - from_a, self.lengths[b] - from_b)
        left = np.flatnonzero(most > 0)
        while len(left):
            same = self.points[self.starts[a[left]] + from_a[left] + out[left]] == self.points[self.starts[b[left]] + from_b[left] + out[left]]
            left = left[same]
            out[left] += 1
            left = left[out[left] < most[left]]
        return out


def _halves(words: Letters, which: np.ndarray, base: np.ndarray, side: int) -> np.ndarray:
    """Hashes of the first or last ``base // 2`` letters of words, for groups of words of ``base`` and ``base + 1`` letters."""
    half = base // 2
    start = np.zeros_like(half) if side == 0 else words.lengths[which] - half
    return words.part(start, half, which)


def _roles(words: Letters) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words, base length) as the shorter or equal and as the longer one of a pair."""
    every = np.arange(len(words.lengths))
    yield every, words.lengths
    longer = every[words.lengths > 0]
    yield longer, words.lengths[longer] - 1


def _half_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = Letters(batch.column(0).to_pylist())
        for which, base in _roles(words):
            for side in (0, 1):
                yield pa.RecordBatch.from_arrays([pa.array(mix(_halves(words, which, base, side) + mix(base.astype(np.uint64) * np.uint64(2) + np.uint64(side))).view(np.int64))], names=["half"])


_KEYS = "half bigint, band int, value bigint, base int, word string, n bigint"


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = Letters(batch.column(0).to_pylist())
        for which, base in _roles(words):
            text, counts = batch.column(0).take(pa.array(which)), batch.column(1).take(pa.array(which))
            for side in (0, 1):
                half = mix(_halves(words, which, base, side) + mix(base.astype(np.uint64) * np.uint64(2) + np.uint64(side))).view(np.int64)
                for band in range(3):
                    arrays = [pa.array(half), pa.array(np.full(len(which), 2 * band + side, np.int32)), pa.array(words.bands[band, which].astype(np.int64)), pa.array(base.astype(np.int32)), text, counts]
                    yield pa.RecordBatch.from_arrays(arrays, names=["half", "band", "value", "base", "word", "n"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of sorted groups, once in each direction."""
    for held in whole_groups(batches, ["key"], 20_000):
        key, band, base, block = (held[c].combine_chunks().to_numpy() for c in ("key", "band", "base", "block"))
        text = held["word"].combine_chunks()
        words = Letters(text.to_pylist())
        ends = np.searchsorted(key, key, "right")
        counts = ends - np.arange(len(key)) - 1
        sums = np.concatenate([[0], np.cumsum(counts)])
        low = 0
        while low < len(key):
            high = max(low + 1, int(np.searchsorted(sums, sums[low] + PAIRS, "right")) - 1)
            one = np.repeat(np.arange(low, high), counts[low:high])
            two = ranges(np.arange(low, high) + 1, counts[low:high])
            low = high
            yield from _near(words, text, held["n"], one, two, band, base, block)


def _near(words: Letters, text: pa.Array, counts: pa.ChunkedArray, one: np.ndarray, two: np.ndarray, band: np.ndarray, base: np.ndarray, block: np.ndarray) -> Iterator[pa.RecordBatch]:
    apart = sum(np.bitwise_count(words.bands[i, one] ^ words.bands[i, two]) for i in range(3))
    shorter = np.minimum(words.lengths[one], words.lengths[two])
    # pairs of two longer words belong to another group, pairs within a block of several to one pair of blocks
    ok = (apart <= 2) & (shorter == base[one]) & ((block[one] < 0) | (block[one] != block[two]))
    one, two = one[ok], two[ok]
    swap = words.lengths[one] > words.lengths[two]
    a, b = np.where(swap, two, one), np.where(swap, one, two)
    half = words.lengths[a] // 2
    zero = np.zeros(len(a), np.int64)
    head = words.part(zero, half, a) == words.part(zero, half, b)
    first = np.full(len(a), 6)  # the first group that both are in: bands and, within one, halves
    for i in (2, 1, 0):
        equal = words.bands[i, a] == words.bands[i, b]
        tail = words.part(words.lengths[a] - half, half, a) == words.part(words.lengths[b] - half, half, b)
        first = np.where(equal & tail, 2 * i + 1, first)
        first = np.where(equal & head, 2 * i, first)
    mine = first == band[a]
    a, b = a[mine], b[mine]
    near = words.one_edit(a, b)
    a, b = a[near], b[near]
    if len(a):
        a, b = pa.array(np.concatenate([a, b])), pa.array(np.concatenate([b, a]))
        yield pa.RecordBatch.from_arrays([text.take(a), text.take(b), counts.take(b).combine_chunks()], names=["word", "near", "near_n"])


def near_words(words: DataFrame, split: int = SPLIT) -> DataFrame:
    """(word, near, near_n): each word of (word, n) with the words that one edit makes of it."""
    spark = words.sparkSession
    n = shuffle_partitions(spark)
    rows = words.where(F.col("word").isNotNull()).select("word", "n")
    keyed = rows.mapInArrow(_band_keys, _KEYS)
    hot = written(rows.mapInArrow(_half_keys, "half bigint").groupBy("half").count().where(F.col("count") > split).select("half"))
    if hot.isEmpty():
        keyed = keyed.withColumn("blocks", F.lit(None).cast("int"))
    else:
        group = ["half", "band", "value"]
        sizes = keyed.join(hot, "half", "left_semi").groupBy(*group).count().where(F.col("count") > split)
        keyed = keyed.join(written(sizes.select(*group, F.ceil(F.col("count") / split).cast("int").alias("blocks"))), group, "left")
    # a block meets itself and each other one: for block i, the pairs (i, j) of any j
    mine = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    other = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = keyed.withColumn("mine", F.coalesce(mine, F.lit(-1))).withColumn("other", other)
    pair = F.struct(F.least("mine", "other"), F.greatest("mine", "other"))
    # within the pair (i, i) all pairs count, within (i, j) those of different blocks
    dealt = dealt.withColumn("block", F.when(F.col("mine") == F.col("other"), F.lit(-1)).otherwise(F.col("mine")))
    dealt = dealt.select(F.xxhash64("half", "band", "value", pair).alias("key"), "band", "base", "block", "word", "n")
    return dealt.repartition(n, "key").sortWithinPartitions("key").mapInArrow(_pairs, "word string, near string, near_n bigint")


def forms(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n): a word's form is its most frequent near word, if that is ``ratio`` times as frequent.

    Of near words of one count the first in code-point order is taken.
    """
    own = words.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n"))
    own = written(own)
    near = near_words(own)
    best = F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))
    rows = own.select("word", "n", F.lit(None).cast(best_type()).alias("best")).unionByName(near.select("word", F.lit(None).cast("bigint").alias("n"), best.alias("best")))
    found = rows.groupBy("word").agg(F.max("n").alias("n"), F.count("best").alias("n_near"), F.min("best").alias("best"))
    n = -F.col("best.less")
    formed = n >= ratio * F.col("n")
    return found.select("word", "n", "n_near", F.when(formed, F.col("best.form")).alias("form"), F.when(formed, n).alias("form_n"))


def best_type() -> str:
    return "struct<less:bigint,form:string>"


def roots(found: DataFrame) -> DataFrame:
    """The rows of ``forms`` with ``root``: the last of the forms that follow from a word.

    A form is more frequent than its word by the ratio, so that forms make no
    circle; each round doubles the steps that are taken.
    """
    found = written(found)
    steps = written(found.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    while True:
        after = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = steps.join(after, "root", "left")
        moved = written(further.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        steps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return found.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each word of ``documents`` that occurs twice or more: word, n, n_near, form, form_n, root."""
    counts = misspelt_counts(table(spark, sf_dir, "documents"))
    found = roots(forms(counts.where(F.col("n") >= LEAST_COUNT)))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
