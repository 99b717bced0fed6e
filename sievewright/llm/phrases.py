"""Phrase collocations, mined in partitions of pivot words.

Each phrase belongs to its rarest word, its pivot. ``phrase_counts`` rewrites texts
to fragments: around each word, what stands next to it up to the first rarer word,
the end of the piece, or the longest phrase that is asked for. A fragment goes to
its pivot's partition, which mines it for the phrases that hold the pivot, so that
every occurrence of a phrase is counted once and in one place. Equal fragments of
a task travel as one with their number.

Which word is rarer is told by counts of ``WORD_BUCKETS`` buckets of words, with a
word's hash to settle equal ones; two words in a row that a bit table of
``PAIR_BITS`` buckets knows to be rare end a fragment, as no frequent phrase holds
them. Both tables have a fixed size, whatever the corpus; buckets that words share
only make more fragments. A pivot of over ``HOT`` occurrences is dealt over several
partitions by its fragments, whose counts are added at the end; so no partition
gets more than ``HOT`` fragments of a word, and none counts more than ``COUNTED`` phrases at once.

Words and pieces are told apart by 64-bit hashes where a task counts them, and by
their texts wherever counts of tasks meet.

Null and empty texts have no words; a null language is ``und``. Repeated rows count
each. A text of any length is read whole, in slices of ``SLICE`` bytes or of one
text. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import _text as T
from ._shared import shuffle_partitions, table, written

WORD_BUCKETS = 1 << 20
PAIR_BITS = 1 << 26
#: Occurrences of a pivot from which its fragments are dealt over several partitions; words so common have few commoner ones.
HOT = 1_000_000
#: Phrases that a task counts at once; more are handed on as they are.
COUNTED = 500_000
#: Bytes of text whose equal words, pairs and fragments a task brings together.
SLICE = 1 << 21
#: Pairs of words that a task brings together before it hands on their counts.
HELD = 1 << 21

LONGEST = 5
LEAST = 100
MOST = 2000
UNKNOWN = "und"

BREAKS = b".,;:!?\n\x0b\x0c\r"
_IS_BREAK = np.isin(np.arange(256), np.frombuffer(BREAKS, np.uint8))
_WORDS = np.where(_IS_BREAK | np.isin(np.arange(256), [0x20, 0x09]), 0, np.arange(256)).astype(np.uint8)
_WORDS[0x41:0x5B] += 32
_WORDS[0] = 0xFF  # a byte that no text has


def _rows(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).cast("string").alias("text"))


class Slice:
    """The words of some texts: their places in the bytes, hashes with the language, and where a new piece begins."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, codes: np.ndarray):
        self.raw = data[int(offsets[0]) : int(offsets[-1])].tobytes()
        self.starts, self.ends, hashes, bounds = T.word_spans(data, offsets, _WORDS)
        self.lang = np.repeat(langs, np.diff(bounds))
        self.hashes = T.mix(hashes + codes[self.lang])
        n, first = len(self.starts), int(offsets[0])
        self.opens = np.ones(n, bool)
        if n:
            breaks = np.concatenate([[0], np.cumsum(_IS_BREAK[data[first : int(offsets[-1])]])])
            self.opens[1:] = breaks[self.starts[1:] - first] > breaks[self.ends[:-1] - first]
            self.opens[bounds[:-1][bounds[:-1] < n]] = True
            self.starts, self.ends = self.starts - first, self.ends - first

    def pairs(self) -> np.ndarray:
        """A hash of each word and the next; of words in different pieces it means nothing."""
        return T.mix(self.hashes[:-1] * np.uint64(3) + self.hashes[1:])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], Slice]]:
    for batch in batches:
        names = batch.column(0).dictionary_encode()
        kinds = names.dictionary.to_pylist()
        codes = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in kinds], np.uint64)
        data, offsets = T.text_buffers(batch.column(1))
        langs = names.indices.to_numpy()
        for low, high in T.slices(offsets, SLICE):
            yield kinds, Slice(data, offsets[low : high + 1], langs[low:high], codes)


def word_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, word, hash, n): all words of a language with their counts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kinds, part in _slices(batches):
            hashes, at, n = np.unique(part.hashes, return_index=True, return_counts=True)
            words = [part.raw[a:b].lower().decode() for a, b in zip(part.starts[at].tolist(), part.ends[at].tolist())]
            langs = pa.array(kinds, pa.string()).take(pa.array(part.lang[at]))
            yield pa.RecordBatch.from_arrays([langs, pa.array(words, pa.string()), pa.array(hashes.view(np.int64)), pa.array(n)], names=["lang", "word", "hash", "n"])

    found = _rows(docs, lang_col, text_col).mapInArrow(counted, "lang string, word string, hash bigint, n bigint")
    return found.groupBy("lang", "word", "hash").agg(F.sum("n").alias("n"))


def _totals(words: DataFrame) -> np.ndarray:
    """Occurrences by bucket of words: a table of ``WORD_BUCKETS`` numbers."""
    rows = words.groupBy(F.shiftrightunsigned("hash", 44).alias("bucket")).agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(WORD_BUCKETS, np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def _frequent_pairs(docs: DataFrame, least: int, lang_col: str, text_col: str) -> np.ndarray:
    """Whether the pairs of words of a bucket occur ``least`` times together: ``PAIR_BITS`` bits, 64 to a number."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, part in _slices(batches):
            held.append((part.pairs()[~part.opens[1:]] >> np.uint64(38)).astype(np.int32))
            size += len(held[-1])
            if size >= HELD:
                yield _summed(held)
                held, size = [], 0
        if size:
            yield _summed(held)

    found = _rows(docs, lang_col, text_col).mapInArrow(counted, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    rows = found.where(F.col("n") >= least).groupBy(F.shiftright("bucket", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, bucket % 64))").alias("bits")).toArrow()
    out = np.zeros(PAIR_BITS // 64, np.int64)
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return out


def _summed(buckets: list[np.ndarray]) -> pa.RecordBatch:
    found, n = np.unique(np.concatenate(buckets), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["bucket", "n"])


def _reach(part: Slice, totals: np.ndarray, pairs: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words to the left and right of each that its fragment holds, and its bucket's count."""
    n, h = len(part.hashes), part.hashes
    weight = totals[(h >> np.uint64(44)).astype(np.int64)]
    joined = np.zeros(n, bool)  # with the word before
    bucket = (part.pairs() >> np.uint64(38)).astype(np.int64)
    joined[1:] = ~part.opens[1:] & (pairs[bucket >> 6] >> (bucket & 63) & 1).astype(bool)
    left, right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    on_left, on_right = np.ones(n, bool), np.ones(n, bool)
    for d in range(1, min(longest, n)):
        commoner = (weight[:-d] > weight[d:]) | ((weight[:-d] == weight[d:]) & (h[:-d] > h[d:]))
        # a word's own repeat is taken to the right, so that a phrase belongs to the first place of its pivot
        rarer = (weight[d:] < weight[:-d]) | ((weight[d:] == weight[:-d]) & (h[d:] < h[:-d]))
        on_left[d:] &= commoner & joined[1 : n - d + 1]
        on_left[:d] = False
        on_right[:-d] &= ~rarer & joined[d:]
        on_right[n - d :] = False
        left += on_left
        right += on_right
    return left, right, weight


_FRAGMENT = "lang string, key bigint, whole boolean, before int, words string, n bigint"


def _fragments(docs: DataFrame, totals: np.ndarray, pairs: np.ndarray, longest: int, hot: int, lang_col: str, text_col: str) -> DataFrame:
    """(lang, key, whole, before, words, n): fragments with the words before the pivot; ``key`` has those of a pivot or, where they aren't ``whole``, a share of them."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((totals, pairs))

    def rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, pairs = sent.value
        for kinds, part in _slices(batches):
            left, right, weight = _reach(part, totals, pairs, longest)
            at = np.flatnonzero(left + right > 0)
            mark = T.mix(part.hashes[at] + left[at].astype(np.uint64))
            for d in range(1, longest):
                for near, place in ((left, at - d), (right, at + d)):
                    held = near[at] >= d
                    mark[held] = T.mix(mark[held] * np.uint64(0x100000001B3) + part.hashes[place[held]])
            mark, first, n = np.unique(mark, return_index=True, return_counts=True)
            at = at[first]
            shares = -(-weight[at] // hot)
            key = T.mix(part.hashes[at] + (mark % np.maximum(shares, 1).astype(np.uint64)))
            spans = zip(part.starts[at - left[at]].tolist(), part.ends[at + right[at]].tolist())
            words = [b" ".join(part.raw[a:b].lower().split()).decode() for a, b in spans]
            langs = pa.array(kinds, pa.string()).take(pa.array(part.lang[at]))
            arrays = [langs, pa.array(key.view(np.int64)), pa.array(shares <= 1), pa.array(left[at].astype(np.int32)), pa.array(words, pa.string()), pa.array(n)]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "key", "whole", "before", "words", "n"])

    return _rows(docs, lang_col, text_col).mapInArrow(rewritten, _FRAGMENT)


def phrase_counts(docs: DataFrame, words: DataFrame, least: int = LEAST, longest: int = LONGEST, hot: int = HOT, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, phrase, a): phrases of 2 to ``longest`` words that occur ``least`` times or more; ``words`` as ``word_counts`` has them."""
    pairs = _frequent_pairs(docs, least, lang_col, text_col)
    fragments = _fragments(docs, _totals(words), pairs, longest, hot, lang_col, text_col)

    def mined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, found, whole = None, Counter(), True
        for batch in batches:
            for lang, key, all_here, before, text, n in zip(*(batch.column(c).to_pylist() for c in range(6))):
                if key != now:
                    yield from _mined(found, whole, least)
                    now, found, whole = key, Counter(), True
                whole &= all_here
                if len(found) > COUNTED:
                    whole = False
                    yield from _mined(found, whole, least)
                    found.clear()
                parts = text.split(" ")
                for start in range(before + 1):
                    for end in range(max(before + 1, start + 2), min(len(parts), start + longest) + 1):
                        found[lang, " ".join(parts[start:end])] += n
        yield from _mined(found, whole, least)

    dealt = fragments.repartition(shuffle_partitions(docs.sparkSession), "key").sortWithinPartitions("key")
    counts = dealt.mapInArrow(mined, "lang string, phrase string, n bigint")
    return counts.groupBy("lang", "phrase").agg(F.sum("n").alias("a")).where(F.col("a") >= least)


def _mined(found: Counter, whole: bool, least: int) -> Iterator[pa.RecordBatch]:
    """The phrases of a pivot: those that are frequent, or all where other partitions have more of them."""
    kept = [(lang, phrase, n) for (lang, phrase), n in found.items() if n >= least or not whole]
    if kept:
        langs, phrases, n = zip(*kept)
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(n, pa.int64())], names=["lang", "phrase", "n"])


#: Exact while a and n stay below 10^17 and l and r below 10^19.
_SCORE = "(cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
_SALTS = 16


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, most: int = MOST, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``most`` phrases of largest score, as cut where it is least.

    A phrase inside a longer one that occurs as often is left out. It's enough to
    look at phrases longer by one word: what lies inside a longer one lies in one
    of these, whose count is between theirs.
    """
    words = written(word_counts(docs, lang_col, text_col))
    found = written(phrase_counts(docs, words, least, longest, lang_col=lang_col, text_col=text_col))
    # the few languages meet their phrases in several keys each, so that a frequent one is no hot key
    totals = words.groupBy("lang").agg(F.sum("n").alias("n")).select("lang", "n", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    known = words.where(F.col("n") >= least).select("lang", F.col("word").alias("phrase"), F.col("n").alias("f")).unionByName(found.select("lang", "phrase", F.col("a").alias("f")))
    split = found.withColumn("w", F.split("phrase", " ")).withColumn("m", F.size("w"))
    inner = F.explode(F.array(F.expr("slice(w, 1, m - 1)"), F.expr("slice(w, 2, m - 1)")))
    longer = split.where(F.col("m") > 2).select("lang", "a", inner.alias("w")).groupBy("lang", F.array_join("w", " ").alias("phrase")).agg(F.max("a").alias("longer"))
    kept = split.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") < F.col("a")))
    cuts = kept.select("lang", "phrase", "a", "w", F.explode(F.expr("sequence(1, m - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)).cast("int").alias("salt"), F.array_join(F.expr("slice(w, 1, k)"), " ").alias("first"), F.array_join(F.expr("slice(w, k + 1, size(w))"), " ").alias("rest")
    )
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    scored = cuts.join(totals, ["lang", "salt"]).withColumn("score", F.expr(_SCORE))
    least_cut = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = least_cut.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 phrases of each language of ``documents`` that are bound most: lang, rank, phrase, a, l, r, n, score."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = rf"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, m, unnest([array_to_string(ws[i:i + m - 1], ' ') FOR i IN range(1, len(ws) - m + 2)]) AS phrase FROM w, (SELECT unnest(range(1, {LONGEST + 1})) AS m)),
f AS (SELECT lang, phrase, m, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND f >= {LEAST}),
kept AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c d WHERE d.lang = c.lang AND d.m > c.m AND 100 * d.a >= 100 * c.a AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' '))),
k AS (SELECT *, unnest(range(1, m)) AS k FROM kept),
s AS (SELECT k.lang, k.phrase, k.a, k.k, x.f AS l, y.f AS r, n.n, CAST(1000::HUGEINT * k.a * n.n // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(ws[1:k.k], ' ') JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(ws[k.k + 1:], ' ') JOIN n ON n.lang = k.lang),
o AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM o QUALIFY rank <= {MOST}"""
