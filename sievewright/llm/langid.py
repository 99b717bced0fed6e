"""Language identification: multinomial naive Bayes over hashed character n-grams.

Features are the 1- to 3-grams of a text's characters, letters lower-cased and
all other runs turned into one space, hashed into ``DIM`` buckets for each
order. Training counts buckets per language in numpy, one row per task and
language block is summed by Spark, and the log-probability matrix (languages x
buckets) is broadcast. A matrix has at most ``BLOCK_LANGS`` languages, a bound of
79 MB; more languages are more matrices, each of which passes over the batches in
turn and hands on the best language so far. Scoring treats a batch as a sparse
matrix of documents by buckets, with the row bounds of the documents and an entry
per n-gram, times that matrix; long texts are read in pieces whose scores are
summed, and n-grams across two pieces count with the first. The prior of a
language is its share of the labelled texts.

Training takes at most about ``PER_LANG`` texts of a language, chosen by a hash of
the id; that bounds the fit, not what is scored. Labels are never an input of a
prediction.

A text that is null or has no letter is ``und`` with score 0. The score is the
language's posterior probability, with the logarithm of prior and likelihood taken
per letter and scaled by ``SHARPNESS`` letters at most, so that a long text isn't
certain by its length alone. Ties go to the first language by code point. Without any labelled
text, every text is ``und``. Repeated rows give repeated results.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text as T
from ._shared import unused

ORDERS = (1, 2, 3)
DIM = 1 << 15
PER_LANG = 5_000
#: Languages of one matrix.
BLOCK_LANGS = 200
SMOOTHING = 0.5
SHARPNESS = 100
UNDETERMINED = "und"

#: Characters that are scored at once, and entries of the sparse product.
_PIECE = 1 << 19
_ENTRIES = 1 << 22
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """Code point -> lower-cased code point, or a space where it is no letter."""
    global _letters
    if _letters is None:
        table = np.full(sys.maxunicode + 1, 32, np.uint32)
        for c in range(sys.maxunicode + 1):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                table[c] = ord(low[0])
        _letters = table
    return _letters


def _characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mapped characters of some texts and their bounds."""
    part = data[offsets[0] : offsets[-1]]
    points = np.frombuffer(part.tobytes().decode("utf-8").encode("utf-32-le", "surrogatepass"), np.uint32)
    leads = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
    return _letter_table()[points], leads[offsets - offsets[0]]


def _squeezed(chars: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of spaces as one, with a space at each text's start."""
    gap = chars == 32
    again = np.zeros(len(chars), bool)
    again[1:] = gap[1:] & gap[:-1]
    starts = bounds[:-1][bounds[:-1] < bounds[1:]]
    again[starts] = False
    kept = np.concatenate([[0], np.cumsum(~again)])
    return chars[~again], kept[bounds]


def _buckets(chars: np.ndarray, order: int) -> np.ndarray:
    """Bucket of each n-gram by its first character, offset by the order."""
    n = len(chars) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.full(n, order, np.uint64)
    for i in range(order):
        h = h * np.uint64(0x9E3779B97F4A7C15) + chars[i : i + n]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h >> np.uint64(40)) % np.uint64(DIM)).astype(np.int64) + ORDERS.index(order) * DIM


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
    """(low, high, characters, bounds, own) of row ranges.

    A long text comes as several pieces of one row, each with the characters that
    n-grams of its ``own`` first characters reach.
    """
    for low, high in T.slices(offsets, _PIECE):
        chars, bounds = _squeezed(*_characters(data, offsets[low : high + 1]))
        if high - low == 1 and len(chars) > 2 * _PIECE:
            for at in range(0, len(chars), _PIECE):
                part = chars[at : at + _PIECE + max(ORDERS) - 1]
                yield low, high, part, np.array([0, len(part)]), min(_PIECE, len(chars) - at)
        else:
            yield low, high, chars, bounds, len(chars)


def _grams(chars: np.ndarray, bounds: np.ndarray, own: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, bounds) per order of the n-grams that begin in the ``own`` first characters; they lie within a text."""
    for order in ORDERS:
        found = _buckets(chars, order)[:own]
        inner = np.maximum(bounds[1:] - order + 1, bounds[:-1])
        ok = np.ones(len(found), bool)
        for back in range(1, order):
            at = bounds[1:] - back
            at = at[(at >= bounds[:-1]) & (at < len(found))]
            ok[at] = False
        kept = np.concatenate([[0], np.cumsum(ok)])
        yield found[ok], np.stack([kept[np.minimum(bounds[:-1], len(found))], kept[np.minimum(inner, len(found))]])


def _add_rows(totals: np.ndarray, logs: np.ndarray, found: np.ndarray, bounds: np.ndarray) -> None:
    """Adds to each row i of totals the rows of logs at found[bounds[0, i]:bounds[1, i]], so many entries at a time."""
    whose = np.repeat(np.arange(bounds.shape[1]), bounds[1] - bounds[0])
    at = T.ranges(bounds[0], bounds[1] - bounds[0])
    step = max(_ENTRIES // logs.shape[1], 1)
    for low in range(0, len(at), step):
        part = whose[low : low + step]
        first = np.flatnonzero(np.diff(part, prepend=-1))
        totals[part[first]] += np.add.reduceat(logs[found[at[low : low + step]]], first, axis=0, dtype=np.float64)


def _counter(langs: list[str]):
    index = {x: i for i, x in enumerate(langs)}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            data, offsets = T.text_buffers(batch.column(0))
            lang = np.array([index[x] for x in batch.column(1).to_pylist()], np.int64)
            for low, _, chars, bounds, own in _pieces(data, offsets):
                for found, at in _grams(chars, bounds, own):
                    for i in range(at.shape[1]):
                        have = counts.setdefault(int(lang[low + i]), np.zeros(DIM * len(ORDERS), np.int64))
                        np.add.at(have, found[at[0, i] : at[1, i]], 1)
                if len(counts) > BLOCK_LANGS:
                    yield from emitted(counts)
        yield from emitted(counts)

    def emitted(counts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for i, have in counts.items():
            at = np.flatnonzero(have)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i, np.int32)), pa.array(at.astype(np.int32)), pa.array(have[at])], names=["lang", "bucket", "n"])
        counts.clear()

    return rows


class Model:
    """Languages, the log-probabilities of their buckets (buckets x languages) and of themselves."""

    def __init__(self, langs: list[str], logs: np.ndarray, prior: np.ndarray | None = None):
        self.langs, self.logs = langs, logs
        self.prior = np.zeros(logs.shape[1]) if prior is None else prior

    def block(self, low: int) -> Model:
        part = slice(low, low + BLOCK_LANGS)
        return Model(self.langs[part], np.ascontiguousarray(self.logs[:, part]), self.prior[part])


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", per_lang: int = PER_LANG) -> Model:
    """Fits on at most about ``per_lang`` texts of each language; rows of a null text or language are left out."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().toLocalIterator()}
    langs = sorted(sizes, key=lambda x: x.encode())
    logs = np.zeros((DIM * len(ORDERS), max(len(langs), 1)), np.float32)
    if not langs:
        return Model([], logs)
    share = F.create_map(*[x for lang in langs for x in (F.lit(lang), F.lit(min(1.0, per_lang / sizes[lang])))])
    drawn = F.pmod(F.xxhash64(F.lit("train"), F.col("id").cast("string")), F.lit(1_000_000)) / 1_000_000
    chosen = rows.where(drawn < F.coalesce(F.try_element_at(share, F.col("lang")), F.lit(0.0)))
    counts = chosen.select("text", "lang").mapInArrow(_counter(langs), "lang int, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = np.zeros(logs.shape)
    found = counts.toArrow()
    table[found["bucket"].to_numpy(), found["lang"].to_numpy()] = found["n"].to_numpy()
    for k in range(len(ORDERS)):
        part = table[k * DIM : (k + 1) * DIM] + SMOOTHING
        logs[k * DIM : (k + 1) * DIM] = np.log(part / part.sum(axis=0))
    n = np.array([sizes[x] for x in langs], float)
    return Model(langs, logs, np.log(n / n.sum()))


def score_texts(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihoods (texts x languages) and letters of each text."""
    n = len(offsets) - 1
    totals, letters = np.zeros((n, len(model.langs))), np.zeros(n, np.int64)
    for low, high, chars, bounds, own in _pieces(data, offsets):
        count = np.concatenate([[0], np.cumsum(chars[:own] != 32)])
        ends = np.minimum(bounds, own)
        letters[low:high] += count[ends[1:]] - count[ends[:-1]]
        for found, at in _grams(chars, bounds, own):
            _add_rows(totals[low:high], model.logs, found, at)
    return totals, letters


_STATE = ("lang", "total", "scaled", "odds")


def _predictor(model: Broadcast, first: bool, last: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of the batches' last columns (text and the state so far), the state with the languages of this matrix; the last one leaves out the text."""
        own = model.value
        names = np.array([*own.langs, UNDETERMINED], object)
        for batch in batches:
            k = batch.num_columns - 1 - (0 if first else len(_STATE))
            data, offsets = T.text_buffers(batch.column(k))
            totals, letters = score_texts(own, data, offsets)
            n = len(letters)
            if own.langs and n:
                totals += own.prior
                scaled = totals * (np.minimum(letters, SHARPNESS) / np.maximum(letters, 1))[:, None]
                best = totals.argmax(axis=1)
                total, at = totals[np.arange(n), best], scaled[np.arange(n), best]
                odds = np.exp(scaled - at[:, None]).sum(axis=1)
            else:
                best, total, at, odds = np.full(n, len(own.langs)), np.full(n, -np.inf), np.zeros(n), np.ones(n)
            lang = names[best]
            if not first and n:
                before = [batch.column(k + 1 + i).to_numpy(zero_copy_only=False) for i in range(len(_STATE))]
                keep = before[1] >= total
                more = np.where(keep, before[3] + odds * np.exp(at - before[2]), odds + before[3] * np.exp(before[2] - at))
                lang, total, at, odds = np.where(keep, before[0], lang), np.where(keep, before[1], total), np.where(keep, before[2], at), more
            lang, odds = np.where(letters == 0, UNDETERMINED, lang), np.where((letters == 0) | (total == -np.inf), np.inf, odds)
            state = [pa.array(lang, pa.string()), *(pa.array(x, pa.float64()) for x in (total, at, odds))]
            on = k if last else k + 1
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(on)), *state], names=[*batch.schema.names[:on], *(f"state_{c}" for c in _STATE)])

    return rows


def predict(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", named: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns ``keep`` of each row, with the language and score of its whole text under the names ``named``."""
    kinds = dict(docs.dtypes)
    held = [f"keep_{i}" for i in range(len(keep))]
    rows = docs.select(*(F.col(f"`{c}`").alias(h) for c, h in zip(keep, held, strict=True)), F.col(text_col).cast("string").alias("text"))
    state = "state_lang string, state_total double, state_scaled double, state_odds double"
    blocks = range(0, max(len(model.langs), 1), BLOCK_LANGS)
    for low in blocks:
        schema = ", ".join([*(f"{h} {kinds[c]}" for c, h in zip(keep, held, strict=True)), *([] if low == blocks[-1] else ["text string"]), state])
        rows = rows.mapInArrow(_predictor(docs.sparkSession.sparkContext.broadcast(model.block(low)), low == 0, low == blocks[-1]), schema)
    return rows.select(*(F.col(h).alias(c) for c, h in zip(keep, held, strict=True)), F.col("state_lang").alias(named[0]), (1 / F.col("state_odds")).alias(named[1]))


def fold(doc_id: Column) -> Column:
    """crc32 of the id's text modulo 3; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def fit_on_folds(docs: DataFrame, per_lang: int = PER_LANG) -> Model:
    """The model of the documents outside of fold 1; rows of a null id are not learned from."""
    return train(docs.where(fold(F.col("doc_id")) != 1), per_lang=per_lang)


def accept(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that have a language: predicted, and with a score of at least ``least``."""
    lang, score = unused(docs, "found_lang"), unused(docs, "found_score")
    scored = predict(docs, model, docs.columns, named=(lang, score))
    return scored.where((F.col(lang) != UNDETERMINED) & (F.col(score) >= least)).select(*(F.col(f"`{c}`") for c in docs.columns))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = predict(docs, fit_on_folds(docs), ["doc_id"])
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
