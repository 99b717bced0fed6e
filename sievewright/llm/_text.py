"""Vectorised text helpers for Arrow batches: word spans and 64-bit word hashes.

All functions work on the raw UTF-8 buffers of a string column, so that no
Python string is made per word. Texts that are null count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are tokenised at once; bounds the memory of a task.
SLICE_BYTES = 1 << 21

_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _table(words: list[tuple[int, int]]) -> np.ndarray:
    """Byte -> lower-cased byte, or 0 for bytes that separate words."""
    table = np.zeros(256, np.uint8)
    for low, high in words:
        table[low : high + 1] = np.arange(low, high + 1)
    upper = np.arange(0x41, 0x5B)
    table[upper] = np.where(table[upper + 32] > 0, upper + 32, 0)
    return table


#: Words of letters and digits: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
ALNUM = _table([(0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)])
#: Words between white space: ``[^\x20\x09-\x0D]+`` after lower-casing A-Z; NUL counts as a letter.
SPACED = _table([(0x01, 0x08), (0x0E, 0x1F), (0x21, 0xFF)])
SPACED[0] = 0xFF


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n + 1 offsets of a string array, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), at


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, or of one longer text."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, SLICE_BYTES + 1)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _BASE)]), dtype=np.uint64)
        _inverse = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, inverse)]), dtype=np.uint64)
    return _powers, _inverse


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``.

    Returns starts and ends (byte positions in ``data``), a 64-bit hash per word
    and the n + 1 bounds of each text's words.
    """
    first, last = int(offsets[0]), int(offsets[-1])
    mapped = table[data[first:last]]
    n = len(mapped)
    inside = np.zeros(n + 2, bool)
    np.not_equal(mapped, 0, out=inside[1:-1])
    at = offsets - first
    opens = np.zeros(n + 1, bool)
    opens[at] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | opens))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | opens))
    powers, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mapped.astype(np.uint64) * powers[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return starts + first, ends + first, hashes, np.searchsorted(starts, at)


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words by its first word; fewer than k words give none."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = mix(total * np.uint64(0x100000001B3) + words[i : i + n])
    return total


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(start, start + count)``."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)
