"""Functions over numeric arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sorted_floats(values: Column) -> Column:
    """The numbers in ascending order."""
    return F.array_sort(values)


def transposed(flat: Column) -> Column:
    """The transpose of a square matrix given row by row; an error if the size is no square."""
    n = F.round(F.sqrt(F.size(flat))).cast("int")
    square = F.when(n * n == F.size(flat), n).otherwise(F.raise_error(F.lit("the matrix isn't square")).cast("int"))
    return F.transform(F.sequence(F.lit(0), F.size(flat) - 1), lambda k: F.get(flat, (k % square) * square + F.floor(k / square).cast("int")))


def padded(ids: Column, length: Column, pad: int, most: int) -> Column:
    """Token ids cut at ``most`` and filled up to ``length``."""
    cut = F.slice(ids, 1, most)
    return F.concat(cut, F.array_repeat(F.lit(pad), F.greatest(length - F.size(cut), F.lit(0))))


def training_arrays(ids: Column, length: Column, pad: int, most: int) -> Column:
    """(input_ids, attention_mask, labels): ids cut at ``most`` and filled up to ``length``; labels are a copy of the ids, fill included."""
    filled = padded(ids, length, pad, most)
    mask = padded(F.transform(F.slice(ids, 1, most), lambda _: F.lit(1)), length, 0, most)
    return F.struct(filled.alias("input_ids"), mask.alias("attention_mask"), filled.alias("labels"))


def nearest_rank(values: Column, share: float) -> Column:
    """The value at the index round((n - 1) * share), halves to even, of the sorted numbers; null without any."""
    ordered = F.array_sort(values)
    return F.get(ordered, F.bround((F.size(ordered) - 1) * F.lit(share), 0).cast("int"))
