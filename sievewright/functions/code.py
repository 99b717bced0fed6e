"""Functions over code and answers that hold code."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import patterns as P


def function_name(code: Column) -> Column:
    """The first function that Python code defines, or an empty text."""
    return F.regexp_extract(code, r"(?U)def\s+(\w+)\s*\(", 1)


def without_fences(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)```.*?```", "")


def prose_length(text: Column) -> Column:
    """Characters outside of code fences, trimmed."""
    return F.length(F.regexp_replace(without_fences(text), r"(?U)^\s+|\s+$", ""))


def code_blocks(text: Column) -> Column:
    """Blocks that look like Python: of at least 20 characters and with one of its words."""
    found = F.concat(*(F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in P.CODE_BLOCKS))
    looks = lambda b: reduce(lambda x, y: x | y, (F.contains(b, F.lit(w)) for w in P.CODE_WORDS))
    return F.filter(found, lambda b: (F.length(F.regexp_replace(b, r"(?U)^\s+|\s+$", "")) >= 20) & looks(b))


def dangerous(code: Column) -> Column:
    """The patterns of dangerous code that the text has, in their order."""
    return F.filter(F.array(*(F.when(code.rlike(f"(?i){p}"), F.lit(p)) for p in P.DANGEROUS_CODE)), lambda x: x.isNotNull())


def _compile_error(text: str | None) -> str | None:
    if text is None:
        return "no code"
    try:
        compile(text, "<block>", "exec")
    except (SyntaxError, ValueError, RecursionError, MemoryError) as e:
        return f"{type(e).__name__}: {getattr(e, 'msg', None) or e}"
    return None


@F.pandas_udf(T.StringType())
def _syntax_error(code: pd.Series) -> pd.Series:
    return code.map(_compile_error).astype(object)


@F.pandas_udf(T.ArrayType(T.StringType()))
def syntax_errors(blocks: pd.Series) -> pd.Series:
    """For each of an array of codes, why it doesn't compile, or null."""
    return blocks.map(lambda found: [_compile_error(b) for b in found])


def syntax_error(code: Column) -> Column:
    """Why Python code doesn't compile, or null if it does. Code is compiled, never run."""
    return _syntax_error(code)


def valid_code(language: Column, code: Column) -> Column:
    """Whether Python code compiles; null for other languages, whose compilers aren't at hand, and false for empty code."""
    empty = F.length(F.trim(F.coalesce(code, F.lit("")))) == 0
    return F.when(empty, False).when(F.lower(language).isin("python", "py"), syntax_error(code).isNull())


def snippet_ok(code: Column) -> Column:
    """Whether a snippet has more than five bytes."""
    return F.coalesce(F.octet_length(code) > 5, F.lit(False))
