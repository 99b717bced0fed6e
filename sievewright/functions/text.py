"""Text functions: redaction, truncation, prompts and format checks, as Columns."""

from __future__ import annotations

from collections import Counter
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import patterns as P

MESSAGE_LENGTH = 500
ERROR_LENGTH = 200
PATH_LENGTH = 100


def might_hold(text: Column, literals: list[str]) -> Column:
    """Whether a text has any of some lower-case literals, without regard to case: a cheap test before a pattern that needs one of them."""
    lowered = F.lower(text)
    return reduce(or_, (F.contains(lowered, F.lit(x)) for x in literals))


def strip_ansi(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("\x1b")), F.regexp_replace(text, P.ANSI_ESCAPE, "")).otherwise(text)


def redact(text: Column, none: str | None = "None") -> Column:
    """Secrets replaced by placeholders, escapes stripped; null becomes the text ``none``.

    The patterns run only over texts that hold what one of them needs.
    """
    plain = strip_ansi(text.cast("string"))
    redacted = plain
    for pattern, placeholder in P.REDACTIONS:
        redacted = F.regexp_replace(redacted, f"(?i){pattern}", placeholder)
    text = F.when(might_hold(plain, P.REDACTION_NEEDS), redacted).otherwise(plain)
    return text if none is None else F.coalesce(text, F.lit(none))


def redact_journal(text: Column) -> Column:
    """The shorter redaction of journal lines, and the line's quotes and controls escaped as in JSON."""
    for pattern, placeholder in P.JOURNAL_REDACTIONS:
        text = F.regexp_replace(text, pattern, placeholder)
    return json_escape(text)


def json_escape(text: Column) -> Column:
    """A text as it stands between the quotes of a JSON string; null for null."""
    quoted = F.to_json(F.struct(text.alias("x")))
    return F.when(text.isNotNull(), F.substring(quoted, F.lit(7), F.length(quoted) - 8))


def truncate(text: Column, most: int) -> Column:
    """At most ``most`` characters, the last three of a longer text being dots."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 3), F.lit("..."))).otherwise(text)


def shorten(text: Column, most: int) -> Column:
    """At most ``most`` characters with an ellipsis; unchanged if ``most`` isn't above 0."""
    return text if most <= 0 else F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 1), F.lit("…"))).otherwise(text)


def cap_output(text: Column, max_tokens: int) -> Column:
    """An answer cut at eight characters a token, 512 at least."""
    return shorten(text, max(512, 8 * max_tokens))


def sanitize(value: Column, kind: T.DataType, most: int = MESSAGE_LENGTH) -> Column:
    """Strings redacted and truncated, at every depth of structs, arrays and maps; other types unchanged."""
    if isinstance(kind, T.StringType):
        return truncate(redact(value, None), most)
    if isinstance(kind, T.StructType):
        made = F.struct(*(sanitize(value[f.name], f.dataType, most).alias(f.name) for f in kind.fields))
        return F.when(value.isNotNull(), made)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: sanitize(x, kind.elementType, most))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, x: sanitize(x, kind.valueType, most))
    return value


def multi_replace(text: Column, pairs: list[tuple[str, str]]) -> Column:
    """Replaces each target in turn; an error if a target is missing."""
    for old, new in pairs:
        missing = F.raise_error(F.lit(f"missing: {old}")).cast("string")
        text = F.when(text.isNull() | F.contains(text, F.lit(old)), F.replace(text, F.lit(old), F.lit(new))).otherwise(missing)
    return text


def words(text: Column) -> Column:
    """The words between white space, as an array."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


@F.pandas_udf(T.DoubleType())
def _most_frequent(text: pd.Series) -> pd.Series:
    def share(t: str | None) -> float | None:
        if t is None:
            return None
        found = t.lower().split()
        return max(Counter(found).values()) / len(found) if len(found) > 10 else 0.0

    return text.map(share, na_action=None).astype("float64")


def repetition_ratio(text: Column) -> Column:
    """Share of the most frequent word, in lower case, of a text of over ten words; else 0.

    Words are counted in Arrow batches: in built-in functions a text's words would
    have to be sorted, or shuffled by word.
    """
    return _most_frequent(text)


def format_checks(text: Column) -> Column:
    """A struct of what an answer looks like; ``format_compliant`` if it has content and no word of an error."""
    ratio = repetition_ratio(text)
    content = text.rlike(r"(?U)\S")
    errors = F.lower(text).rlike("|".join(P.ERROR_WORDS))
    return F.struct(
        content.alias("has_content"),
        F.length(text).alias("output_length"),
        F.regexp_count(text, F.lit(r"(?U)\S+")).alias("word_count"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).alias("line_count"),
        F.contains(text, F.lit("```")).alias("has_code_blocks"),
        text.rlike(r"(?m)^#{1,6}\s").alias("has_markdown"),
        ratio.alias("repetition_ratio"),
        (ratio > 0.3).alias("has_repetition"),
        errors.alias("has_error_indicators"),
        (content & ~errors).alias("format_compliant"),
    )


def fill_template(template: Column, code: Column, language: Column) -> Column:
    """A prompt from a template with the holes {code} and {language}."""
    parts = F.split(template, r"\{code\}")
    return _joined(F.transform(parts, lambda p: F.replace(p, F.lit("{language}"), language)), code)


def _joined(parts: Column, between: Column) -> Column:
    return F.substring(F.aggregate(parts, F.lit(""), lambda text, p: F.concat(text, between, p)), F.length(between) + 1, F.lit(2**31 - 1))


def training_prompt(instruction: Column, input_text: Column, output: Column) -> Column:
    """Instruction, input (unless empty) and output, as a model is trained on them."""
    middle = F.when(F.length(F.coalesce(input_text, F.lit(""))) > 0, F.concat(F.lit("Input: "), input_text, F.lit("\n\n"))).otherwise(F.lit(""))
    return F.concat(F.lit("Instruction: "), F.coalesce(instruction, F.lit("")), F.lit("\n\n"), middle, F.lit("Output: "), F.coalesce(output, F.lit("")))


def eval_prompt(instruction: Column, input_text: Column) -> Column:
    """What an answer is asked for: the instruction, and the input unless it is empty."""
    asked = F.when(F.length(F.coalesce(input_text, F.lit(""))) > 0, F.concat(instruction, F.lit("\n\n"), input_text)).otherwise(instruction)
    return F.concat(F.lit("Instruction: "), asked, F.lit("\n\nOutput:"))


# What a model is asked for, by sample and by batch.
_REQUEST = """Return ONLY strict JSON (no markdown) with keys instruction,input,output.
instruction must exactly match the provided instruction.
input must exactly match the provided input.

Constraints: output must be concise and <= %d tokens.

"""
_BATCH_REQUEST = """Return ONLY strict JSON (no markdown).
Output must be a JSON array where each element has keys id,instruction,input,output.
id must exactly match the provided id.
instruction must exactly match the provided instruction.
input must exactly match the provided input.
Constraints: each output must be concise and <= %d tokens.

"""
_BETWEEN = "\n\n---\n\n"


def teacher_request(instruction: Column, input_text: Column, max_tokens: int = 256) -> Column:
    """The request for one sample's answer; a null text is empty."""
    i, x = (F.coalesce(c, F.lit("")) for c in (instruction, input_text))
    return F.concat(F.lit(_REQUEST % max_tokens), F.lit("instruction: "), i, F.lit("\n\ninput: "), x, F.lit("\n"))


def batch_request(items: Column, max_tokens: int = 256) -> Column:
    """The request for the answers to an array of (id, instruction, input), in their order."""
    part = lambda s: F.concat(F.lit("id: "), s["id"], F.lit("\ninstruction: "), F.coalesce(s["instruction"], F.lit("")), F.lit("\ninput: "), F.coalesce(s["input"], F.lit("")))
    return F.concat(F.lit(_BATCH_REQUEST % max_tokens), F.array_join(F.transform(items, part), _BETWEEN), F.lit("\n"))


def answer_of(response: Column) -> Column:
    """The text behind the first ``Output:``, trimmed; the whole response without one."""
    at = F.instr(response, "Output:")
    return F.when(at > 0, F.regexp_replace(F.substring(response, at + 7, F.length(response)), r"(?U)^\s+|\s+$", "")).otherwise(response)


def token_estimate(chars: Column) -> Column:
    """A quarter of the characters, rounded down."""
    return F.floor(chars / 4)


def retryable(message: Column) -> Column:
    """Whether an error message tells of a limit or a passing failure."""
    low = F.lower(F.coalesce(message, F.lit("")))
    return reduce(lambda a, b: a | b, (F.contains(low, F.lit(p)) for p in P.RETRYABLE))


def error_class(message: Column) -> Column:
    """``session_not_found``, ``retryable`` or ``fatal``; null without a message."""
    lost = F.contains(F.lower(message), F.lit("session not found"))
    return F.when(message.isNull() | (message == ""), None).when(lost, "session_not_found").when(retryable(message), "retryable").otherwise("fatal")


def backoff_seconds(attempt: Column, base: float = 1.0, most: float = 60.0) -> Column:
    """Seconds to wait before an attempt, without the random part."""
    return F.least(F.lit(base) * F.pow(F.lit(2.0), attempt), F.lit(most))


def provider_name(name: Column) -> Column:
    """The provider that an alias names; null for an unknown one."""
    table = F.create_map(*[F.lit(x) for pair in P.PROVIDERS.items() for x in pair])
    return F.try_element_at(table, F.lower(name))


def extension(path: Column) -> Column:
    """The file name's extension in lower case, or an empty text."""
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def source_file(path: Column, size: Column, stack: str = "any", least: int = 100, most: int = 1_048_576) -> Column:
    """Whether a file is source code of the stack, with a size between the bounds."""
    return extension(path).isin(P.EXTENSIONS[stack]) & (size > least) & (size < most)


def owner_and_name(url: Column) -> Column:
    """``owner_name`` of a clone address."""
    found = F.regexp_extract(url, r"[/:]([^/:]+)/([^/]+?)(?:\.git)?/?$", 1)
    return F.concat_ws("_", found, F.regexp_extract(url, r"[/:]([^/:]+)/([^/]+?)(?:\.git)?/?$", 2))


def homework(readme: Column) -> Column:
    """Whether a readme tells of course work."""
    return F.coalesce(readme.rlike(P.HOMEWORK), F.lit(False))


def clock(ts: Column) -> Column:
    """HH:MM:SS of a time text, with or without a Z; the first eight characters if it can't be read."""
    return F.coalesce(F.date_format(F.try_to_timestamp(ts), "HH:mm:ss"), F.substring(ts, 1, 8))


def guess_language(code: Column) -> Column:
    """A language by the marks of its syntax; ``unknown`` without any."""
    return (
        F.when(code.rlike(r"(?m)^\s*#include\s*[<\"]"), "cpp")
        .when(code.rlike(r"(?m)^\s*package\s+\w+\s*$") | code.rlike(r"\bfunc\s+\w+\s*\("), "go")
        .when(code.rlike(r"\bpublic\s+(static\s+)?(class|void|interface)\b"), "java")
        .when(code.rlike(r"(?m)^\s*(def|class)\s+\w+.*:\s*$") | code.rlike(r"(?m)^\s*(import|from)\s+\w+"), "python")
        .when(code.rlike(r"\b(const|let|var)\s+\w+\s*=") | code.rlike(r"\bfunction\s*\w*\s*\("), "javascript")
        .otherwise("unknown")
    )
