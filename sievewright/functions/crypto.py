"""Hashes, signatures and compression."""

from __future__ import annotations

import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def hmac_sha256(message: Column, key: str) -> Column:
    """HMAC-SHA256 of the UTF-8 text, as lower-case hex, in built-in functions."""
    import hashlib

    raw = key.encode()
    raw = (hashlib.sha256(raw).digest() if len(raw) > 64 else raw).ljust(64, b"\0")
    inner, outer = (F.unhex(F.lit(bytes(b ^ pad for b in raw).hex())) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, F.encode(message, "UTF-8")), 256))), 256)


def sample_hash(instruction: Column, output: Column) -> Column:
    """SHA-256 of instruction and output together; null counts as empty."""
    return F.sha2(F.concat(F.coalesce(instruction, F.lit("")), F.coalesce(output, F.lit(""))), 256)


def global_hash(instruction: Column, input_text: Column, output: Column) -> Column:
    """MD5 of the three texts with bars between; null counts as empty."""
    return F.md5(F.concat(F.coalesce(instruction, F.lit("")), F.lit("|"), F.coalesce(input_text, F.lit("")), F.lit("|"), F.coalesce(output, F.lit(""))))


#: Characters that JSON escapes by a letter or themselves, the backslash first.
_SHORT = {"\\": "\\\\", '"': '\\"', "\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}


def _json_string(text: Column) -> Column:
    """A text as a JSON string, with escapes for all but printable ASCII; null counts as empty."""

    def coded(run: Column) -> Column:
        return F.regexp_replace(F.lower(F.hex(F.encode(run, "UTF-16BE"))), "(.{4})", r"\\u$1")

    t = F.coalesce(text, F.lit(""))
    for c, escape in _SHORT.items():
        t = F.replace(t, F.lit(c), F.lit(escape))
    runs = F.regexp_extract_all(t, F.lit(r"([\x20-\x7e]+|[^\x20-\x7e]+)"), F.lit(1))
    mixed = F.array_join(F.transform(runs, lambda r: F.when(r.rlike(r"^[\x20-\x7e]"), r).otherwise(coded(r))), "")
    return F.concat(F.lit('"'), F.when(t.rlike(r"[^\x20-\x7e]"), mixed).otherwise(t), F.lit('"'))


def _record_payload(instruction: Column, input_text: Column, output: Column, model: Column) -> Column:
    fields = {"input": input_text, "instruction": instruction, "output": output, "teacher_model": model}
    parts = [F.concat(F.lit(f'"{name}": '), _json_string(value)) for name, value in fields.items()]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def record_signature(instruction: Column, input_text: Column, output: Column, model: Column, key: str) -> Column:
    """The signature of a record's content: HMAC over its JSON with sorted keys and escapes beyond ASCII."""
    return hmac_sha256(_record_payload(instruction, input_text, output, model), key)


def verified(signature: Column, expected: Column) -> Column:
    """Whether a signature is there and as expected."""
    return F.coalesce(signature == expected, F.lit(False))


@F.udf(T.BinaryType(), useArrow=False)
def _compressed(data: str | bytes | None) -> bytes | None:
    # rows go to Python by the hundred this way, by ten thousand in Arrow's batches
    return None if data is None else zlib.compress(data.encode() if isinstance(data, str) else bytes(data))


def compressed(data: Column) -> Column:
    """zlib of a text's UTF-8 bytes or of binary data."""
    return _compressed(data)
