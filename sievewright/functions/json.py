"""Functions over JSON texts."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _parses(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()


def json_method(text: Column) -> Column:
    """How JSON is found in an answer: a fenced block, the first object without inner braces, the whole text, or ``not_json``."""
    block = F.regexp_extract(text, r"(?s)```json\n?(.*?)```", 1)
    flat = F.regexp_extract(text, r"\{[^{}]*\}", 0)
    return F.when((block != "") & _parses(block), "json_code_block").when((flat != "") & _parses(flat), "json_object").when(_parses(text), "json_full").otherwise("not_json")


def key_set(raw: Column) -> Column:
    """The keys of a JSON object as an array; null if the text is none."""
    return F.json_object_keys(raw)


def missing_keys(raw: Column, required: list[str]) -> Column:
    return F.array_except(F.array(*map(F.lit, required)), F.coalesce(key_set(raw), F.array().cast("array<string>")))


def unknown_keys(raw: Column, allowed: list[str]) -> Column:
    return F.array_except(F.coalesce(key_set(raw), F.array().cast("array<string>")), F.array(*map(F.lit, allowed)))


def canonical(columns: list[str]) -> Column:
    """The columns as compact JSON with sorted keys; null fields stay."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def path_value(report: Column, path: str, default: float = 0.0) -> Column:
    """A number at a dotted path of a JSON text, or the default."""
    return F.coalesce(F.get_json_object(report, f"$.{path}").try_cast("double"), F.lit(default))


@F.pandas_udf(T.StringType())
def _first_object(text: pd.Series) -> pd.Series:
    mark = re.compile(r'["{}]')

    def find(s: str | None) -> str | None:
        start = s.find("{") if s else -1
        if start < 0:
            return None
        depth, at = 0, start
        while m := mark.search(s, at):
            at = m.end()
            if m[0] == '"':  # to the end of the string
                while at < len(s) and s[at] != '"':
                    at += 2 if s[at] == "\\" else 1
                at += 1
            else:
                depth += 1 if m[0] == "{" else -1
                if not depth:
                    found = s[start:at]
                    try:
                        json.loads(found)
                    except ValueError:
                        return None
                    return found
        return None

    return text.map(find).astype(object)


def first_object(text: Column) -> Column:
    """The first balanced ``{...}`` of a text if it is JSON, else null; braces in strings don't count."""
    return _first_object(text)


#: Where a provider's answer has its content and token counts: (content, prompt, completion, total, model) paths.
RESPONSE_PATHS = {
    "openai": ("$.choices[0].message.content", "$.usage.prompt_tokens", "$.usage.completion_tokens", "$.usage.total_tokens"),
    "anthropic": ("$.content[0].text", "$.usage.input_tokens", "$.usage.output_tokens", None),
    "google": ("$.candidates[0].content.parts[0].text", "$.usageMetadata.promptTokenCount", "$.usageMetadata.candidatesTokenCount", "$.usageMetadata.totalTokenCount"),
    "cohere": ("$.text", "$.meta.tokens.input_tokens", "$.meta.tokens.output_tokens", None),
    "huggingface": ("$[0].generated_text", None, None, None),
}
RESPONSE_PATHS |= {"mistral": RESPONSE_PATHS["openai"], "grok": RESPONSE_PATHS["openai"]}


def response_of(provider: Column, raw: Column) -> Column:
    """A struct (content, prompt_tokens, completion_tokens, total_tokens, model) of a provider's answer."""

    def by(k: int) -> Column:
        out = F.lit(None).cast("string")
        for name, paths in RESPONSE_PATHS.items():
            if paths[k]:
                out = F.when(provider == name, F.get_json_object(raw, paths[k])).otherwise(out)
        return out

    content = F.when(provider == "huggingface", F.coalesce(by(0), F.get_json_object(raw, "$[0].text"), raw)).otherwise(by(0))
    prompt, completion = (F.coalesce(by(k).try_cast("bigint"), F.lit(0).cast("bigint")) for k in (1, 2))
    total = F.coalesce(by(3).try_cast("bigint"), F.when(provider.isin("anthropic", "cohere"), prompt + completion), F.lit(0).cast("bigint"))
    return F.struct(content.alias("content"), prompt.alias("prompt_tokens"), completion.alias("completion_tokens"), total.alias("total_tokens"), F.get_json_object(raw, "$.model").alias("model"))
