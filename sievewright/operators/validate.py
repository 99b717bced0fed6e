"""Validation of samples: schema, secrets, semantics and lengths, with the first failure as the reason."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import code as C
from ..functions import crypto, json, text
from ..functions import patterns as P


def key_violation(raw: Column, required: list[str], allowed: list[str] | None = None) -> Column:
    """Why a JSON text breaks a strict key set, or null: keys are missing, or beyond the allowed ones."""
    missing, unknown = json.missing_keys(raw, required), json.unknown_keys(raw, allowed or required)
    return (
        F.when(json.key_set(raw).isNull(), "not an object")
        .when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(F.array_sort(missing), ",")))
        .when(F.size(unknown) > 0, F.concat(F.lit("unknown: "), F.array_join(F.array_sort(unknown), ",")))
    )


def training_violation(raw: Column) -> Column:
    return key_violation(raw, S.TRAINING_REQUIRED, S.TRAINING_REQUIRED + S.TRAINING_OPTIONAL)


def all_strings(raw: Column, keys: list[str]) -> Column:
    """Whether the keys of a JSON object are all there and hold strings."""
    variant = F.try_parse_json(raw)
    checks = [F.coalesce(F.schema_of_variant(F.try_variant_get(variant, f"$.{k}", "variant")) == "STRING", F.lit(False)) for k in keys]
    return reduce(lambda a, b: a & b, checks)


def secret_hits(fields: list[str]) -> Column:
    """``field:kind`` of each secret pattern that a field has, fields first, patterns in their order.

    A pattern runs only over texts that hold what it needs.
    """

    def has(field: str, pattern: str, kind: str) -> Column:
        found = F.col(field).rlike(pattern)
        return text.might_hold(F.col(field), P.SECRET_NEEDS[kind]) & found if kind in P.SECRET_NEEDS else found

    hits = [F.when(has(f, pattern, kind), F.lit(f"{f}:{kind}")) for f in fields for pattern, kind in P.SECRETS]
    return F.filter(F.array(*hits), lambda x: x.isNotNull())


@dataclass(frozen=True)
class Lengths:
    """Least and greatest characters of input and output, both allowed."""

    min_input: int = 0
    max_input: int = 4096
    min_output: int = 10
    max_output: int = 2048


def length_violation(input_text: Column, output: Column, bounds: Lengths) -> Column:
    i, o = F.length(F.coalesce(input_text, F.lit(""))), F.length(F.coalesce(output, F.lit("")))
    return F.when(i > bounds.max_input, "input_too_long").when(o > bounds.max_output, "output_too_long").when(i < bounds.min_input, "input_too_short").when(o < bounds.min_output, "output_too_short")


def semantic_verdict(task: Column, model: Column, input_text: Column, output: Column, placeholders: list[str] | None = None) -> Column:
    """What is wrong with an answer to a task, or null.

    A placeholder rejects any answer; then each kind of task asks for what its
    answers have. Tasks of other kinds pass, and so does the model
    ``code-assistant``.
    """
    i, o = F.coalesce(input_text, F.lit("")), F.coalesce(output, F.lit(""))
    name, prose, fence = C.function_name(i), C.prose_length(o), F.contains(o, F.lit("```"))
    lost = (name != "") & ~F.contains(o, name)
    placeholder = F.coalesce(*(F.when(F.contains(o, F.lit(p.strip())), F.lit(f"contains_placeholder: {p}")) for p in placeholders or P.PLACEHOLDERS))

    def missing(text: str) -> tuple[Column, Column]:
        return lost, F.concat(F.lit(text), name)

    pytest = F.contains(F.lower(o), F.lit("pytest"))
    docs = F.contains(o, F.lit('"""')) | F.contains(o, F.lit("'''"))
    rules: dict[str, list[tuple[Column, Column]]] = {
        "bug_fixing": [missing("missing_original_function: "), (prose < 20, F.lit("missing_explanation")), (~fence, F.lit("missing_code_block"))],
        "unit_test_generation": [(~pytest, F.lit("missing_pytest")), (~F.contains(o, F.lit("def test_")), F.lit("missing_test_case")), missing("missing_reference_to_")],
        "code_explanation": [(prose < 50, F.lit("explanation_too_short")), missing("explanation_missing_identifier: ")],
        "code_completion": [missing("completion_missing_function: ")],
        "refactoring": [missing("refactor_missing_function: ")],
        "algorithm_implementation": [(~fence, F.lit("algorithm_missing_code"))],
        "documentation": [(~docs, F.lit("missing_docstring")), missing("documentation_missing_original_function: ")],
        "code_review": [(prose < 50, F.lit("review_too_short")), missing("review_missing_reference: ")],
    }
    by_task = F.lit(None).cast("string")
    for kind, checks in rules.items():
        verdict = F.coalesce(*(F.when(bad, why) for bad, why in checks))
        by_task = F.when(task == kind, verdict).otherwise(by_task)
    return F.when(F.coalesce(model, F.lit("")) != "code-assistant", F.coalesce(placeholder, by_task))


@dataclass(frozen=True)
class Gate:
    """What a sample has to pass; a part that is off passes all."""

    schema: bool = True
    secrets: bool = True
    provenance_key: str | None = None
    semantic: bool = True
    lengths: Lengths | None = field(default_factory=Lengths)
    placeholders: list[str] | None = None
    fields: tuple[str, ...] = ("instruction", "input", "output")


def with_reason(samples: DataFrame, gate: Gate | None = None) -> DataFrame:
    """``samples`` with ``reject_reason``, the first failure as ``kind: detail``, or null.

    Checks follow each other as schema (where a column ``raw`` has the JSON),
    secrets, provenance, semantics and lengths.
    """
    gate = gate or Gate()
    meta = F.col("metadata") if "metadata" in samples.columns else None
    reasons = []
    if gate.schema and "raw" in samples.columns:
        reasons.append(F.concat(F.lit("schema: "), key_violation(F.col("raw"), S.RAW_KEYS)))
    if gate.secrets:
        hits = secret_hits([f for f in P.SECRET_FIELDS if f in samples.columns])
        reasons.append(F.when(F.size(hits) > 0, F.concat(F.lit("secret: "), F.array_join(hits, ", "))))
    if gate.provenance_key is not None:
        expected = crypto.record_signature(F.col("instruction"), F.col("input"), F.col("output"), meta["teacher_model"], gate.provenance_key)
        reasons.append(F.when(~crypto.verified(meta["signature"], expected), "provenance: not signed"))
    if gate.semantic and meta is not None:
        verdict = semantic_verdict(meta["task_type"], meta["teacher_model"], F.col("input"), F.col("output"), gate.placeholders)
        reasons.append(F.concat(F.lit("semantic: "), verdict))
    if gate.lengths:
        reasons.append(F.concat(F.lit("length: "), length_violation(F.col("input"), F.col("output"), gate.lengths)))
    return samples.withColumn("reject_reason", F.coalesce(*reasons) if reasons else F.lit(None).cast("string"))


def accepted(checked: DataFrame) -> DataFrame:
    """Rows without a reason, marked as validated."""
    passed = F.struct(F.lit(True).alias("passed"), F.lit("ok").alias("reason"))
    return checked.where("reject_reason is null").drop("reject_reason").withColumn("validation", passed)


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where("reject_reason is not null")


def reason_histogram(checked: DataFrame) -> DataFrame:
    """(reason, n) of the rejected rows, by the reason's kind, in order."""
    kind = F.substring_index("reject_reason", ":", 1)
    return rejected(checked).groupBy(kind.alias("reason")).agg(F.count("*").alias("n")).orderBy("reason")


def required(rows: DataFrame, problem: Column) -> DataFrame:
    """``rows``, failing at the first row with a problem (a text, or null for none), whichever columns are read later.

    The check is a filter, which nothing prunes, unlike a column that raises.
    """
    return rows.where(F.when(problem.isNull(), F.lit(True)).otherwise(F.raise_error(problem).cast("boolean")))


def strict(checked: DataFrame) -> DataFrame:
    """``checked``, failing at the first row with a reason of the kind schema."""
    return required(checked, F.when(F.col("reject_reason").startswith("schema"), F.col("reject_reason")))


def journal_violation(raw: Column) -> Column:
    """Why a journal line isn't valid, or null: at most 1 MiB, the twelve keys and no more, the version, and no NaN or infinity.

    Keys are counted by the parsed object, so that eleven separators follow from twelve keys.
    """
    keys = key_violation(raw, S.JOURNAL_KEYS)
    version = F.get_json_object(raw, "$.event_version")
    odd = raw.rlike(r"[:,\[]\s*-?(NaN|Infinity|nan|inf)\b")
    return (
        F.when(F.octet_length(raw) > 1 << 20, "too long")
        .when(odd, "not a finite number")
        .when(keys.isNotNull(), keys)
        .when(~version.eqNullSafe(F.lit(S.JOURNAL_VERSION)), F.concat(F.lit("version: "), F.coalesce(version, F.lit("null"))))
    )


def manifest_violation(raw: Column) -> Column:
    """Why a manifest isn't valid, or null: exactly the twelve keys, and no floating point number at any depth of two."""
    keys = key_violation(raw, S.MANIFEST_KEYS)
    # numbers outside of strings that have a point or an exponent
    bare = F.regexp_replace(raw, r'"(?:[^"\\]|\\.)*"', '""')
    return F.when(keys.isNotNull(), keys).when(bare.rlike(r"[:\[,]\s*-?\d+(\.\d|[eE])"), "floating point number")


def config_violations(settings: DataFrame, spark: SparkSession) -> DataFrame:
    """(field, problem) of settings (field, value as text, kind int, number or string) against the rules."""
    rules = spark.createDataFrame(S.CONFIG_RULES, "field string, want string, least double, most double, allowed array<string>")
    number = F.col("value").try_cast("double")
    fits = (F.col("kind") == F.col("want")) | ((F.col("want") == "number") & (F.col("kind") == "int")) | ((F.col("want") == "int or string") & F.col("kind").isin("int", "string"))
    problem = (
        F.when(F.col("want").isNull(), "unknown field")
        .when(~fits, F.concat(F.lit("wrong type: "), F.col("kind")))
        .when(number < F.col("least"), "too small")
        .when(number > F.col("most"), "too large")
        .when(~F.array_contains("allowed", F.col("value")), "not allowed")
    )
    return settings.join(F.broadcast(rules), "field", "left").select("field", problem.alias("problem")).where("problem is not null")


def route_responses(responses: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Answers (bucket, repo, response) with ``json`` (their first object), ``hash`` and ``status``: clean, duplicate or raw.

    Every answer belongs to the samples; only clean ones, the first of each
    object in the order of ``seq`` and not among ``seen`` (hash), to the clean ones.
    """
    from .dedupe import first_of

    found = responses.withColumn("json", json.first_object(F.col("response"))).withColumn("hash", F.sha2("json", 256))
    parsed = found.where("json is not null").select("seq", "hash")
    firsts = first_of(parsed, ["hash"], ["seq"])
    if seen is not None:
        firsts = firsts.join(seen.select("hash").distinct(), "hash", "left_anti")
    marked = found.join(firsts.select("seq", F.lit(True).alias("first")), "seq", "left")
    return marked.withColumn("status", F.when(F.col("json").isNull(), "raw").when(F.col("first"), "clean").otherwise("duplicate")).drop("first")


def repo_hints(files: DataFrame) -> DataFrame:
    """(repo, python, cpp, github, node): what the paths of a repository's files tell of it."""
    def any_of(pattern: str) -> Column:
        return F.bool_or(F.col("path").rlike(pattern))

    return files.groupBy("repo").agg(
        any_of(r"^(pyproject\.toml|requirements\.txt|tests/.*)$").alias("python"),
        any_of(r"^([^/]*\.(cpp|cc|cxx)|CMakeLists\.txt|Makefile)$").alias("cpp"),
        any_of(r"^\.github/(workflows/.*|dependabot\.yml|CODEOWNERS)$").alias("github"),
        any_of(r"^package\.json$").alias("node"),
    )


def content_matches(lines: DataFrame, pattern: str = r"TODO|FIXME", skip: str = r"(^|/)(\.git|node_modules|vendor|dist|build)/", most: int = 200) -> DataFrame:
    """The first ``most`` lines (path, line_no, value) that match, in order, but for skipped paths."""
    return lines.where(F.col("value").rlike(pattern) & ~F.col("path").rlike(skip)).orderBy("path", "line_no").limit(most)


def code_gate(samples: DataFrame, only_passed: bool = False) -> DataFrame:
    """``samples`` with ``test_result``: the answer's code blocks, compiled but never run, and dangerous patterns.

    A sample passes without blocks, and if no block is dangerous and all compile.
    A sample's blocks are compiled where it lies, in Arrow batches.
    """
    tested = samples.withColumn("_blocks", C.code_blocks(F.coalesce(F.col("output"), F.lit("")))).withColumn("_errors", C.syntax_errors(F.col("_blocks")))
    patterns = F.array_distinct(F.flatten(F.transform("_blocks", C.dangerous)))
    results = F.transform("_errors", lambda e, i: F.struct(i.alias("block_index"), e.isNull().alias("passed"), e.alias("error")))
    broken = F.exists("_errors", lambda e: e.isNotNull())
    reason = F.when(F.size("_blocks") == 0, "no_code").when(F.size(patterns) > 0, "dangerous_code").when(broken, "syntax_error").otherwise("ok")
    result = F.struct(reason.isin("ok", "no_code").alias("passed"), reason.alias("reason"), F.size("_blocks").alias("blocks_tested"), patterns.alias("patterns"), results.alias("block_results"))
    out = tested.withColumn("test_result", result).drop("_blocks", "_errors")
    return out.where("test_result.passed") if only_passed else out
