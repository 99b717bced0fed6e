import json

import pytest
from pyspark.sql import functions as F

from sievewright import schemas as S
from sievewright.functions import crypto
from sievewright.operators import validate as V

SAMPLE = f"raw string, seq bigint, id string, instruction string, input string, output string, metadata {S.METADATA.simpleString()}"


def samples(spark, rows):
    full = []
    for i, r in enumerate(rows):
        r = {"id": str(i), "instruction": "do", "input": "", "output": "a good answer, long enough", "metadata": {"task_type": "other", "teacher_model": "m"}} | r
        raw = json.dumps({k: v for k, v in r.items() if k != "raw"}) if "raw" not in r else r["raw"]
        m = r["metadata"]
        full.append((raw, i, r["id"], r["instruction"], r["input"], r["output"], (m.get("task_type"), 1, None, m.get("teacher_model"), None, m.get("signature"))))
    return spark.createDataFrame(full, SAMPLE)


def verdict(spark, task, given, answer, model="m", placeholders=None):
    df = spark.createDataFrame([(given, answer)], "i string, o string")
    return df.select(V.semantic_verdict(F.lit(task), F.lit(model), F.col("i"), F.col("o"), placeholders).alias("v")).first().v


FENCE = "```python\ndef add(a, b):\n    return a + b\n```"
LONG = "This text explains at some length what the function named add does with its arguments."


@pytest.mark.parametrize(
    "task, given, answer, want",
    [
        ("bug_fixing", "def add(a):", "class Handler", "contains_placeholder: class Handler"),
        ("bug_fixing", "def add(a):", "The bug is in mul, see " + "```x```", "missing_original_function: add"),
        ("bug_fixing", "def add(a):", "add " + FENCE, "missing_explanation"),
        ("bug_fixing", "def add(a):", LONG, "missing_code_block"),
        ("bug_fixing", "def add(a):", LONG + FENCE, None),
        ("unit_test_generation", "def add(a):", "def test_add(): assert add(1)", "missing_pytest"),
        ("unit_test_generation", "def add(a):", "import pytest\nadd", "missing_test_case"),
        ("unit_test_generation", "def add(a):", "import pytest\ndef test_x(): 1", "missing_reference_to_add"),
        ("unit_test_generation", "def add(a):", "import pytest\ndef test_add(): 1", None),
        ("code_explanation", "def add(a):", "short add", "explanation_too_short"),
        ("code_explanation", "def mul(a):", LONG, "explanation_missing_identifier: mul"),
        ("code_completion", "def mul(a):", LONG, "completion_missing_function: mul"),
        ("refactoring", "def mul(a):", LONG, "refactor_missing_function: mul"),
        ("algorithm_implementation", "", LONG, "algorithm_missing_code"),
        ("documentation", "", LONG, "missing_docstring"),
        ("documentation", "def mul(a):", '"""x"""', "documentation_missing_original_function: mul"),
        ("code_review", "", "short", "review_too_short"),
        ("code_review", "def mul(a):", LONG, "review_missing_reference: mul"),
        ("anything", "def mul(a):", "x", None),
        (None, None, None, None),
    ],
)
def test_semantic_rules(spark, task, given, answer, want):
    assert verdict(spark, task, given, answer) == want


def test_bypass_and_own_placeholders(spark):
    assert verdict(spark, "bug_fixing", "", "pass", model="code-assistant") is None
    assert verdict(spark, "other", "", "pass", placeholders=["lorem"]) is None and verdict(spark, "other", "", "lorem", placeholders=["lorem"]) == "contains_placeholder: lorem"


def test_first_failure_is_the_reason(spark):
    rows = [
        {},
        {"extra": 1},
        {"raw": '{"id": 1}'},
        {"output": "password = 'longenough' class Handler"},
        {"output": "class Handler is here"},
        {"input": "x" * 5000},
        {"output": "short"},
        {"output": "o" * 3000},
        {"output": None},
    ]
    checked = V.with_reason(samples(spark, rows)).orderBy("seq").collect()
    kinds = [r.reject_reason for r in checked]
    assert kinds == [
        None,
        "schema: unknown: extra",
        "schema: missing: input,instruction,metadata,output",
        "secret: output:password",
        "semantic: contains_placeholder: class Handler",
        "length: input_too_long",
        "length: output_too_short",
        "length: output_too_long",
        "length: output_too_short",
    ]
    df = V.with_reason(samples(spark, rows))
    assert [(r.reason, r.n) for r in V.reason_histogram(df).collect()] == [("length", 4), ("schema", 2), ("secret", 1), ("semantic", 1)]
    kept = V.accepted(df).collect()
    assert [r.seq for r in kept] == [0] and kept[0].validation.passed
    with pytest.raises(Exception, match="schema: "):
        V.strict(df).collect()


def test_provenance(spark):
    df = samples(spark, [{}, {}, {}])
    signed = crypto.record_signature(F.col("instruction"), F.col("input"), F.col("output"), F.col("metadata.teacher_model"), "key")
    df = df.withColumn("metadata", F.col("metadata").withField("signature", F.when(F.col("seq") == 0, signed).when(F.col("seq") == 1, F.lit("wrong"))))
    got = V.with_reason(df, V.Gate(provenance_key="key")).orderBy("seq").collect()
    assert [r.reject_reason for r in got] == [None, "provenance: not signed", "provenance: not signed"]


def event(**changes):
    return json.dumps({k: "x" for k in S.JOURNAL_KEYS} | {"event_version": "1.0", "round": 1, "counters_delta": {}, "usage_delta": {}, "artifact_paths": []} | changes)


@pytest.mark.parametrize(
    "line, want",
    [
        (event(level="info"), None),
        (json.dumps({k: "x" for k in S.JOURNAL_KEYS if k != "prev_hash"}), "missing: prev_hash"),
        (event(event_version="2.0"), "version: 2.0"),
        (event(more=1), "unknown: more"),
        ("not a json", "not an object"),
        (event().replace('"round": 1', '"round": NaN'), "not a finite number"),
        (event(message="y" * (1 << 20)), "too long"),
    ],
)
def test_journal_lines(spark, line, want):
    assert spark.createDataFrame([(line,)], "l string").select(V.journal_violation(F.col("l")).alias("v")).first().v == want


def test_manifest_lines(spark):
    good = {k: "a 1.5 text" for k in S.MANIFEST_KEYS} | {"record_count": 3, "guardrail_snapshot": {"x": "1.5"}}
    lines = [json.dumps(good), json.dumps(good | {"record_count": 3.0}), json.dumps(good | {"guardrail_snapshot": {"x": 1e9}}), json.dumps({k: 1 for k in S.MANIFEST_KEYS[1:]})]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, l string").select("i", V.manifest_violation(F.col("l")).alias("v")).orderBy("i").collect()
    assert [r.v for r in got] == [None, "floating point number", "floating point number", "missing: run_id"]


def test_config(spark):
    rows = [("ROUNDS", "3", "int"), ("ROUNDS", "0", "int"), ("BATCH_SIZE", "65", "int"), ("VAL_RATIO", "1", "int"), ("SEED", "x", "string"), ("LR", "2", "int"), ("RUN_UNIT_TESTS", "2", "string"), ("WHAT", "1", "int")]
    got = V.config_violations(spark.createDataFrame(rows, "field string, value string, kind string"), spark).collect()
    assert {(r.field, r.problem) for r in got} == {("ROUNDS", "too small"), ("BATCH_SIZE", "too large"), ("LR", "wrong type: int"), ("RUN_UNIT_TESTS", "not allowed"), ("WHAT", "unknown field")}


def test_string_keys(spark):
    lines = ['{"a": "x", "b": "y"}', '{"a": "x", "b": 1}', '{"a": "x"}', "no"]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, l string").orderBy("i").select(V.all_strings(F.col("l"), ["a", "b"]).alias("v")).collect()
    assert [r.v for r in got] == [True, False, False, False]


def test_code_gate(spark):
    outputs = ["no code at all", FENCE, "```python\ndef f(:\n    return 1 + 1\n```", "```python\nimport subprocess\nx = subprocess.run(y)\n```", None]
    df = samples(spark, [{"output": o} for o in outputs])
    got = {r.seq: r.test_result for r in V.code_gate(df).collect()}
    assert [(got[i].passed, got[i].reason) for i in range(5)] == [(True, "no_code"), (True, "ok"), (False, "syntax_error"), (False, "dangerous_code"), (True, "no_code")]
    assert got[3].patterns == [r"import\s+subprocess"] and got[2].block_results[0].error.startswith("SyntaxError")
    assert {r.seq for r in V.code_gate(df, only_passed=True).collect()} == {0, 1, 4}


def test_routing_and_content(spark):
    rows = [(0, 'x {"a": 1}'), (1, 'y {"a": 1} z'), (2, "none"), (3, '{"b": 2}'), (4, '{"c": 2}')]
    df = spark.createDataFrame(rows, "seq bigint, response string")
    import hashlib

    seen = spark.createDataFrame([(hashlib.sha256(b'{"c": 2}').hexdigest(),)], "hash string")
    got = {r.seq: r.status for r in V.route_responses(df, seen).collect()}
    assert got == {0: "clean", 1: "duplicate", 2: "raw", 3: "clean", 4: "duplicate"}
    lines = spark.createDataFrame([("a.py", 1, "# TODO x"), ("a.py", 2, "no"), (".git/b", 1, "TODO"), ("c.py", 1, "FIXME")], "path string, line_no int, value string")
    assert [(r.path, r.line_no) for r in V.content_matches(lines).collect()] == [("a.py", 1), ("c.py", 1)]
