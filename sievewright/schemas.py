"""Schemas, key sets and the fixed tables that the operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType()}


def struct(**fields: str | T.DataType) -> T.StructType:
    """A struct of fields by type or name of a simple type."""
    return T.StructType([T.StructField(n, _TYPES[t] if isinstance(t, str) else t) for n, t in fields.items()])


def array(kind: str | T.DataType) -> T.ArrayType:
    return T.ArrayType(_TYPES[kind] if isinstance(kind, str) else kind)


def mapping(value: str) -> T.MapType:
    return T.MapType(_TYPES["string"], _TYPES[value])


METADATA = struct(task_type="string", round="int", timestamp="string", teacher_model="string", teacher_backend="string", signature="string")
VALIDATION = struct(passed="boolean", reason="string")
BLOCK_RESULT = struct(block_index="int", passed="boolean", error="string")
TEST_RESULT = struct(passed="boolean", reason="string", blocks_tested="int", patterns=array("string"), block_results=array(BLOCK_RESULT))

RAW_SAMPLE = struct(id="string", instruction="string", input="string", output="string", metadata=METADATA)
CLEAN_SAMPLE = T.StructType([*RAW_SAMPLE.fields, T.StructField("validation", VALIDATION)])
TESTED_SAMPLE = T.StructType([*CLEAN_SAMPLE.fields, T.StructField("test_result", TEST_RESULT)])
JOURNAL_EVENT = struct(
    event_version="string", ts="string", run_id="string", round="int", stage="string", level="string", event_type="string", message="string",
    counters_delta=mapping("double"), usage_delta=mapping("double"), artifact_paths=array("string"), prev_hash="string",
)
RUN_STATE = struct(
    run_id="string", status="string", current_round="int", current_stage="string", stop_requested="boolean", pause_requested="boolean",
    counters=mapping("double"), usage=mapping("double"), last_error="string", health="string", started_at="string", updated_at="string",
)
EVAL_RESULT = struct(
    sample_id="string", success="boolean", error="string", output="string", output_length="bigint", json_valid="boolean", json_method="string", format_compliant="boolean", has_repetition="boolean"
)
MANIFEST = struct(
    run_id="string", engine_version="string", created_at="string", schema_version="string", dataset_hash="string", record_count="bigint", replay_hash="string",
    signing_key_id="string", final_state="string", total_runtime_sec="bigint", event_count="bigint", guardrail_snapshot=mapping("string"),
)
ENHANCEMENT = struct(ts="string", bucket="string", repo="string", repo_dir="string", prompt="string", response="string")
MESSAGE = struct(role="string", content="string")
#: Events of a teacher's answer stream; fields stand in ``properties`` or, in the flat shape, at the top.
STREAM_PART = struct(id="string", sessionID="string", messageID="string", type="string", text="string", time=struct(start="string", end="string"))
STREAM_INFO = struct(id="string", sessionID="string", role="string", time=struct(completed="string"))
STREAM_STATUS = struct(type="string", message="string")
STREAM_PROPERTIES = struct(sessionID="string", messageID="string", partID="string", field="string", delta="string", part=STREAM_PART, info=STREAM_INFO, status=STREAM_STATUS, error="string")
STREAM_EVENT = T.StructType(
    [*struct(type="string", timestamp="string").fields, *STREAM_PROPERTIES.fields, *struct(message="string", session=struct(id="string", error="string"), properties=STREAM_PROPERTIES).fields]
)

# The keys that rows must and may have at the borders between stages.
RAW_KEYS = ["id", "instruction", "input", "output", "metadata"]
CLEAN_KEYS = ["id", "instruction", "input", "output", "metadata", "validation"]
TRAINING_REQUIRED = ["instruction", "input", "output"]
TRAINING_OPTIONAL = ["id", "provenance", "metadata", "validation"]
JOURNAL_KEYS = [
    "event_version", "ts", "run_id", "round", "stage", "level", "event_type", "message", "counters_delta", "usage_delta", "artifact_paths", "prev_hash",
]
JOURNAL_VERSION = "1.0"
MANIFEST_KEYS = MANIFEST.fieldNames()

# The counters and usage figures of a run.
COUNTERS = [
    "teacher_generated", "teacher_failed", "raw_written", "validated_ok", "rejected_schema", "rejected_secret", "rejected_dedupe",
    "test_pass", "test_fail", "train_step", "train_loss", "eval_json_parse_rate", "eval_format_rate",
]
USAGE = ["requests_sent", "input_tokens", "output_tokens", "rate_limits_hit", "retries", "estimated_cost_usd"]
#: Counters that the last event sets; all others are summed.
LAST_WRITE_COUNTERS = ["train_loss", "eval_json_parse_rate", "eval_format_rate"]

# US dollars per million tokens (model, input, output).
PRICES = [
    ("gpt-4o-mini", 0.15, 0.60),
    ("gpt-4o", 2.50, 10.00),
    ("gpt-4-turbo", 10.00, 30.00),
    ("gpt-3.5-turbo", 0.50, 1.50),
    ("claude-3-opus", 15.00, 75.00),
    ("claude-3-sonnet", 3.00, 15.00),
    ("claude-3-haiku", 0.25, 1.25),
]

# Legal moves of a run (phase, event, next phase).
TRANSITIONS = [
    ("INITIALIZING", "START_FULL", "GENERATING"),
    ("INITIALIZING", "START_COLLECT", "GENERATING"),
    ("GENERATING", "STAGE_COMPLETE", "VALIDATING"),
    ("VALIDATING", "STAGE_COMPLETE", "TESTING"),
    ("TESTING", "STAGE_COMPLETE", "TRAINING"),
    ("TRAINING", "STAGE_COMPLETE", "EVALUATING"),
    ("EVALUATING", "STAGE_COMPLETE", "COMPLETE"),
    ("EVALUATING", "ROUND_COMPLETE", "GENERATING"),
    ("EVALUATING", "PIPELINE_COMPLETE", "COMPLETE"),
    ("COMPLETE", "START_FULL", "INITIALIZING"),
    ("COMPLETE", "START_COLLECT", "INITIALIZING"),
    ("COMPLETE", "TRAIN_NOW", "TRAINING"),
    ("ERROR", "START_FULL", "INITIALIZING"),
    ("ERROR", "START_COLLECT", "INITIALIZING"),
]

# The state that an event sets when a journal is replayed (event type, stage or None for any, state).
REPLAY_STATES = [
    ("pipeline_start", None, "COLLECTING"),
    ("stage_start", "generate", "COLLECTING"),
    ("stage_start", "validate", "VALIDATING"),
    ("stage_start", "test", "TESTING"),
    ("stage_start", "train", "FINALIZING"),
    ("stage_start", "eval", "EVALUATING"),
    ("pipeline_error", None, "ERROR"),
    ("pipeline_stop", None, "IDLE"),
    ("pipeline_complete", None, "IDLE"),
]

# Configuration rules (field, kind, least, most, allowed).
CONFIG_RULES = [
    ("BASE_MODEL", "string", None, None, None),
    ("TEACHER_MODEL", "string", None, None, None),
    ("SAMPLES_PER_ROUND", "int", 1.0, 10000.0, None),
    ("ROUNDS", "int", 1.0, 100.0, None),
    ("VAL_RATIO", "number", 0.0, 1.0, None),
    ("SEQ_LEN", "int", 128.0, 8192.0, None),
    ("BATCH_SIZE", "int", 1.0, 64.0, None),
    ("GRAD_ACCUM", "int", 1.0, 128.0, None),
    ("TRAIN_STEPS", "int", 1.0, 100000.0, None),
    ("LORA_R", "int", 1.0, 512.0, None),
    ("LORA_ALPHA", "int", 1.0, 1024.0, None),
    ("LR", "string", None, None, None),
    ("RUN_UNIT_TESTS", "string", None, None, ["0", "1"]),
    ("SEED", "int or string", None, None, None),
    ("OUT_DIR", "string", None, None, None),
]

# The prompt templates of generation (task type, instruction, template).
TEMPLATES = [
    ("code_completion", "Complete the following function:", "Complete this function:\n\n```{language}\n{code}\n```\n"),
    ("bug_fixing", "Fix the bugs in this code:", "Fix bugs in:\n\n```{language}\n{code}\n```\n"),
    ("refactoring", "Refactor this code for quality:", "Refactor:\n\n```{language}\n{code}\n```\n"),
]


def prices(spark: SparkSession) -> DataFrame:
    """(model, input_price, output_price)."""
    return spark.createDataFrame(PRICES, "model string, input_price double, output_price double")


def transitions(spark: SparkSession) -> DataFrame:
    """(phase, event, next_phase)."""
    return spark.createDataFrame(TRANSITIONS, "phase string, event string, next_phase string")
