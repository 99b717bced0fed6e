"""Plans: a round of curation, and the build of a dataset over many repositories, as lazy graphs of the operators.

A step whose table is there is read, not made again, so that a plan that was
stopped goes on where it was.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import dedupe, evaluate, ordering, validate
from ..sources import readers, writers


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to the end, in any store that Spark reads."""
    jvm = spark.sparkContext._jvm
    success = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return success.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(success)


def step(spark: SparkSession, path: str, make: Callable[[], DataFrame], again: bool = False) -> DataFrame:
    """The table at ``path``, made if it isn't there."""
    if again or not exists(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@dataclass(frozen=True)
class Plan:
    """What a build does."""

    gate: validate.Gate = field(default_factory=validate.Gate)
    val_ratio: float = 0.1
    seed: int | None = None
    test_code: bool = False
    only_passed: bool = False


def clean(samples: DataFrame, plan: Plan) -> tuple[DataFrame, DataFrame]:
    """(accepted and deduplicated samples, rejected samples with reasons) of samples with ``seq``."""
    checked = validate.with_reason(samples, plan.gate)
    kept = dedupe.dedupe_samples(validate.accepted(checked))
    if plan.test_code:
        kept = validate.code_gate(kept, plan.only_passed)
    return kept, validate.rejected(checked)


def run_round(spark: SparkSession, raw: str, out: str, plan: Plan | None = None) -> dict[str, DataFrame]:
    """A round: raw JSON lines of one or several files to clean samples, reasons, and the split for training; all tables lie under ``out``.

    ``seq`` rises with path and line over all files.
    """
    plan = plan or Plan()
    samples = numbered(readers.json_lines(spark, raw, S.RAW_SAMPLE)).withColumnRenamed("_at", "seq")
    kept = step(spark, f"{out}/clean", lambda: clean(samples, plan)[0])
    reasons = step(spark, f"{out}/reasons", lambda: validate.reason_histogram(validate.with_reason(samples, plan.gate)))
    parted = step(spark, f"{out}/split", lambda: split(kept, plan))
    return {"clean": kept, "reasons": reasons, "split": parted}


def split(samples: DataFrame, plan: Plan) -> DataFrame:
    return ordering.split_tail(samples, "seq", plan.val_ratio) if plan.seed is None else ordering.split_shuffled(samples, "seq", plan.val_ratio, plan.seed)


def build(spark: SparkSession, data: str, out: str, plan: Plan | None = None, pattern: str = "clean_round_*.jsonl") -> dict[str, DataFrame]:
    """Merges the clean rounds of all repositories, first lines first, and splits them; a one-row ``summary`` tells the counts."""
    plan = plan or Plan()
    found = readers.json_lines(spark, data, S.RAW_SAMPLE, pattern)
    merged = step(spark, f"{out}/merged", lambda: ordering.positioned(numbered(dedupe.dedupe_global(found)), "_at", "seq").drop("_at"))
    parted = step(spark, f"{out}/split", lambda: split(merged, plan))
    ratio = dedupe.dedupe_ratio(found, dedupe.global_key()).select(F.col("total").alias("total_lines_before_dedupe"), F.col("distinct_keys").alias("unique_lines"), F.col("ratio").alias("dedupe_ratio"))
    counts = parted.agg(F.count("*").alias("dataset_lines"), F.count_if(F.col("split") == "train").alias("train_lines"), F.count_if(F.col("split") == "val").alias("val_lines"))
    summary = step(spark, f"{out}/summary", lambda: counts.withColumn("_k", F.lit(1)).join(ratio.withColumn("_k", F.lit(1)), "_k").drop("_k"))
    return {"merged": merged, "split": parted, "summary": summary}


def numbered(rows: DataFrame) -> DataFrame:
    """Rows with ``_at``, a number that rises with path and line; what one task orders is the list of files."""
    paths = rows.select("path").distinct()
    rank = paths.select("path", (F.row_number().over(Window.orderBy("path")) - 1).alias("_file"))
    return rows.join(rank, "path").withColumn("_at", F.shiftleft(F.col("_file").cast("bigint"), 40) + F.col("line_no")).drop("_file")


def evaluation(answers: DataFrame) -> DataFrame:
    """One row of metrics over answers (sample_id, success, output)."""
    return evaluate.metrics(evaluate.with_scores(answers))


def seal(spark: SparkSession, out: str, run_id: str, key: str, created_at: str) -> None:
    """Seals the merged lines of a build with a signed manifest."""
    rows = spark.read.parquet(f"{out}/merged").select("seq", F.col("raw").alias("value"))
    writers.seal(rows, f"{out}/verified", run_id, key, created_at)
