"""Readers that keep the raw line, its file and its number.

Text has no line numbers across splits. A line's number is made from the place
that Spark gives each row while it reads: rows of one task are consecutive, and
a task reads its splits one after the other, so that the ids of
``monotonically_increasing_id`` within a split are consecutive. Lines are numbered from
the least id of their split and moved by the lines of the file's splits before it, so
that no line is shuffled or sorted and a file of any size is numbered by as many tasks
as it has splits.

Scans that fail on a bad line check it in a filter, so that a count or a choice of
columns fails as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import json
from ..operators import validate
from ..operators.dedupe import prefer


def lines(spark: SparkSession, path: str | list[str], pattern: str | None = None, numbers: bool = True) -> DataFrame:
    """(path, line_no, value): all lines of text files; with ``pattern``, of the files of that name at any depth."""
    reader = spark.read.option("wholetext", False)
    if pattern:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    rows = reader.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_id"), "value")
    if not numbers:
        return rows.select("path", F.lit(None).cast("bigint").alias("line_no"), "value")
    # rows of a split have consecutive ids, so that the split's least id and the lines before it number them; only these travel
    earlier = Window.partitionBy("path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = rows.groupBy("path", "_start").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    shifts = splits.select("path", "_start", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    numbered = rows.join(F.broadcast(shifts) if _few_splits(spark, rows) else shifts, ["path", "_start"])
    return numbered.select("path", (F.col("_id") + F.col("_shift")).cast("bigint").alias("line_no"), "value")


#: Splits of files up to which their table of counts is sent to all tasks, about 100 bytes each.
FEW_SPLITS = 100_000


def _few_splits(spark: SparkSession, rows: DataFrame) -> bool:
    """Whether the table of splits is small: a split has its share of the bytes, or is a file."""
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    files = len(rows.inputFiles())
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return files + size // max(1, most) <= FEW_SPLITS


def json_lines(spark: SparkSession, path: str | list[str], schema: T.StructType, pattern: str | None = None, broken: bool = False) -> DataFrame:
    """Rows of JSON lines with raw, path and line_no; blank lines are skipped, and so are malformed ones.

    With ``broken`` it is the malformed lines that are returned.
    """
    found = lines(spark, path, pattern).withColumn("raw", F.trim("value")).where("raw <> ''")
    parsed = F.try_parse_json("raw").isNotNull()
    if broken:
        return found.where(~parsed).select("path", "line_no", "raw")
    return found.where(parsed).select("path", "line_no", "raw", F.from_json("raw", schema).alias("x")).select("path", "line_no", "raw", *(F.col("x")[f].alias(f) for f in schema.fieldNames()))


def journal(spark: SparkSession, path: str, fail: bool = True) -> DataFrame:
    """Journal events with seq, raw_line and event_time; an invalid line fails the query.

    Without ``fail``, each line has its ``violation`` or null instead.
    """
    found = lines(spark, path).where(F.trim("value") != "").withColumn("violation", validate.journal_violation(F.col("value")))
    if fail:
        found = validate.required(found, F.concat(F.lit("journal line "), F.col("line_no"), F.lit(": "), F.col("violation"))).drop("violation")
    event = F.from_json("value", S.JOURNAL_EVENT)
    out = found.select(F.col("line_no").alias("seq"), F.col("value").alias("raw_line"), *([] if fail else ["violation"]), event.alias("x"))
    return out.select("seq", "raw_line", *([] if fail else ["violation"]), "x.*", F.try_to_timestamp("x.ts").alias("event_time"))


def training_samples(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """Training records; a broken key set or, with ``key``, a missing or wrong signature fails the query."""
    from ..functions import crypto

    found = json_lines(spark, path, S.CLEAN_SAMPLE)
    problem = validate.training_violation(F.col("raw"))
    if key is not None:
        expected = crypto.record_signature(F.col("instruction"), F.col("input"), F.col("output"), F.col("metadata.teacher_model"), key)
        problem = F.coalesce(problem, F.when(~crypto.verified(F.col("metadata.signature"), expected), "signature"))
    return validate.required(found, F.concat(F.col("path"), F.lit(" line "), F.col("line_no"), F.lit(": "), problem))


def eval_samples(spark: SparkSession, path: str, most: int) -> DataFrame:
    """Samples of the first ``most`` physical lines; blank and broken lines count."""
    return json_lines(spark, path, S.RAW_SAMPLE).where(F.col("line_no") < most)


def newest_lines(spark: SparkSession, path: str, pattern: str, n: int) -> DataFrame:
    """(path, line_no, value): the last ``n`` lines of the newest file of that name, as it is now; a file that was cut is read from its start."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    found = files.select("path", "modificationTime").orderBy(F.desc("modificationTime"), "path").first()
    if found is None:
        return lines(spark, path, pattern)
    return lines(spark, found.path).orderBy(F.desc("line_no")).limit(n)


def prompts(spark: SparkSession, path: str, prefix: str = "prompt") -> DataFrame:
    """(id, prompt): one for each line that isn't blank, numbered over all files in the order of path and line."""
    found = lines(spark, path).withColumn("prompt", F.trim("value")).where("prompt <> ''")
    # files are small numbers of rows; lines are placed within ranges of their file
    cut = found.withColumn("_range", F.floor(F.col("line_no") / PROMPTS))
    before = Window.orderBy("path", "_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = cut.groupBy("path", "_range").count().select("path", "_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("path", "_range").orderBy("line_no")) - 1
    return cut.withColumn("_place", place).join(shifts, ["path", "_range"]).select(F.format_string(f"{prefix}_%06d", F.col("_before") + F.col("_place")).alias("id"), "prompt")


#: Lines of a file whose prompts are put in order in one task.
PROMPTS = 100_000


def names(spark: SparkSession, path: str) -> DataFrame:
    """(name): trimmed lines that aren't blank, as of a list of repositories."""
    return lines(spark, path, numbers=False).select(F.trim("value").alias("name")).where("name <> ''")


def source_files(spark: SparkSession, path: str, stack: str = "any", least: int = 100, most: int = 1_048_576) -> DataFrame:
    """(path, length, content) of source files of the stack; the size is tested before contents are read."""
    from ..functions import text

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.where(text.source_file(F.col("path"), F.col("length"), stack, least, most)).select("path", "length", "content")


def run_states(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row per state file with ``modified``; broken files are left out."""
    files = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_modification_time").alias("modified"), "value")
    return files.where(F.try_parse_json("value").isNotNull()).select("modified", F.from_json("value", schema).alias("x")).select("modified", "x.*")


def prices(spark: SparkSession, overrides: DataFrame | None = None) -> DataFrame:
    """(model, input_price, output_price): the defaults, overlaid by a table of the same columns."""
    return S.prices(spark) if overrides is None else prefer(overrides, S.prices(spark), "model")


def settings(defaults: dict, overrides: dict) -> dict:
    """Configuration of both, the overrides winning."""
    return defaults | {k: v for k, v in overrides.items() if v is not None}


def line_counts(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, n): lines of each file, blank ones too."""
    return lines(spark, path, pattern, numbers=False).groupBy("path").agg(F.count("*").alias("n"))


def json_array_of(text: Column) -> Column:
    """The lines of a text as parsed JSON; a broken line fails the query."""
    return F.transform(F.filter(F.split(text, "\n"), lambda x: F.trim(x) != ""), lambda x: F.parse_json(x))


def frames(rows: DataFrame) -> DataFrame:
    """Server-sent events of lines (stream, line_no, value): (stream, frame, data).

    A frame ends at a blank line; its ``data:`` lines are joined by line feeds,
    comments and other fields are ignored, and frames without data or with data
    that isn't JSON are skipped.
    """
    before = Window.partitionBy("stream").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    value = F.regexp_replace("value", r"\r$", "")
    framed = rows.withColumn("value", value).withColumn("frame", F.coalesce(F.sum((F.col("value") == "").cast("int")).over(before), F.lit(0)))
    data = framed.where(F.col("value").startswith("data:")).withColumn("data", F.regexp_replace(F.substring("value", 6, 1 << 30), r"^ ", ""))
    joined = data.groupBy("stream", "frame").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "data"))), lambda x: x["data"]), "\n").alias("data"))
    return joined.where(F.try_parse_json("data").isNotNull())


def path_contained(path: str, base: str) -> bool:
    """Whether a path, with links resolved, lies in a folder; a check on the driver before paths are read or written."""
    import os

    real, root = os.path.realpath(path), os.path.realpath(base)
    return os.path.commonpath([real, root]) == root


def key_sets(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """(keys, n): the sets of keys that JSON rows have."""
    return rows.groupBy(F.array_sort(json.key_set(F.col(raw))).alias("keys")).agg(F.count("*").alias("n"))
