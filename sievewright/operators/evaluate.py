"""Scores of model answers, and the choice of the best round or trial."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import json, text
from .ordering import ranged

#: Of approximate percentiles: their error in rank is a share of at most 1 / _ACCURACY.
_ACCURACY = 10_000
#: Half of the share of ranks that is looked at for an exact percentile, and the rows below which all are.
_SLACK, _SMALL = 0.003, 1_000


def with_scores(answers: DataFrame, output: str = "output", keep: int = 500) -> DataFrame:
    """``answers`` (sample_id, success, output) with the fields of an evaluation result."""
    o = F.coalesce(F.col(output), F.lit(""))
    scored = answers.withColumn("json_method", json.json_method(o)).withColumn("format_details", text.format_checks(o))
    return scored.withColumns(
        {
            "json_valid": F.col("json_method") != "not_json",
            "format_compliant": F.col("format_details.format_compliant"),
            "has_repetition": F.col("format_details.has_repetition"),
            "output_length": F.length(o).cast("bigint"),
            output: F.substring(o, 1, keep),
        }
    )


def _metric_columns() -> list[Column]:
    good = F.coalesce(F.col("success"), F.lit(False))

    def rate(column: str) -> Column:
        return F.avg(F.when(good, F.coalesce(F.col(column), F.lit(False)).cast("int")))

    return [
        F.count("*").alias("total_samples"),
        F.count_if(good).alias("successful_samples"),
        F.count_if(~good).alias("failed_samples"),
        F.avg(good.cast("int")).alias("success_rate"),
        rate("json_valid").alias("json_parse_rate"),
        rate("format_compliant").alias("format_compliance_rate"),
        rate("has_repetition").alias("repetition_rate"),
        F.avg(F.when(good, F.coalesce(F.col("output_length"), F.lit(0)))).alias("avg_output_length"),
    ]


def metrics(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts and rates of results (success, json_valid, format_compliant, has_repetition, output_length).

    Rates after the first are over successful samples, null without any. No rows
    give no metrics.
    """
    return results.groupBy(*(by or [])).agg(*_metric_columns()).where("total_samples > 0")


def report(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two tables of a report: one row of metrics, and the results, sorted by sample_id where they are written."""
    return metrics(results), results.select("sample_id", *(c for c in results.columns if c != "sample_id")).orderBy("sample_id")


def latency_summary(rows: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """n, mean, p50 and p95 by the nearest rank, round((n - 1) * share) with halves to even.

    An approximate percentile, whose error in rank has a bound, brackets each
    exact one; values below the bracket are counted, and only the few inside it
    are ranked, equal ones as one row.
    """
    groups, shares = [F.col(c) for c in by] if by else [F.lit(0)], (0.5, 0.95)
    keys = [f"_k{i}" for i in range(len(groups))]
    valued = rows.where(F.col(value).isNotNull()).select(*(c.alias(k) for c, k in zip(groups, keys, strict=True)), F.col(value).alias("v"))
    cuts = [min(max(p + d, 0.0), 1.0) for p in shares for d in (-_SLACK, _SLACK)]
    stats = valued.groupBy(*keys).agg(F.count("*").alias("n"), F.avg("v").alias("mean"), F.percentile_approx("v", cuts, _ACCURACY).alias("cut"))

    def both(left: DataFrame, right: DataFrame) -> DataFrame:
        """Joined by the keys, of which null is one."""
        named = right.withColumnsRenamed({k: f"{k}_" for k in keys})
        on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys))
        return left.join(named if by else F.broadcast(named), on).drop(*(f"{k}_" for k in keys))  # without ``by`` it is one row

    found = stats
    for i in range(len(shares)):
        low, high = F.col("cut")[2 * i], F.col("cut")[2 * i + 1]
        # values below the bracket are one row with the rest of what is counted
        small = F.col("n") < _SMALL
        counted = both(valued, stats).where(small | (F.col("v") <= high)).groupBy(*keys, F.when(small | (F.col("v") >= low), F.col("v")).alias("v")).agg(F.count("*").alias("c"), F.any_value("n").alias("n"))
        upto = F.sum("c").over(Window.partitionBy(*keys).orderBy(F.col("v").asc_nulls_first()))
        rank = F.bround((F.col("n") - 1) * F.lit(shares[i]), 0)
        at = counted.withColumn("_upto", upto).where((F.col("_upto") > rank) & (F.col("_upto") - F.col("c") <= rank) & F.col("v").isNotNull())
        found = both(found, at.select(*keys, F.col("v").alias(f"p{round(100 * shares[i])}")))
    return found.select(*(F.col(k).alias(c) for c, k in zip(by or [], keys, strict=False)), "n", "mean", *(f"p{round(100 * p)}" for p in shares))


def best_round(reports: DataFrame) -> DataFrame:
    """The round of the best metric (format_compliance_rate, else success_rate); the earliest of equals, none of 0."""
    metric = F.coalesce("format_compliance_rate", "success_rate")
    scored = reports.select("round", metric.alias("metric")).where("metric > 0")
    return scored.agg(F.max_by("round", F.struct("metric", -F.col("round"))).alias("best_round"), F.max("metric").alias("best_metric")).where("best_round is not null")


def best_trial(trials: DataFrame) -> DataFrame:
    """The trial of the least loss (eval_loss, else train_loss, else infinite); the first of equals."""
    loss = F.coalesce("eval_loss", "train_loss", F.lit(float("inf")))
    return trials.select("trial", loss.alias("loss")).agg(F.min_by("trial", F.struct("loss", "trial")).alias("best_trial"), F.min("loss").alias("best_loss"))


def best_so_far(rows: DataFrame, value: str, order: list[str], by: list[str] | None = None) -> DataFrame:
    """``rows`` with ``best`` (the least value up to the row) and ``improved`` (whether the row set it).

    Without ``by`` the order is one column of numbers, and its ranges are summed
    up first, so that no task has all rows.
    """
    if not by:
        cut = ranged(rows, order[0])
        least = cut.groupBy("_range").agg(F.min(value).alias("_least"))
        earlier = F.min("_least").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
        cut = cut.join(F.broadcast(least.select("_range", earlier.alias("_earlier"))), "_range")
        inner = Window.partitionBy("_range").orderBy(F.col(order[0]).asc_nulls_first(), "_tie")
        before = F.least(F.min(value).over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.col("_earlier"))
        done = cut.withColumn("_before", before).withColumn("best", F.least("_before", value))
        return done.withColumn("improved", F.coalesce(F.col(value) < F.col("_before"), F.col(value).isNotNull())).select(*rows.columns, "best", "improved")
    window = Window.partitionBy(*by).orderBy(*order)
    before = F.min(value).over(window.rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("best", F.min(value).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("improved", F.coalesce(F.col(value) < before, F.col(value).isNotNull()))


def gram_counts(rows: DataFrame, key: str, column: str, size: int = 5) -> DataFrame:
    """(key, gram, n): character n-grams of a text."""
    grams = F.regexp_extract_all(column, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))
    return rows.select(key, F.explode(grams).alias("gram")).groupBy(key, "gram").agg(F.count("*").alias("n"))
