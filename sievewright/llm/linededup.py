"""Line dedup by site-relative frequency.

Within each host, the pages that hold a line are divided by the host's pages;
lines above ``ratio`` (and on at least ``min_pages`` pages) are boilerplate and
are dropped from that host's pages. Lines are counted by hash, once per page,
and summed before the shuffle, so that a line on every page of a hot host is one
row per task. A host has at most (lines per page / ratio) such lines; they are
sent back as one list of hashes per host, and texts are not shuffled where that
table is small.

Lines are compared without outer white space of ASCII; blank lines are never dropped. A
line on fewer than ``min_pages`` pages is no boilerplate, as on a host of nine pages
each line of each page would be above a tenth. A
null host is a host of its own. A null text stays null, and a page of which all
lines go has an empty text; no row is dropped. Repeated rows are pages of their
own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import host_key, unused, written

#: Share of a host's pages above which a line is boilerplate.
RATIO = 0.1
MIN_PAGES = 10


def _trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r\x0b\x0c"))


def _line_hash(line: Column) -> Column:
    return F.xxhash64(_trimmed(line))


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, pages, lines): the hashes of each host's boilerplate lines, from (host, text)."""
    hosts = pages.groupBy("host").agg(F.count("*").alias("pages"))
    lines = pages.select("host", F.explode(F.array_distinct(F.transform(F.split("text", "\n"), lambda x: F.when(_trimmed(x) != "", _line_hash(x))))).alias("line")).where("line is not null")
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    found = counts.join(hosts, "host").where(F.col("n") > F.col("pages") * ratio)
    return found.groupBy("host", "pages").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def drop_boilerplate(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, text_col: str = "text", host: Column | None = None) -> DataFrame:
    """``docs`` with the boilerplate lines taken out of ``text_col``, and n_dropped (lines taken out)."""
    host = host_key(F.col("source") if host is None else host)
    found = written(boilerplate(docs.select(host.alias("host"), F.col(text_col).alias("text")), ratio, min_pages))
    by, known, left = (unused(docs, c) for c in ("host", "lines", "kept"))
    marked = docs.withColumn(by, host).join(found.select(F.col("host").alias(by), F.col("lines").alias(known)), by, "left")
    parts = F.split(F.col(text_col), "\n")
    kept = F.filter(parts, lambda x: (_trimmed(x) == "") | ~F.array_contains(F.col(known), _line_hash(x)))
    cleaned = marked.withColumn(left, F.when(F.col(known).isNotNull(), kept))
    return cleaned.select(
        *(F.when(F.col(left).isNull(), F.col(c)).otherwise(F.array_join(left, "\n")).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c != "n_dropped"),
        F.when(F.col(left).isNull(), F.lit(0)).otherwise(F.size(parts) - F.size(left)).cast("bigint").alias("n_dropped"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return drop_boilerplate(docs).select("doc_id", "source", "text", F.length("text").cast("bigint").alias("n_chars"), "n_dropped")


#: White space that lines are trimmed of.
_BLANKS = "' ' || chr(9) || chr(13) || chr(11) || chr(12)"

ORACLE = f"""
WITH p AS (SELECT row_number() OVER () AS rid, doc_id, source, text, coalesce('s' || source, 'n') AS host, string_split(text, chr(10)) AS parts FROM documents),
h AS (SELECT host, count(*) AS pages FROM p GROUP BY host),
b AS (SELECT host, list(line) AS lines FROM (SELECT host, line, count(DISTINCT rid) AS n FROM (SELECT rid, host, trim(unnest(parts), {_BLANKS}) AS line FROM p) WHERE line <> '' GROUP BY host, line) JOIN h USING (host)
  WHERE n >= 10 AND n > pages * 0.1 GROUP BY host),
k AS (SELECT doc_id, source, text, parts, CASE WHEN lines IS NULL THEN parts ELSE list_filter(parts, lambda x: trim(x, {_BLANKS}) = '' OR NOT list_contains(lines, trim(x, {_BLANKS}))) END AS kept FROM p LEFT JOIN b USING (host))
SELECT doc_id, source, array_to_string(kept, chr(10)) AS text, length(array_to_string(kept, chr(10))) AS n_chars, CAST(coalesce(len(parts) - len(kept), 0) AS BIGINT) AS n_dropped FROM k
"""
