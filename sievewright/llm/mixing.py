"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Each document gets an exponential key, -ln(u) / quality, with u from a hash of
its id. A source's target buys complete epochs first: every document as often as
the source's whole size goes into the target. The rest buys documents by
ascending key, as long as the middle of a document lies within what is left;
the source misses its target by half a document at most.

The running sum of sizes by key is taken in levels, so that a source that holds a
third of all rows is never sorted in one task: keys fall into buckets of about
``BUCKET_ROWS`` rows of a source, the buckets' sums are summed up first, and rows
are sorted within their bucket alone. A source's documents are counted by classes
of quality, and a key's place among all of them follows from these counts, so that
buckets are of one size for any quality. Texts are read once; what is shuffled is
a few numbers per document. The table of sources, a row each, is ordered in one
task for its weights.

A null text has size 0 and a null source is a source of its own, the last in
order. Rows that share an id share u and are ordered by size; rows without an id
draw u by their text; each is a document. A source of size 0 has target 0. Reruns
agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import host_key, written

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix as a share of all words.
SHARE = 1.5
#: Times that a document may be taken at most.
MOST = 2
BUCKET_ROWS = 1_000
#: Classes of quality to each factor of two, and buckets that are summed up together.
CLASSES, BUCKETS_AT_ONCE = 16, 1_024

_SPACE = "\\x20\\x09-\\x0D"


def word_count(text: Column) -> Column:
    """Words between white space, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{_SPACE}]+")), F.lit(0)).cast("bigint")


def quality(text: Column, size: Column) -> Column:
    """From 0.2 to 1: a fifth, and the share of words that begin with a letter."""
    lettered = F.coalesce(F.regexp_count(text, F.lit(f"(^|[{_SPACE}])\\p{{L}}")), F.lit(0))
    return F.lit(0.2) + F.lit(0.8) * lettered / F.greatest(size, F.lit(1))


def uniform(key: Column, text: Column) -> Column:
    """A number in (0, 1] from a hash of the key, or of the text where that is null."""
    digits = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.concat(F.lit("null"), F.md5(F.coalesce(text, F.lit("")))))), 1, 12), 16, 10).cast("double")
    return (digits + 1) / float(1 << 48)


def targets(sources: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, n, source_size, target) from (source, n, source_size).

    Sources share ``share`` of all sizes by weight; none is above ``most`` times
    its size, and what that leaves over is shared again by weight. In order of
    size by weight, a source is held at its cap as long as the rest, shared among
    it and those after it, would exceed the cap.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1)).cast("double"))
    ranked = ranked.withColumn("cap", F.col("source_size") * float(most))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    sums = ranked.select(
        "*",
        (F.sum("source_size").over(whole) * float(share)).alias("total"),
        F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("before"),
        F.sum("weight").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("weights"),
    )
    level = (F.col("total") - F.col("before")) / F.col("weights")
    held = sums.withColumn("level", level).withColumn("held", F.col("cap") <= F.col("level") * F.col("weight"))
    # below the caps all share the level of the first source that isn't held
    open_level = F.min(F.when(~F.col("held"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(whole)["level"]
    return held.select("source", "n", "source_size", F.when(F.col("held"), F.col("cap")).otherwise(open_level * F.col("weight")).alias("target"))


def bucketed(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight: Column | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document: doc_id, source, size, key, s, source_size, target, epochs, and the bucket that rises with the key."""
    text = F.col(text_col)
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(text).alias("size"), text.alias("text"), *([weight.alias("weight")] if weight is not None else []))
    worth = (F.col("weight") if weight is not None else quality(F.col("text"), F.col("size"))).cast("double")
    keyed = sized.select("doc_id", "source", "size", (-F.ln(uniform(F.col("doc_id"), F.col("text"))) / worth).alias("key"), F.round(F.log2(worth) * CLASSES).cast("int").alias("class"))
    rows = written(keyed.withColumn("s", host_key(F.col("source"))))
    classes = rows.groupBy("source", "class").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    # (documents, quality) of each class, in order
    counted = F.transform(F.sort_array(F.collect_list(F.struct("class", "n"))), lambda c: F.struct(c["n"].cast("double").alias("n"), F.pow(F.lit(2.0), c["class"] / CLASSES).alias("worth")))
    found = written(classes.groupBy("source").agg(F.sum("n").alias("n"), F.sum("size").alias("source_size"), counted.alias("classes")))
    sources = found.select("source", "n", "source_size")
    bought = targets(sources, weights, share, most)
    bought = bought.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint"))
    bought = bought.select(host_key(F.col("source")).alias("s"), "source_size", "target", "epochs", "n", F.ceil(F.col("n") / bucket_rows).alias("buckets"))
    bought = written(bought.join(found.select(host_key(F.col("source")).alias("s"), "classes"), "s"))
    # documents of the source with a lesser key, as the classes' exponential laws have it
    place = F.aggregate("classes", F.lit(0.0), lambda total, c: total + c["n"] * (1 - F.exp(-c["worth"] * F.col("key"))))
    return rows.join(bought, "s").withColumn("bucket", F.least(F.floor(place / F.col("n") * F.col("buckets")), F.col("buckets") - 1)).drop("classes", "n")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight: Column | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, epochs, taken (words the mix takes, repeats counted).

    ``weight`` is the document's quality, above 0, as a Column over ``docs``; by
    default it is taken from the text.
    """
    rows = bucketed(docs, weights, share, most, id_col, text_col, source_col, weight, bucket_rows)
    sums = rows.groupBy("s", "bucket").agg(F.sum("size").alias("bucket_size")).withColumn("run", F.floor(F.col("bucket") / BUCKETS_AT_ONCE))
    ahead = Window.partitionBy("s").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("s", "run").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    above = sums.groupBy("s", "run").agg(F.sum("bucket_size").alias("x")).select("s", "run", F.coalesce(F.sum("x").over(ahead), F.lit(0)).alias("ahead"))
    sums = sums.withColumn("earlier", F.coalesce(F.sum("bucket_size").over(before), F.lit(0))).join(above, ["s", "run"]).select("s", "bucket", (F.col("earlier") + F.col("ahead")).alias("earlier"))
    within = Window.partitionBy("s", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.join(sums, ["s", "bucket"]).withColumn("upto", F.col("earlier") + F.sum("size").over(within))
    left = F.col("target") - F.col("epochs") * F.col("source_size")
    fits = (F.col("upto") - F.col("size") / 2 <= left) & (F.col("epochs") < most)
    return summed.select("doc_id", "source", "size", "source_size", "target", "epochs", (F.col("size") * (F.col("epochs") + fits.cast("int"))).alias("taken"))


def op4_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    coalesce(len(regexp_extract_all(text, '(^|[\x20\x09-\x0D])\p{L}')), 0) AS lettered,
    (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null' || md5(coalesce(text, '')))), 1, 12) AS BIGINT) + 1) / 281474976710656.0::DOUBLE AS u FROM documents),
k AS (SELECT *, -ln(u) / (0.2::DOUBLE + 0.8::DOUBLE * lettered / greatest(size, 1)) AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size, CAST([3, 1, 2][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight FROM d GROUP BY source),
c AS (SELECT *, source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS total,
    coalesce(sum(source_size * 2.0::DOUBLE) OVER (ORDER BY source_size * 2.0::DOUBLE / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(weight) OVER (ORDER BY source_size * 2.0::DOUBLE / weight, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM s),
l AS (SELECT *, (total - before) / weights AS level, cap <= (total - before) / weights * weight AS held FROM c),
t AS (SELECT source, source_size, CASE WHEN held THEN cap ELSE (SELECT min_by(level, cap / weight) FROM l WHERE NOT held) * weight END AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
r AS (SELECT doc_id, size, source_size, target, epochs, sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, round(target, 6) AS target,
  CAST(size * (epochs + CASE WHEN upto - size / 2.0::DOUBLE <= target - epochs * source_size AND epochs < 2 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""
