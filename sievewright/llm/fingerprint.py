"""Document fingerprints by a homomorphic multiset hash, in DataFrame functions only.

A text is the multiset of its paragraphs: its lines, cut again behind sentence
ends so that a text of one line has several. Each paragraph is hashed to a wide
vector of ``SIGNED`` lanes that hold its length or minus its length by the bits
of a hash, and ``CHECK`` lanes of 32 further hash bits; a text's fingerprint is
the sum of its paragraphs' vectors modulo 2^32. So fingerprints don't depend on
the order of paragraphs, the fingerprint of a union is a sum (``insert``), and a
paragraph is taken out by a subtraction (``delete``). Equal texts have equal
fingerprints; equal fingerprints of different multisets need all lanes to agree.

The signed lanes of two texts have a cosine that estimates the share of length
that they have in common; ``likeness`` is that cosine, 0 where it is negative,
and 1 for equal fingerprints.

``with_next`` finds each document's successor by id without sorting all texts in
one task: ids are cut at quantiles into ranges, an id that fills several is cut
further by a hash of the text, each range is sorted on its own, and the last of a
range gets the first of the next. Texts are shuffled once, by
range; all later steps keep that partitioning.

A null text counts as empty, and an empty text has the fingerprint zero. Rows of
a null id come first; rows that share an id are ordered by a hash of the text, then
by the text, and are documents of their own. In a table of one row that row follows itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import ordering
from ._shared import shuffle_partitions

SIGNED = 64
CHECK = 8
LANES = SIGNED + CHECK
_WORD = (1 << 32) - 1


def paragraphs(text: Column) -> Column:
    """The paragraphs of a text as an array; [''] for an empty one."""
    return F.split(F.coalesce(text, F.lit("")), "(?<=[.!?])[ \\t]+|\\n")


def lane_values(paragraph: Column) -> list[Column]:
    """The vector of one paragraph, lane by lane; all 0 for an empty one."""
    h = F.xxhash64(paragraph)
    size = F.length(paragraph).cast("bigint")
    signed = [size * (F.shiftright(h, i).bitwiseAND(F.lit(1)) * 2 - 1) for i in range(SIGNED)]
    some = F.when(paragraph == "", F.lit(0)).otherwise(F.lit(1)).cast("bigint")
    check = []
    for i in range(CHECK // 2):
        wide = F.xxhash64(F.lit(i), paragraph)
        check += [some * wide.bitwiseAND(F.lit(_WORD)), some * F.shiftrightunsigned(wide, 32)]
    return signed + check


def summed(rows: DataFrame, keys: list[str], paragraph: str = "paragraph") -> DataFrame:
    """keys and ``lanes`` (array of bigint below 2^32) from one row per paragraph."""
    vectors = [F.sum(v).alias(f"_{i}") for i, v in enumerate(lane_values(F.col(paragraph)))]
    found = rows.groupBy(*keys).agg(*vectors)
    return found.select(*keys, F.transform(F.array(*(f"_{i}" for i in range(LANES))), lambda x: x.bitwiseAND(F.lit(_WORD))).alias("lanes"))


def insert(lanes: Column, more: Column) -> Column:
    """The fingerprint of both multisets together."""
    return F.zip_with(lanes, more, lambda a, b: (a + b).bitwiseAND(F.lit(_WORD)))


def delete(lanes: Column, less: Column) -> Column:
    """The fingerprint without the paragraphs of the second."""
    return F.zip_with(lanes, less, lambda a, b: (a - b).bitwiseAND(F.lit(_WORD)))


def as_text(lanes: Column) -> Column:
    """Eight hex digits a lane."""
    return F.lower(F.array_join(F.transform(lanes, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1: the cosine of the signed lanes, 1 for equal fingerprints, 0 if just one is empty."""

    def signed(x: Column) -> Column:
        return F.transform(F.slice(x, 1, SIGNED), lambda v: F.when(v > (1 << 31), v - (1 << 32)).otherwise(v).cast("double"))

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    x, y = signed(a), signed(b)
    length = F.sqrt(dot(x, x) * dot(y, y))
    return F.when(a == b, F.lit(1.0)).when(length == 0, F.lit(0.0)).otherwise(F.least(F.greatest(dot(x, y) / length, F.lit(0.0)), F.lit(1.0)))


def with_next(rows: DataFrame, ranges: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, heads) of (doc_id, text): rows with range, at (place in the range), last (of it) and next (text).

    heads has, for each range, the text that follows its last row.
    """
    n = ranges or 4 * shuffle_partitions(rows.sparkSession)
    ranged = ordering.ranged(rows.withColumn("h", F.xxhash64("text")), "doc_id", n, "h").drop("_tie").withColumnRenamed("_range", "range")
    # the first row of each range: the least id, of its rows the least hash, and of those the least text
    least = ranged.groupBy("range").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "h")).alias("least"))
    order = Window.orderBy("range")
    follows = least.select("range", "least", F.coalesce(F.lag("range").over(order), F.max("range").over(Window.partitionBy())).alias("previous"))
    # one row for each range, of which there are a few times ``n`` at most
    first = ranged.join(F.broadcast(follows), "range").where(F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("h") == F.col("least.h")))
    heads = first.groupBy(F.col("previous").alias("range")).agg(F.min("text").alias("head"))
    place = Window.partitionBy("range").orderBy(F.col("doc_id").asc_nulls_first(), "h", "text")
    placed = ranged.select("range", "doc_id", "text", F.row_number().over(place).alias("at"), F.lead("text").over(place).alias("following"))
    placed = placed.withColumn("last", F.col("following").isNull())
    joined = placed.join(heads.withColumnRenamed("range", "_range"), (F.col("range") == F.col("_range")) & F.col("last"), "left")
    return joined.select("range", "at", "doc_id", "text", "last", F.coalesce("following", "head").alias("next")), heads


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edit, the second half replaced from the next document.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    placed, heads = with_next(rows, ranges)
    size = F.length("text")
    half = F.floor(size / 2).cast("int")
    edited = placed.select(
        "range", "at", "doc_id", "last", "text", size.cast("bigint").alias("n_chars"), F.concat(F.substring(F.col("text"), F.lit(1), size - half), F.substring(F.col("next"), F.lit(1), half)).alias("edited")
    ).withColumn("sha", F.sha2("edited", 256))
    both = edited.select("range", "at", "doc_id", "last", "n_chars", "sha", F.posexplode(F.array("text", "edited")).alias("which", "one"))
    pieces = both.select("range", "at", "doc_id", "last", "n_chars", "sha", "which", F.explode(paragraphs(F.col("one"))).alias("paragraph"))
    hashed = summed(pieces, ["range", "at", "doc_id", "last", "n_chars", "sha", "which"])
    ahead = Window.partitionBy("range").orderBy("at", "which")
    lined = hashed.select("*", F.lead("lanes", 1).over(ahead).alias("edited"), F.lead("lanes", 2).over(ahead).alias("next")).where("which = 0")
    head_lanes = summed(heads.select("range", F.explode(paragraphs(F.col("head"))).alias("paragraph")), ["range"]).select(F.col("range").alias("_range"), F.col("lanes").alias("head"))
    done = lined.join(head_lanes, (F.col("range") == F.col("_range")) & F.col("last"), "left").withColumn("next", F.coalesce("next", "head"))
    return done.select(
        "doc_id",
        "n_chars",
        F.col("sha").alias("edited_sha256"),
        as_text(F.col("lanes")).alias("fingerprint"),
        as_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("lanes"), F.col("edited")).alias("near_edited"),
        likeness(F.col("lanes"), F.col("next")).alias("near_next"),
    )


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(spark.read.parquet(f"{sf_dir}/documents.parquet"))
