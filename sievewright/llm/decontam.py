"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` cuts the training documents into blocks of about
``SLICE_BYTES`` and stores one row per block: the block's terms (sorted 64-bit
word hashes), where each term's postings begin, and the postings, which are word
positions in the block. A document lies whole in one block, so that searching
needs no shuffle, a term that a third of all documents share is spread over all
blocks, and a lost executor costs only its own blocks. ``search`` sends the test
windows to every block; within a block the posting lists of a window are
intersected, moved by the term's offset, from the block's rarest term on. A
window with a term that the block lacks stops at once.

Test items go to the blocks in packs of a bounded size, one at a time: the driver
holds one pack, its matches are written before the next, and the passes meet by
the block's number and the document's place in it, which the index stores.

Words are runs of letters and digits (and any non-ASCII character) after
lower-casing A-Z. A null or empty text has no words: such a document is in the
result with zeros, such an item has no window. An item of fewer words than the
window is one window. Repeated document rows give repeated result rows; items
that share an id count as one, and so do items without an id, which count but
have no name in a list of names. Only the named columns are read, so extra columns
of any name do no harm.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import seen
from . import _text as T
from ._shared import discard, read_again, row_key, shared_dir, small_batches, unused, written

#: Words of test items that go to the executors in one pass; a larger set takes more passes.
PACK_WORDS = 2_000_000

#: Words beyond a window's own within which its words are near each other.
SLOP = 2

#: Bytes of a row group of the index; a row is looked at whole, and so few rows are held at once.
_GROUP = {"parquet.block.size": str(8 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}

_INDEX = "block bigint, doc_ids array<bigint>, doc_starts array<int>, terms array<bigint>, term_starts array<int>, postings array<int>"
_HITS = "block bigint, place int, doc_id bigint, n_words bigint, spans array<struct<first:int,last:int>>, items array<string>, near array<string>"


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        data, offsets = T.text_buffers(batch.column(1))
        for low, high in T.slices(offsets):
            _, _, words, bounds = T.word_spans(data, offsets[low : high + 1], T.ALNUM)
            block += 1
            order = np.argsort(words, kind="stable").astype(np.int32)
            terms, at = np.unique(words[order], return_index=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block]),
                    _one_list(batch.column(0).slice(low, high - low)),
                    _one_list(pa.array(bounds.astype(np.int32))),
                    _one_list(pa.array(terms.view(np.int64))),
                    _one_list(pa.array(np.append(at, len(order)).astype(np.int32))),
                    _one_list(pa.array(order)),
                ],
                names=["block", "doc_ids", "doc_starts", "terms", "term_starts", "postings"],
            )


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def build_index(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the positional index of ``docs`` as Parquet to ``path`` (by default in the shared folder) and returns it."""
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/index-{uuid.uuid4().hex}.parquet"
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    with small_batches(spark):
        rows.mapInArrow(_index_rows, _INDEX).write.options(**_GROUP).parquet(path)
    return read_again(spark, path, _INDEX)


class Windows:
    """The windows of a pack of test items as arrays; windows of equal words are one."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.window, self.words, self.items = window, [], []
        seen: dict[bytes, int] = {}
        for item, text in items:
            raw = (text or "").encode()
            _, _, words, _ = T.word_spans(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), T.ALNUM)
            for i in range(max(len(words) - window + 1, 1 if len(words) else 0)):
                part = words[i : i + window]
                k = seen.setdefault(part.tobytes(), len(self.words))
                if k == len(self.words):
                    self.words.append(part)
                    self.items.append([])
                self.items[k].append(item)
        self.items = [set(x) for x in self.items]
        self.sizes = np.array([len(x) for x in self.words], np.int64)
        self.vocabulary, inverse = np.unique(np.concatenate([*self.words, np.zeros(0, np.uint64)]), return_inverse=True)
        ends = np.cumsum(self.sizes)
        #: Vocabulary number of each term of each window, -1 past the end of a short one.
        self.ids = np.full((len(self.words), window), -1, np.int64)
        for i, (end, size) in enumerate(zip(ends, self.sizes, strict=True)):
            self.ids[i, :size] = inverse[end - size : end]


def _phrase(lists: list[np.ndarray]) -> np.ndarray:
    """Starts at which ``lists[i]`` has start + i for each i, from the shortest list on."""
    order = sorted(range(len(lists)), key=lambda i: len(lists[i]))
    starts = lists[order[0]] - order[0]
    for i in order[1:]:
        if not len(starts):
            break
        found = np.searchsorted(lists[i], starts + i)
        starts = starts[(found < len(lists[i])) & (lists[i][np.minimum(found, len(lists[i]) - 1)] == starts + i)]
    return starts


def _within(lists: list[np.ndarray], span: int) -> np.ndarray:
    """Places of the rarest term that have every other term less than ``span`` words away, from the rarest on."""
    lists = sorted(lists, key=len)
    at = lists[0]
    for other in lists[1:]:
        if not len(at):
            break
        at = at[np.searchsorted(other, at + span) > np.searchsorted(other, at - span, "right")]
    return at


def _near(lists: dict[int, np.ndarray], needed: dict[int, int], span: int, docs: np.ndarray, places: np.ndarray) -> set[int]:
    """Documents with a stretch of at most ``span`` words around one of the places that has every term (``needed`` times each), in any order."""
    found: set[int] = set()
    whose = np.searchsorted(docs, places, "right") - 1
    for at, d in zip(places.tolist(), whose.tolist(), strict=True):
        if d in found:
            continue
        starts = np.arange(max(at - span + 1, int(docs[d])), at + 1)
        ends = np.minimum(starts + span, docs[d + 1])
        if np.logical_and.reduce([np.searchsorted(lists[i], ends) - np.searchsorted(lists[i], starts) >= n for i, n in needed.items()]).any():
            found.add(d)
    return found


def _search_block(row: dict, windows: Windows, slop: int | None) -> dict[int, tuple[list, set, set]]:
    terms, first, postings, docs = row["terms"].view(np.uint64), row["term_starts"], row["postings"], row["doc_starts"]
    hits: dict[int, tuple[list, set, set]] = {}
    if not len(terms) or not len(windows.vocabulary):
        return hits
    at = np.minimum(np.searchsorted(terms, windows.vocabulary), len(terms) - 1)
    there = np.append(terms[at] == windows.vocabulary, True)  # -1: past the end of a short window
    for k in np.flatnonzero(there[windows.ids].all(axis=1)):
        size = int(windows.sizes[k])
        ids = at[windows.ids[k, :size]]
        lists = [postings[first[i] : first[i + 1]] for i in ids]
        span = size + (slop or 0)
        places = _within(lists, span)
        if not len(places):
            continue
        starts = _phrase(lists)
        doc = np.searchsorted(docs, starts, "right") - 1
        whole = starts + size <= docs[doc + 1] if len(starts) else np.zeros(0, bool)
        for d, s in zip(doc[whole].tolist(), starts[whole].tolist(), strict=True):
            found = hits.setdefault(d, ([], set(), set()))
            found[0].append((s - int(docs[d]), s - int(docs[d]) + size))
            found[1].update(windows.items[k])
        if slop is not None:
            needed = {int(i): int(n) for i, n in zip(*np.unique(ids, return_counts=True), strict=True)}
            for d in _near({i: postings[first[i] : first[i + 1]] for i in needed}, needed, span, docs, places):
                hits.setdefault(d, ([], set(), set()))[2].update(windows.items[k])
    return hits


def _names(items: set) -> list:
    return sorted(items, key=lambda x: (x is None, x))


def _searcher(items: Broadcast, window: int, slop: int | None):
    def search_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(items.value, window)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].values for n in ("doc_ids", "doc_starts", "terms", "term_starts", "postings")}
                row |= {n: row[n].to_numpy(zero_copy_only=False) for n in row if n != "doc_ids"}
                hits, n = _search_block(row, windows, slop), len(row["doc_ids"])
                empty: tuple[list, set, set] = ([], set(), set())
                out = [hits.get(d, empty) for d in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, batch.column("block")[i].as_py())),
                        pa.array(np.arange(n, dtype=np.int32)),
                        row["doc_ids"],
                        pa.array(np.diff(row["doc_starts"]).astype(np.int64)),
                        pa.array([[{"first": a, "last": b} for a, b in sorted(set(x[0]))] for x in out], pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                        pa.array([_names(x[1]) for x in out], pa.list_(pa.string())),
                        pa.array([_names(x[2] - x[1]) for x in out], pa.list_(pa.string())),
                    ],
                    names=["block", "place", "doc_id", "n_words", "spans", "items", "near"],
                )

    return search_rows


def _packs(items: DataFrame, item_col: str, text_col: str, pack_words: int) -> Iterator[tuple[int, int, Broadcast]]:
    """(number, packs, items sent to the executors) of each pack, which goes once its turn is over."""
    tests = items.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    words = tests.agg(F.sum(F.length("text"))).first()[0] or 0
    packs = max(1, -(-int(words) // (pack_words * 4)))
    for p in range(packs):
        chosen = tests.where(F.pmod(F.xxhash64("item", "text"), F.lit(packs)) == p).sort("item", "text")
        pack = items.sparkSession.sparkContext.broadcast([(r.item, r.text) for r in chosen.toLocalIterator()])
        try:
            yield p, packs, pack
        finally:
            pack.destroy()


def search(index: DataFrame, items: DataFrame, window: int = 10, slop: int | None = None, item_col: str = "item_id", text_col: str = "text", pack_words: int = PACK_WORDS) -> DataFrame:
    """Exact phrase matches, and with ``slop`` proximity matches, of the items' windows in the index.

    One row per document: doc_id, n_words, spans (word ranges ``[first, last)``
    of every occurrence of a window), items (ids with an exact match), near (ids
    without one, of which all words of a window lie, in any order, within window
    + slop words). The items go to the executors in packs of about
    ``pack_words`` words, one pass over the index each, so that what is sent has
    a bound; a usual benchmark is one pack.
    """
    passes = None
    for p, packs, pack in _packs(items, item_col, text_col, pack_words):
        found = index.mapInArrow(_searcher(pack, window, slop), _HITS)
        with small_batches(index.sparkSession):
            found = written(found.where((F.lit(p) == 0) | (F.size("items") > 0) | (F.size("near") > 0)))
        if packs == 1:
            return found.drop("block", "place")
        passes = found if passes is None else passes.unionByName(found)
    lists = [F.sort_array(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("spans", "items", "near")]
    merged = passes.groupBy("block", "place").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), *lists)
    return merged.withColumn("near", F.array_except("near", "items")).drop("block", "place")


def covered(spans: Column) -> Column:
    """Words inside any span of a sorted array of ``[first, last)``."""
    step = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0), x["last"] - F.greatest(x["first"], acc["end"]))).alias("n"), F.greatest(acc["end"], x["last"]).alias("end")),
    )
    return step["n"].cast("bigint")


def report(hits: DataFrame) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256 (of the comma-joined sorted ids), contaminated, n_near (further items that are near)."""
    return hits.select(
        "doc_id",
        "n_words",
        covered(F.col("spans")).alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array("items")), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        F.size("near").cast("bigint").alias("n_near"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` without the rows that hold a window of an item.

    Rows are told apart by id and text, so that of rows that share an id, or have
    none, only those go that hold a window themselves.
    """
    key = unused(docs, "row_key")
    keyed = docs.withColumn(key, row_key())
    bad = leaked(keyed, items, window, key)
    # rows that can't be among them stay where they are: texts are shuffled for a few rows, however many hold a window
    blocks = seen.blocks_for(bad.count())
    if blocks > seen.MOST_BLOCKS:
        return keyed.join(bad, key, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
    rows = keyed.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(key).alias("key"))
    met = seen.marked(rows, seen.seen_filter(bad, key, blocks), "key", blocks)
    # an anti join would be moved ahead of the filter
    doubtful = met.where("possible").join(bad.select(F.col(key).alias("key"), F.lit(True).alias("gone")), "key", "left").where("gone is null")
    return met.where("not possible").select("row.*").unionByName(doubtful.select("row.*"))


def leaked(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ids of documents that hold a window of an item, once each. Each block's index is searched where it is made and not stored."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = None
    for _, _, pack in _packs(items, "item_id", "text", PACK_WORDS):
        with small_batches(docs.sparkSession):
            hits = written(rows.mapInArrow(_leak_rows(pack, window), "doc_id bigint"))
        found = hits if found is None else found.unionByName(hits)
    return written(found.select(F.col("doc_id").alias(id_col)).distinct())


def _leak_rows(items: Broadcast, window: int):
    search_rows = _searcher(items, window, None)

    def leak_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hits in search_rows(_index_rows(batches)):
            yield hits.filter(pc.greater(pc.list_value_length(hits.column("spans")), 0)).select(["doc_id"])

    return leak_rows


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    index = build_index(docs)
    hits = search(index, items, window=10, slop=SLOP)
    discard(index)
    return report(hits)


ORACLE = """
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'), '[^ ]+') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'), '[^ ]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(list_slice(w, k, k + least(len(w), 10) - 1), ' ') AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS k FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
runs AS (SELECT rid, n, k, array_to_string(list_slice(w, k, k + n - 1), ' ') AS g
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d JOIN sizes ON len(w) >= n)),
hit AS (SELECT rid, item, k, n FROM runs JOIN win USING (n, g)),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(k, k + n)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid),
freq AS (SELECT word, count(*) AS c FROM (SELECT unnest(w) AS word FROM d) GROUP BY word),
wins AS (SELECT row_number() OVER () AS k, item, string_split(g, ' ') AS g, n FROM win),
rare AS (SELECT k, min_by(word, c) AS word FROM (SELECT k, unnest(g) AS word FROM wins) JOIN freq USING (word) GROUP BY k),
toks AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
cand AS (SELECT rid, k, item, g, n, p FROM wins JOIN rare USING (k) JOIN toks USING (word)),
around AS (SELECT c.*, w FROM cand c JOIN d USING (rid) WHERE list_has_all(list_slice(w, greatest(p - n - 1, 1), p + n + 1), g)),
tries AS (SELECT DISTINCT rid, item, g, list_slice(w, s, s + n + 1) AS x FROM (SELECT *, unnest(range(greatest(p - n - 1, 1), p + 1)) AS s FROM around)),
close AS (SELECT DISTINCT rid, item FROM tries WHERE len(list_filter(list_distinct(g), lambda u: len(list_filter(x, lambda v: v = u)) < len(list_filter(g, lambda v: v = u)))) = 0),
nears AS (SELECT rid, count(*) AS n_near FROM close c WHERE NOT EXISTS (FROM hit h WHERE h.rid = c.rid AND h.item IS NOT DISTINCT FROM c.item) GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid) LEFT JOIN nears USING (rid)
"""
