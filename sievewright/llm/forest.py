"""Approximate nearest neighbours with a forest of hash prefixes.

``build_index`` makes a forest for each block of vectors (one Arrow batch) and
stores it as a row: in each of ``TREES`` trees the block's rows stand sorted by a
string of ``DEPTH`` bits, the sides of random hyperplanes on which the vector
lies. The hyperplanes come from a seed, so nothing is fitted to the data. A block
is built and searched where it lies: no vector is shuffled, a vector of which a
third of all rows are copies is spread over all blocks, and a lost executor costs
only its own blocks.

``search`` sends the queries to the blocks in packs of a bounded size. In a block,
a query first descends in each tree to the longest prefixes that it shares with a
row. Then all trees ascend together, a bit at a time; the rows that each step
adds are scored exactly. With ``p`` the chance that a hyperplane leaves the query
and its k-th best row so far on one side, a better row shares no prefix of ``x``
bits in any tree with a chance of at most ``(1 - p^x)^TREES``; a query stops where
this falls to ``MISS``. So the share of rows that are looked at follows from how
much nearer than others the neighbours lie, there is no cap on candidates, and the
bound on what is missed holds at every size. A block that has fewer rows than
asked for is looked at in full.

Vectors that are null, empty, zero or hold a null or a value that isn't finite
take no part, and neither do rows without an id. A vector of another length than
the query's is no candidate. Rows that share the query's id are its own; a query
id of several rows is searched by the least of their vectors. Other rows that
repeat an id are candidates each. Ties go to the smaller id. An empty table, or
one without queries, gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import discard, read_again, shared_dir, table, written
from ._text import ranges

TREES = 64
#: Bits of a hash string.
DEPTH = 32
#: Chance with which a neighbour may be missed.
MISS = 0.02
#: Queries that go to the executors in one pass, about; more take more passes.
PACK = 32_768
#: Rows times queries that a step holds marks of.
CELLS = 1 << 22
#: Pairs that are scored at once.
PAIRS = 1 << 15

EVERY = 50
NEAREST = 5


def _planes(dim: int, trees: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, trees * DEPTH), np.float32)


def _codes(vectors: np.ndarray, planes: np.ndarray, trees: int) -> np.ndarray:
    """The hash strings (trees, rows) as numbers whose first bit is the highest."""
    out = np.empty((trees, len(vectors)), np.uint32)
    for low in range(0, len(vectors), 1024):
        sides = vectors[low : low + 1024].astype(np.float32) @ planes > 0
        packed = np.packbits(sides.reshape(len(sides), trees, DEPTH), axis=2)
        out[:, low : low + 1024] = packed.reshape(len(sides), trees * 4).view(">u4").T
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors scaled to length 1 for hashing, through their largest value, so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def usable(vector: str) -> F.Column:
    """Whether a vector takes part."""
    v, bad = F.col(vector), F.lit(False)
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(v, odd) & F.exists(v, lambda x: x != 0), bad)


def _rows(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    kind = df.schema[vector_col].dataType
    element = "float" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "double"
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast(f"array<{element}>").alias("vector"))
    return rows.where(F.col("id").isNotNull() & usable("vector"))


def _by_length(ids: pa.Array, vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors as a matrix) for each length of vectors."""
    lengths, numbers = pc.list_value_length(vectors).to_numpy(), ids.to_numpy()
    for dim in np.unique(lengths):
        mine = np.flatnonzero(lengths == dim)
        yield numbers[mine], vectors.take(pa.array(mine)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def build_index(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = TREES, seed: int = 42, path: str | None = None) -> DataFrame:
    """Writes the forests of all blocks as Parquet to ``path`` (by default in the shared folder) and returns them."""
    spark, rows = df.sparkSession, _rows(df, id_col, vector_col)
    path = path or f"{shared_dir(spark)}/forest-{uuid.uuid4().hex}.parquet"
    schema = f"dim int, ids array<bigint>, vectors {rows.schema['vector'].dataType.simpleString()}, codes array<int>, places array<int>"

    def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            for ids, vectors in _by_length(batch.column(0), batch.column(1)):
                dim = vectors.shape[1]
                if dim not in planes:
                    planes = {dim: _planes(dim, trees, seed)}
                codes = _codes(_unit(vectors.astype(float)), planes[dim], trees)
                places = np.argsort(codes, axis=1, kind="stable")
                ordered = np.take_along_axis(codes, places, 1)
                one = lambda x: pa.ListArray.from_arrays(pa.array([0, x.size], pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), one(ids), one(vectors), one(ordered.view(np.int32)), one(places.astype(np.int32))], names=["dim", "ids", "vectors", "codes", "places"])

    rows.mapInArrow(forests, schema).write.parquet(path)
    found = read_again(spark, path, rows.sparkSession.createDataFrame([], schema).schema)
    found.trees, found.seed = trees, seed
    return found


class Block:
    """The forest of a block, and the search in it."""

    def __init__(self, dim: int, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray, places: np.ndarray):
        self.ids, self.trees = ids, len(codes) // len(ids)
        self.vectors = vectors.reshape(-1, dim).astype(float)
        self.norms = np.sqrt(np.einsum("ij,ij->i", self.vectors, self.vectors))
        self.codes, self.places = codes.view(np.uint32).reshape(self.trees, -1), places.reshape(self.trees, -1)

    def _deepest(self, codes: np.ndarray) -> np.ndarray:
        """The longest prefix that each query shares with a row in any tree."""
        best = np.zeros(codes.shape[1], np.int64)
        for tree, wanted in zip(self.codes, codes):
            at = np.searchsorted(tree, wanted)
            for side in (np.maximum(at - 1, 0), np.minimum(at, len(tree) - 1)):
                apart = (tree[side] ^ wanted).astype(float)
                best = np.maximum(best, DEPTH - np.frexp(apart)[1])
        return best

    def _added(self, codes: np.ndarray, asked: np.ndarray, bits: int, low: np.ndarray, high: np.ndarray, marks: np.ndarray) -> None:
        """Marks the rows that share ``bits`` bits with a query in some tree and lie beyond the ranges so far, which grow."""
        span = np.uint32((1 << (DEPTH - bits)) - 1)
        for t, tree in enumerate(self.codes):
            wanted = codes[t, asked]
            left, right = np.searchsorted(tree, wanted & ~span), np.searchsorted(tree, wanted | span, "right")
            fresh = low[t, asked] < 0
            old_left, old_right = np.where(fresh, right, low[t, asked]), np.where(fresh, right, high[t, asked])
            for start, end in ((left, old_left), (old_right, right)):
                counts = end - start
                marks[np.repeat(asked, counts), self.places[t][ranges(start, counts)]] = True
            grown = right > left
            low[t, asked[grown]], high[t, asked[grown]] = left[grown], right[grown]

    def search(self, queries: np.ndarray, vectors: np.ndarray, norms: np.ndarray, codes: np.ndarray, best: tuple[np.ndarray, np.ndarray], miss: float) -> None:
        """Brings the best scores and ids (queries, k) up to date, in place."""
        scores, ids = best
        k, n = scores.shape[1], len(self.ids)
        asked = np.arange(len(queries))
        deepest = self._deepest(codes)
        low, high = np.full((self.trees, len(queries)), -1), np.full((self.trees, len(queries)), -1)
        seen = np.zeros((len(queries), n), bool)
        for bits in range(int(deepest.max(initial=0)), -1, -1):
            now = asked[deepest[asked] >= bits]
            if not len(now):
                continue
            marks = np.zeros((len(queries), n), bool)
            if bits:
                self._added(codes, now, bits, low, high, marks)
            else:
                marks[now] = True
            marks &= ~seen
            seen |= marks
            self._score(marks, queries, vectors, norms, scores, ids)
            side = 1 - np.arccos(np.clip(scores[now, k - 1], -1, 1)) / np.pi
            done = (scores[now, k - 1] > -np.inf) & ((1 - side**bits) ** self.trees <= miss)
            asked = np.setdiff1d(asked, now[done])
            if not len(asked):
                break

    def _score(self, marks: np.ndarray, queries: np.ndarray, vectors: np.ndarray, norms: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        k, cells = scores.shape[1], np.flatnonzero(marks)
        for start in range(0, len(cells), PAIRS):
            q, row = np.divmod(cells[start : start + PAIRS], marks.shape[1])
            own = queries[q] == self.ids[row]
            q, row = q[~own], row[~own]
            made = np.einsum("ij,ij->i", vectors[q], self.vectors[row]) / (norms[q] * self.norms[row])
            good = made >= scores[q, k - 1]
            q, made, found = q[good], made[good], self.ids[row[good]]
            if not len(q):
                continue
            hit = np.unique(q)
            q, made, found = np.concatenate([q, np.repeat(hit, k)]), np.concatenate([made, scores[hit].ravel()]), np.concatenate([found, ids[hit].ravel()])
            order = np.lexsort((found, -made, q))
            q, made, found = q[order], made[order], found[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            top = place < k
            scores[q[top], place[top]], ids[q[top], place[top]] = made[top], found[top]


def search(index: DataFrame, queries: DataFrame, k: int = NEAREST, id_col: str = "vec_id", vector_col: str = "embedding", miss: float = MISS, pack: int = PACK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest cosine found for each query, written pack by pack."""
    spark, trees, seed = index.sparkSession, index.trees, index.seed
    rows = _rows(queries, id_col, vector_col).groupBy("id").agg(F.min("vector").alias("vector"))
    packs = max(1, -(-rows.count() // pack))
    asked = written(rows.withColumn("pack", F.pmod(F.xxhash64("id"), F.lit(packs)).cast("int")).repartition(F.col("pack")))
    path = f"{shared_dir(spark)}/nearest-{uuid.uuid4().hex}"
    out = "query_id bigint, rank int, vec_id bigint, score double"
    for number in range(packs):
        mine = asked.where(F.col("pack") == number).select("id", "vector").toArrow()
        by_length = {}
        for ids, vectors in _by_length(mine["id"].combine_chunks(), mine["vector"].combine_chunks()) if mine.num_rows else ():
            vectors = vectors.astype(float)
            by_length[vectors.shape[1]] = ids, vectors, np.sqrt(np.einsum("ij,ij->i", vectors, vectors)), _codes(_unit(vectors), _planes(vectors.shape[1], trees, seed), trees)
        sent = spark.sparkContext.broadcast(by_length)

        def nearest(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            best = {dim: (np.full((len(x[0]), k), -np.inf), np.full((len(x[0]), k), np.iinfo(np.int64).max)) for dim, x in sent.value.items()}
            for batch in batches:
                for row in range(batch.num_rows):
                    dim = batch.column(0)[row].as_py()
                    if dim not in best:
                        continue
                    parts = [batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in range(1, 5)]
                    block, (ids, vectors, norms, codes) = Block(dim, *parts), sent.value[dim]
                    step = max(1, CELLS // len(block.ids))
                    for low in range(0, len(ids), step):
                        part = slice(low, low + step)
                        block.search(ids[part], vectors[part], norms[part], codes[:, part], tuple(x[part] for x in best[dim]), miss)
            for dim, (scores, found) in best.items():
                q, place = np.nonzero(scores > -np.inf)
                yield pa.RecordBatch.from_arrays([pa.array(sent.value[dim][0][q]), pa.array(np.zeros(len(q), np.int32)), pa.array(found[q, place]), pa.array(scores[q, place])], names=["query_id", "rank", "vec_id", "score"])

        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        ranked = index.mapInArrow(nearest, out).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ranked.write.parquet(f"{path}/{number}")
        sent.destroy()
    discard(asked)
    return spark.read.schema(out).parquet(*(f"{path}/{number}" for number in range(packs)))


def op12_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each vector whose id is divisible by 50 its 5 nearest rows: query_id, rank, vec_id, score."""
    vectors = table(spark, sf_dir, "embeddings")
    index = build_index(vectors)
    found = search(index, vectors.where(F.col("vec_id") % EVERY == 0))
    discard(index)
    return found
