"""Language-model scoring by masked pseudo-likelihood.

Words of the whole corpus are counted first. The most frequent are tokens of the
network; all others share hashed tokens, and a word's probability is its token's
times the word's share of that token, by its count in the corpus. These counts
grow with the corpus and stay in Spark, dealt to buckets by hash; occurrences of
such words are dealt to the same buckets, and only sums come back.

A small network predicts each masked token from the ``WINDOW`` tokens on either
side: position-wise embeddings are summed, passed through tanh, and a two-level
softmax gives the token's group and then the token within the group, so that a
prediction costs 2 * sqrt(tokens) outputs. A document's score is the sum of
log p(word | both sides) over all its words.

Training is by rounds. A hash of the text and the place masks one in ``MASK``
positions, others in each round. Masked positions are dealt to shards by a hash of
their text, in an order of that hash; each shard makes its own steps, and the
shards' parameters are averaged by Spark, an array a shard, weighted by the
positions they saw. Neither depends on how rows were dealt to tasks, and so scores
don't either, but for the last digits of sums. The network's size is fixed by
constants, and the driver holds one copy.

Words are those between white space, lower-cased in A-Z. A null text counts as
empty; a text without words has n_tokens 0, score 0 and a null mean. Repeated
rows are scored each. A word that the corpus lacks counts as half a word. On an
empty corpus the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text as T
from ._shared import shuffle_partitions, whole_groups, written

#: Groups, and tokens of each group.
GROUPS = 64
HASHED = 1024
HIDDEN = 16
WINDOW = 2
MASK = 8
ROUNDS = 3
RATE = 0.1
STEP = 2048
#: Masked positions of a shard, and parameters that are averaged as one array.
SHARD = 1 << 19
_PARAMETERS = 1 << 14
#: Tokens that are predicted at once.
_CHUNK = 1 << 15
_LOW = np.uint64((1 << 48) - 1)


class Vocabulary:
    """Word hash -> token. Tokens 0.. are frequent words by rank; the last ``HASHED`` are shared; size is the padding.

    ``shared`` has how often words of each shared token occur.
    """

    def __init__(self, frequent: np.ndarray, size: int | None = None, shared: np.ndarray | None = None):
        self.size = size or GROUPS * GROUPS
        self.sorted = np.sort(frequent)
        self.rank = np.argsort(frequent, kind="stable")
        self.shared = np.ones(HASHED) if shared is None else np.maximum(shared, 1).astype(float)

    def tokens(self, words: np.ndarray) -> np.ndarray:
        shared = (self.size - HASHED + (words % np.uint64(HASHED)).astype(np.int64)).astype(np.int32)
        if not len(self.sorted):
            return shared
        at = np.minimum(np.searchsorted(self.sorted, words), len(self.sorted) - 1)
        return np.where(self.sorted[at] == words, self.rank[at].astype(np.int32), shared)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = T.text_buffers(batch.column(0))
        for low, high in T.slices(offsets, 4 * T.SLICE_BYTES):
            words = [T.word_spans(data, offsets[low + a : low + b + 1], T.SPACED)[2] for a, b in T.slices(offsets[low : high + 1])]
            found, n = np.unique(np.concatenate(words), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n): how often each word, by its hash, occurs in all texts."""
    return written(texts.mapInArrow(_word_counts, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The most frequent words, ties by hash, and what is left for the shared tokens."""
    top = counts.orderBy(F.desc("n"), "word").limit(GROUPS * GROUPS - HASHED).collect()
    shared = np.zeros(HASHED)
    for r in counts.groupBy(F.col("word").bitwiseAND(F.lit(HASHED - 1)).alias("token")).agg(F.sum("n").alias("n")).toLocalIterator():
        shared[r.token] = r.n
    for r in top:
        shared[r.word % HASHED] -= r.n
    return Vocabulary(np.array([r.word for r in top], np.int64).view(np.uint64), None, shared)


class Network:
    """Parameters as one flat array, with views by name."""

    SHAPES = {
        "embed": (2 * WINDOW, GROUPS * GROUPS + 1, HIDDEN),
        "bias": (HIDDEN,),
        "group": (HIDDEN, GROUPS),
        "group_bias": (GROUPS,),
        "word": (GROUPS, HIDDEN, GROUPS),
        "word_bias": (GROUPS, GROUPS),
    }
    SIZE = sum(int(np.prod(s)) for s in SHAPES.values())

    def __init__(self, flat: np.ndarray):
        self.flat, at = flat, 0
        for name, shape in self.SHAPES.items():
            n = int(np.prod(shape))
            setattr(self, name, flat[at : at + n].reshape(shape))
            at += n

    @classmethod
    def fresh(cls) -> Network:
        net = cls(np.random.default_rng(42).normal(0, 0.1, cls.SIZE).astype(np.float32))
        for name in ("bias", "group_bias", "word_bias"):
            getattr(net, name)[:] = 0
        return net

    def hidden(self, around: np.ndarray) -> np.ndarray:
        total = self.bias + self.embed[0][around[0]]
        for i in range(1, 2 * WINDOW):
            total += self.embed[i][around[i]]
        return np.tanh(total)

    def log_probabilities(self, around: np.ndarray, token: np.ndarray) -> np.ndarray:
        """log p(token | the tokens around) of each position."""
        h, group = self.hidden(around), token // GROUPS
        order = np.argsort(group.astype(np.int16), kind="stable")
        out = np.empty(len(token), np.float32)
        h, group, inner = h[order], group[order], token[order] % GROUPS  # a group's rows lie together
        logs = _picked(h @ self.group + self.group_bias, group)
        bounds = np.searchsorted(group, np.arange(GROUPS + 1)).tolist()
        for g, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            if high > low:
                logs[low:high] += _picked(h[low:high] @ self.word[g] + self.word_bias[g], inner[low:high])
        out[order] = logs
        return out

    def step(self, around: np.ndarray, token: np.ndarray, rate: float) -> None:
        """One step down the gradient of the mean log-loss."""
        order = np.argsort((token // GROUPS).astype(np.int16), kind="stable")
        around, token = around[:, order], token[order]  # a group's rows lie together
        h, group, inner = self.hidden(around), token // GROUPS, token % GROUPS
        n = len(token)
        d = _softmax(h @ self.group + self.group_bias)
        d[np.arange(n), group] -= 1
        back = d @ self.group.T
        self.group -= rate * (h.T @ d) / n
        self.group_bias -= rate * d.sum(axis=0) / n
        bounds = np.searchsorted(group, np.arange(GROUPS + 1)).tolist()
        for g, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            if high == low:
                continue
            part = h[low:high]
            d = _softmax(part @ self.word[g] + self.word_bias[g])
            d[np.arange(high - low), inner[low:high]] -= 1
            back[low:high] += d @ self.word[g].T
            self.word[g] -= (rate / np.sqrt(n * (high - low))) * (part.T @ d)
            self.word_bias[g] -= (rate / np.sqrt(n * (high - low))) * d.sum(axis=0)
        back *= 1 - h * h
        self.bias -= rate * back.sum(axis=0) / n
        for i in range(2 * WINDOW):
            # a token's gradient is averaged by the root of its count, so that rare tokens move too
            order = np.argsort(around[i], kind="stable")
            found, first = np.unique(around[i][order], return_index=True)
            counts = np.diff(np.append(first, n))
            total = np.add.reduceat(back[order], first, axis=0)
            self.embed[i][found] -= (rate * total / np.sqrt(counts * n)[:, None] * 4).astype(np.float32)


#: Beyond this a score is held; exp of it is still a number in single precision.
_HELD = 80.0


def _exp_sums(scores: np.ndarray) -> np.ndarray:
    """exp of the scores, in place, and its sum by row; scores of a small network need no maximum taken off."""
    np.clip(scores, -_HELD, _HELD, out=scores)
    np.exp(scores, out=scores)
    return scores @ np.ones(scores.shape[1], scores.dtype)


def _picked(scores: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Log-softmax at one place of each row; overwrites the scores."""
    found = np.clip(scores[np.arange(len(which)), which], -_HELD, _HELD)
    return found - np.log(_exp_sums(scores))


def _softmax(scores: np.ndarray) -> np.ndarray:
    sums = _exp_sums(scores)
    scores /= sums[:, None]
    return scores


def _surroundings(tokens: np.ndarray, bounds: np.ndarray, at: np.ndarray, padding: int) -> np.ndarray:
    """The 2 * WINDOW tokens around the positions ``at``, padding beyond the text (row i of the result: one offset)."""
    whose = np.searchsorted(bounds, at, "right") - 1
    low, high = bounds[whose], bounds[whose + 1]
    out = np.empty((2 * WINDOW, len(at)), np.int32)
    for i, k in enumerate(k for k in range(-WINDOW, WINDOW + 1) if k):
        p = at + k
        ok = (p >= low) & (p < high)
        out[i] = np.where(ok, tokens[np.where(ok, p, 0)], padding)
    return out


def _encoded(batches: Iterator[pa.RecordBatch], vocab: Vocabulary) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        data, offsets = T.text_buffers(batch.column(batch.num_columns - 1))
        for low, high in T.slices(offsets):
            _, _, words, bounds = T.word_spans(data, offsets[low : high + 1], T.SPACED)
            yield batch, low, high, words, vocab.tokens(words), bounds


def _text_keys(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each text's words in order; 0 without words."""
    place = (np.arange(len(words)) - np.repeat(bounds[:-1], np.diff(bounds))).astype(np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(T.mix(words + place * np.uint64(0x9E3779B97F4A7C15)), dtype=np.uint64)])
    return T.mix(total[bounds[1:]] - total[bounds[:-1]])


def _examples(vocab: Vocabulary, turn: int, shards: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(shard, key, examples) of each text: the tokens around its masked positions and those masked."""
        for _, _, _, words, tokens, bounds in _encoded(batches, vocab):
            keys = _text_keys(words, bounds)
            whose = np.repeat(np.arange(len(keys)), np.diff(bounds))
            place = (np.arange(len(words)) - bounds[whose]).astype(np.uint64)
            masked = np.flatnonzero(T.mix(keys[whose] + place) % np.uint64(MASK) == turn % MASK)
            found = np.concatenate([_surroundings(tokens, bounds, masked, vocab.size), tokens[masked][None]]).astype(np.uint16).T
            ends = np.searchsorted(whose[masked], np.arange(len(keys) + 1))
            some = np.flatnonzero(np.diff(ends))
            parts = [np.ascontiguousarray(found[ends[i] : ends[i + 1]]).tobytes() for i in some]
            yield pa.RecordBatch.from_arrays([pa.array((keys[some] % np.uint64(shards)).astype(np.int64)), pa.array(keys[some].view(np.int64)), pa.array(parts, pa.binary())], names=["shard", "key", "examples"])

    return rows


def _trainer(flat: np.ndarray, rate: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of (shard, examples), the parameters that each shard has learned, as arrays."""
        shard, net, seen, held, n = None, None, 0, [], 0

        def learn(least: int) -> None:
            nonlocal held, seen, n
            found = np.frombuffer(b"".join(held), np.uint16).reshape(-1, 2 * WINDOW + 1).astype(np.int64)
            done = 0
            while len(found) - done >= max(least, 1):
                part = found[done : done + STEP]
                net.step(np.ascontiguousarray(part[:, :-1].T), part[:, -1], rate)
                done += len(part)
            seen += done
            held, n = [found[done:].astype(np.uint16).tobytes()], len(found) - done

        def ended() -> pa.RecordBatch:
            learn(1)
            chunks = range(0, len(flat), _PARAMETERS)
            values = [net.flat[i : i + _PARAMETERS].tobytes() for i in chunks]
            columns = [pa.array(range(len(values)), pa.int32()), pa.array([shard] * len(values), pa.int64()), pa.array([seen] * len(values), pa.int64()), pa.array(values, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "shard", "seen", "parameters"])

        for batch in batches:
            for s, examples in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if s != shard:
                    if shard is not None:
                        yield ended()
                    shard, net, seen, held, n = s, Network(flat.copy()), 0, [], 0
                held.append(examples)
                n += len(examples) // (2 * (2 * WINDOW + 1))
                if n >= STEP:
                    learn(STEP)
        if shard is not None:
            yield ended()

    return rows


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mean of each chunk of parameters over the shards, in the order of shards."""
    for table in whole_groups(batches, ["chunk"], rows=1):
        sums: dict[int, list] = {}
        for chunk, seen, values in zip(*(table[c].to_pylist() for c in ("chunk", "seen", "parameters")), strict=True):
            have = sums.setdefault(chunk, [0.0, 0])
            have[0] = have[0] + np.frombuffer(values, np.float32).astype(np.float64) * seen
            have[1] += seen
        means = [(x / n).astype(np.float32).tobytes() for x, n in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(means, pa.binary())], names=["chunk", "parameters"])


def train(texts: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS, total: int | None = None) -> Network:
    """A network trained on the masked positions of all texts (of ``total`` words), by averaging over shards in each round."""
    if total is None:
        total = texts.mapInArrow(_word_counts, "word bigint, n bigint").agg(F.sum("n")).first()[0] or 0
    shards, n = -(-total // (MASK * SHARD)) or 1, shuffle_partitions(texts.sparkSession)
    net = Network.fresh()
    for turn in range(rounds):
        dealt = texts.mapInArrow(_examples(vocab, turn, shards), "shard bigint, key bigint, examples binary").repartition(n, "shard").sortWithinPartitions("shard", "key", "examples")
        made = dealt.select("shard", "examples").mapInArrow(_trainer(net.flat, RATE * 8 / (1 + turn)), "chunk int, shard bigint, seen bigint, parameters binary")
        mean = made.repartition(n, "chunk").sortWithinPartitions("chunk", "shard").mapInArrow(_averaged, "chunk int, parameters binary").toArrow()
        if not mean.num_rows:
            break
        flat = net.flat.copy()
        for chunk, values in zip(mean["chunk"].to_pylist(), mean["parameters"].to_pylist(), strict=True):
            part = np.frombuffer(values, np.float32)
            flat[chunk * _PARAMETERS : chunk * _PARAMETERS + len(part)] = part
        net = Network(flat)
    return net


_SCORED = "batch bigint, bucket int, ids array<bigint>, n array<bigint>, sums array<double>, words binary, at binary, count bigint"


def _bucket_of(words: np.ndarray, buckets: int) -> np.ndarray:
    return (words >> np.uint64(48)).astype(np.int64) * buckets >> 16


def _scorer(flat: np.ndarray, vocab: Vocabulary, buckets: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per batch of texts with the network's sums, and a row per batch and bucket with the rare words."""
        net, number = Network(flat), TaskContext.get().partitionId() << 32
        for batch, low, high, words, tokens, bounds in _encoded(batches, vocab):
            number += 1
            logs = np.zeros(len(tokens) + 1)
            for i in range(0, len(tokens), _CHUNK):
                at = np.arange(i, min(i + _CHUNK, len(tokens)))
                logs[at + 1] = net.log_probabilities(_surroundings(tokens, bounds, at, vocab.size), tokens[at])
            rare = np.flatnonzero(tokens >= vocab.size - HASHED)
            logs[rare + 1] -= np.log(vocab.shared[tokens[rare] - (vocab.size - HASHED)])
            sums = np.cumsum(logs)
            whole = {"batch": number, "bucket": None, "ids": batch.column(0).slice(low, high - low).to_pylist(), "n": np.diff(bounds).tolist(), "sums": (sums[bounds[1:]] - sums[bounds[:-1]]).tolist()}
            bucket = _bucket_of(words[rare], buckets)
            order = np.argsort(bucket, kind="stable")
            rare, bucket = rare[order], bucket[order]
            whose = (np.searchsorted(bounds, rare, "right") - 1).astype(np.int32)
            edges = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket)).tolist()
            parts = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                hashes = np.ascontiguousarray(words[rare[a:b]]).view(np.uint8).reshape(-1, 8)[:, :6]
                parts.append({"batch": number, "bucket": int(bucket[a]), "words": hashes.tobytes(), "at": np.ascontiguousarray(whose[a:b].view(np.uint8).reshape(-1, 4).T).tobytes()})
            yield pa.RecordBatch.from_pylist([whole, *parts], schema=_KINDS)

    return rows


_KINDS = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("ids", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("sums", pa.list_(pa.float64())), ("words", pa.binary()), ("at", pa.binary()), ("count", pa.int64())])


def _counted(buckets: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words and counts (word, n) by bucket, packed."""
        for batch in batches:
            words = np.ascontiguousarray(batch.column(0).to_numpy()).view(np.uint64)
            n, bucket = batch.column(1).to_numpy(), _bucket_of(words, buckets)
            order = np.argsort(bucket, kind="stable")
            edges = np.append(np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order)).tolist()
            parts = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                hashes = np.ascontiguousarray(words[order[a:b]]).view(np.uint8).reshape(-1, 8)[:, :6]
                parts.append({"bucket": int(bucket[order[a]]), "words": hashes.tobytes(), "at": np.ascontiguousarray(n[order[a:b]].astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes()})
            yield pa.RecordBatch.from_pylist(parts, schema=_KINDS)

    return rows


def _unpacked(words: bytes, values: bytes, kind: type) -> tuple[np.ndarray, np.ndarray]:
    n = len(words) // 6
    hashes = np.zeros((n, 8), np.uint8)
    hashes[:, :6] = np.frombuffer(words, np.uint8).reshape(n, 6)
    return hashes.view(np.uint64).ravel(), np.ascontiguousarray(np.frombuffer(values, np.uint8).reshape(-1, n).T).view(kind).ravel()


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a bucket's counts (batch is null) and occurrences, the sums of log counts by batch and text."""
    for table in whole_groups(batches, ["bucket"], rows=1):
        bucket, batch = table["bucket"].to_pylist(), table["batch"].to_pylist()
        words, at = table["words"].to_pylist(), table["at"].to_pylist()
        starts = [i for i in range(len(bucket)) if not i or bucket[i] != bucket[i - 1]]
        out = []
        for low, high in zip(starts, [*starts[1:], len(bucket)], strict=True):
            known = [_unpacked(words[i], at[i], np.int64) for i in range(low, high) if batch[i] is None]
            keys, counts = (np.concatenate([k[j] for k in known]) for j in (0, 1)) if known else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            order = np.argsort(keys)
            keys, counts = keys[order], counts[order]
            for i in range(low, high):
                if batch[i] is not None:
                    found, whose = _unpacked(words[i], at[i], np.int32)
                    place = np.minimum(np.searchsorted(keys, found), max(len(keys) - 1, 0))
                    n = np.where(keys[place] == found, counts[place], 0.5) if len(keys) else np.full(len(found), 0.5)
                    total = np.bincount(whose, np.log(n))
                    some = np.unique(whose)
                    out.append((batch[i], some.tolist(), total[some].tolist()))
        columns = list(zip(*out, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.list_(pa.int64())), pa.array(columns[2], pa.list_(pa.float64()))], names=["batch", "n", "sums"])


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The network's sums of each batch (kind 0) and what its rare words add."""
    for table in whole_groups(batches, ["batch"], rows=1):
        kind, batch = table["kind"].to_pylist(), table["batch"].to_pylist()
        starts = [i for i in range(len(kind)) if not kind[i]]
        for low, high in zip(starts, [*starts[1:], len(kind)], strict=True):
            sums = np.array(table["sums"][low].values)
            for i in range(low + 1, high):
                assert batch[i] == batch[low]
                sums[table["n"][i].values.to_numpy()] += table["sums"][i].values.to_numpy()
            yield pa.RecordBatch.from_arrays([table["ids"][low].values, table["n"][low].values, pa.array(sums)], names=["doc_id", "n_tokens", "pseudo_log_likelihood"])


def score(docs: DataFrame, net: Network, vocab: Vocabulary, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, pseudo_log_likelihood (sum of log p of each word given both sides) and its mean per word.

    ``counts`` (word, n) are those of the corpus that the network was trained on.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n = shuffle_partitions(docs.sparkSession)
    scored = written(rows.mapInArrow(_scorer(net.flat, vocab, 2 * n), _SCORED))
    known = counts.select("word", "n").mapInArrow(_counted(2 * n), _SCORED)
    dealt = scored.where("bucket is not null").unionByName(known).select("bucket", "batch", "words", "at")
    shares = dealt.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(_shares, "batch bigint, n array<bigint>, sums array<double>")
    both = scored.where("bucket is null").select("batch", F.lit(0).alias("kind"), "ids", "n", "sums").unionByName(shares.select("batch", F.lit(1).alias("kind"), F.lit(None).cast("array<bigint>").alias("ids"), "n", "sums"))
    found = both.repartition(n, "batch").sortWithinPartitions("batch", "kind", "n").mapInArrow(_together, "doc_id bigint, n_tokens bigint, pseudo_log_likelihood double")
    return found.withColumn("mean_log_probability", F.when(F.col("n_tokens") > 0, F.col("pseudo_log_likelihood") / F.col("n_tokens")))


def fit_and_score(docs: DataFrame, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts the words of ``docs`` and trains on all of them, then scores all of them."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    counts = word_counts(texts)
    vocab = vocabulary(counts)
    total = counts.agg(F.sum("n")).first()[0] or 0
    return score(docs, train(texts, vocab, rounds, total), vocab, counts, id_col, text_col)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_and_score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
