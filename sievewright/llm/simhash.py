"""SimHash near-duplicates by a binary trie self-join under a Hamming budget.

``fingerprints`` hashes a document's word shingles (XXH64 of the UTF-8 text,
seed 42) and sets a bit where over half of the hashes have it. A fingerprint may
be wider than 64 bits: further words come from the same hash by a mixing
function, so that one pass over a text is enough.

``links`` joins equal-length keys with themselves. The top of the trie is a
shuffle key: a budget of e errors over p blocks leaves p - e blocks without an
error, so for each choice of such blocks the trie is rotated to begin with them
and node pairs at that depth are the diagonal alone. Below, node pairs are
walked level by level in numpy, all groups of a task at once: a node with itself
gives two selves and one pair (an error more), a pair gives four, and a pair
beyond the budget is dropped. A group with more keys than ``GROUP_LIMIT`` is
first split by Spark into the node pairs some bits further down, as often as
needed; that is the same walk, one shuffle a level. Distinct keys within 2 bits
are at most 2080 for 64 bits, so the walk stays linear in the keys.

Links between the members of a group leave a task as a spanning forest, never as
all pairs, and only links between different fingerprints are looked for: equal
ones are one class with the least id as its representative.

Where a key is but a lane of a wider fingerprint, keys within the lane's budget
are candidates, and the fingerprints don't travel with the keys. A group hands on
its candidate pairs, or a spanning tree of them where that is fewer, and these are
held against each other. A group of which the tree doesn't end up in one component
is read again, with fingerprints and components, and its candidates of different
components are tried one by one; in all other groups every candidate pair lies
within one component already. So each candidate pair is decided or needs no
decision, whatever the group's size. Pairs whose fingerprints leave the similarity
open are decided by the Jaccard similarity of their shingle sets. In a group that
is read again the sets come to the members that have such pairs, and the pairs
stay in the task: what a group hands on grows with its members, not their pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import seen
from . import _text as T
from ._shared import row_key, shuffle_partitions, unused, whole_groups, written
from .components import components

#: Keys of one trie group in one task; larger groups are split further down the trie.
GROUP_LIMIT = 50_000
#: Shingle sets that one side of a block of pairs has.
BLOCK_SETS = 500
#: Rows of groups that are read again, with fingerprints or shingle sets, that a task gathers before it looks at them.
SET_ROWS = 4_000
#: Shingles that are summed at once.
_CHUNK = 1 << 13
#: Bits of a byte, each in a byte of a 64-bit word, highest bit first in memory.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)).reshape(256, 8).view(np.uint64).ravel()


def shingle_hashes(text: bytes, k: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of k words, joined by spaces; of all words if they are fewer; none without words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(len(words) - k + 1, 1)
    last = ends[min(k, len(words)) - 1 :]
    return np.fromiter([hashed(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)], np.uint64, n)


class _Counter:
    """Sums the set bits of hashes by document: 8 bits of a byte are added as the bytes of one 64-bit word."""

    def __init__(self, width: int):
        self.lanes = width // 64
        self.salts = T.mix(np.arange(1, self.lanes, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """Set bits of all hashes, by bit of the fingerprint."""
        total = np.zeros(self.lanes * 64, np.int64)
        for low in range(0, len(hashes), _CHUNK):
            part = hashes[low : low + _CHUNK]
            wide = np.empty((len(part), self.lanes), ">u8")
            wide[:, 0] = part
            for i, salt in enumerate(self.salts):
                wide[:, i + 1] = T.mix(part ^ salt)
            spread = _SPREAD[wide.view(np.uint8).reshape(len(part), -1)]
            sums = np.add.reduceat(spread, np.arange(0, len(part), 255), axis=0)
            total += sums.view(np.uint8).reshape(len(sums), -1).sum(axis=0, dtype=np.int64)
        return total


def _hashed_texts(column: pa.Array, shingle: int, distinct: bool) -> Iterator[np.ndarray]:
    data, offsets = T.text_buffers(column)
    raw = data.data if len(data) else memoryview(b"")
    for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        hashes = shingle_hashes(bytes(raw[low:high]), shingle)
        yield np.unique(hashes) if distinct else hashes


def _named(hashes: np.ndarray) -> int:
    """A number for a text's shingles."""
    return xxhash.xxh64_intdigest(hashes.tobytes()) - (1 << 63)


def _fingerprinter(shingle: int, width: int, distinct: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(width)
        for batch in batches:
            out, names = [], []
            for hashes in _hashed_texts(batch.column(1), shingle, distinct):
                out.append(np.packbits(counter.counts(hashes) * 2 > len(hashes)).tobytes())
                names.append(_named(hashes))
            columns = [batch.column(0), pa.array(out, pa.binary()), *([pa.array(names, pa.int64())] if distinct else [])]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "fp", "sid"][: len(columns)])

    return rows


def fingerprints(docs: DataFrame, shingle: int = 3, width: int = 64, id_col: str = "doc_id", text_col: str = "text", distinct: bool = False) -> DataFrame:
    """(id, fp): the SimHash of each row's whole text as ``width`` / 8 bytes. A text without words has the fingerprint zero.

    With ``distinct``, a repeated shingle counts once, and ``sid`` names the text's set of shingles.
    """
    if width % 64:
        raise ValueError("width must be a multiple of 64")
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_fingerprinter(shingle, width, distinct), "id bigint, fp binary" + ", sid bigint" * distinct)


def _blocks(bits: int, parts: int) -> list[tuple[int, int]]:
    """(shift, width) of each block, from the highest bits down."""
    edges = [round(i * bits / parts) for i in range(parts + 1)]
    return [(bits - b, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def walk(keys: np.ndarray, nodes: list[tuple[np.ndarray, ...]], bits: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Walks node pairs of binary tries down to pairs of keys within the budget.

    keys are sorted within every node; nodes holds arrays (low1, high1, low2,
    high2, errors) of key ranges, a node with itself where the ranges are equal.
    Yields index pairs.
    """
    low1, high1, low2, high2, errors = nodes
    for bit in range(bits - 1, -1, -1):
        if not len(low1):
            return
        single = (high1 - low1 == 1) & (high2 - low2 == 1)
        if single.any():
            a, b = low1[single], low2[single]
            rest = (keys[a] ^ keys[b]) & np.uint64((1 << (bit + 1)) - 1)
            near = (a != b) & (errors[single] + np.bitwise_count(rest) <= budget)
            yield a[near], b[near]
            low1, high1, low2, high2, errors = (x[~single] for x in (low1, high1, low2, high2, errors))
        ones = np.concatenate([[0], np.cumsum((keys >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)])
        mid1 = high1 - (ones[high1] - ones[low1])
        mid2 = high2 - (ones[high2] - ones[low2])
        cross = low1 != low2
        made = [
            (low1, mid1, low2, mid2, errors),
            (mid1, high1, mid2, high2, errors),
            (low1, mid1, mid2, high2, errors + 1),
            tuple(x[cross] for x in (mid1, high1, low2, mid2, errors + 1)),
        ]
        kept = []
        for a, b, c, d, e in made:
            ok = (a < b) & (c < d) & (e <= budget) & ((a != c) | (b - a > 1))
            kept.append([x[ok] for x in (a, b, c, d, e)])
        low1, high1, low2, high2, errors = (np.concatenate(x) for x in zip(*kept, strict=True))
    single = (high1 - low1 == 1) & (high2 - low2 == 1) & (low1 != low2)
    yield low1[single], low2[single]  # all bits are used: equal remainders of the two sides


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each of 0..n-1 under the links a-b."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        np.minimum.at(new, label[a], new[a])
        np.minimum.at(new, label[b], new[b])
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


#: Columns of a row of a group that is read again.
_OPEN = ["node", "side", "rest", "errors", "rep", "fp", "label"]
_OPEN_SCHEMA = "node string, side int, rest bigint, errors int, rep bigint, fp binary, label bigint"


def _similar(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether the Jaccard similarity of two sets is at least ``similarity``."""
    if min(len(x), len(y)) < similarity * max(len(x), len(y)) - 1e-9:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= similarity * (len(x) + len(y) - both) - 1e-9


class _Groups:
    """Whole nodes of one batch; rows are sorted by node, side and rest. ``first`` has the first row of each key."""

    def __init__(self, rows: pd.DataFrame, bits: int, budget: int):
        rest, node, side = rows["rest"].to_numpy().view(np.uint64), rows["node"].to_numpy(), rows["side"].to_numpy()
        new_node = np.concatenate([[True], node[1:] != node[:-1]])
        new_side = new_node | np.concatenate([[True], side[1:] != side[:-1]])
        self.rows, self.rep, self.node = rows, rows["rep"].to_numpy(), node
        self.first = first = np.flatnonzero(new_side | np.concatenate([[True], rest[1:] != rest[:-1]]))
        self.number = np.cumsum(new_node) - 1  # of each row's node
        keys, errors = rest[first], rows["errors"].to_numpy().astype(np.int64)[first]
        opens = np.flatnonzero(new_side[first])  # of each side, in keys
        closes = np.append(opens[1:], len(first))
        whose, which = side[first[opens]], self.number[first[opens]]
        alone = np.flatnonzero(whose == 0)
        left = np.flatnonzero((whose[:-1] == 1) & (which[:-1] == which[1:]))
        one, two = np.concatenate([alone, left]), np.concatenate([alone, left + 1])
        ok = (one != two) | (closes[one] - opens[one] > 1)
        one, two = one[ok], two[ok]
        found = list(walk(keys, (opens[one], closes[one], opens[two], closes[two], errors[opens[one]]), bits, budget))
        #: Pairs of keys within the budget.
        self.a, self.b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))

    def forest(self) -> pd.DataFrame:
        """Spanning links of each node's classes."""
        first = self.first
        label = forest(len(self.rep), first[self.a], first[self.b])
        ids, at = np.unique(self.rep, return_inverse=True)  # a class is in many groups
        label = forest(len(ids), at, at[label])
        moved = label != np.arange(len(ids))
        return pd.DataFrame({"src": ids[moved], "dst": ids[label[moved]]})

    def _products(self, a: np.ndarray, b: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row pairs of all rows of the groups a with all of b; groups begin at ``first``."""
        u = T.ranges(first[a], sizes[a])
        k = np.repeat(np.arange(len(a)), sizes[a])
        return np.repeat(u, sizes[b[k]]), T.ranges(first[b[k]], sizes[b[k]])

    def pairs(self) -> pd.DataFrame:
        """Candidate pairs (src, dst) of classes: all of a node, or with the node's name a spanning tree of them, where that is fewer.

        In a tree each row is tied to the least of its candidates, and one that is
        the least itself to the least of all that candidates join.
        """
        rep, first, own = self.rep, self.first, np.arange(len(self.first))
        sizes = np.diff(np.append(first, len(rep)))
        a, b = (np.concatenate([x, own]) for x in (self.a, self.b))
        made = np.where(a == b, sizes[a] * (sizes[a] - 1) // 2, sizes[a] * sizes[b])
        where = self.number[first[a]]
        many = np.bincount(where, made, self.number[-1] + 1) > np.bincount(self.number)
        few = ~many[where] & (made > 0)
        x, y = (rep[i] for i in self._products(a[few], b[few], first, sizes))
        pair = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1)[x != y], axis=0)
        least = np.minimum.reduceat(rep, first)
        nearest, joined = least.copy(), least.copy()
        np.minimum.at(nearest, self.a, least[self.b])
        np.minimum.at(nearest, self.b, least[self.a])
        label = forest(len(first), self.a, self.b)
        np.minimum.at(joined, label, least)
        key = np.repeat(own, sizes)
        to = np.where(nearest[key] == rep, joined[label[key]], nearest[key])
        tied = many[self.number] & (to != rep)
        one = pd.DataFrame({"src": pair[:, 0], "dst": pair[:, 1], "node": None})
        return pd.concat([one, pd.DataFrame({"src": to[tied], "dst": rep[tied], "node": self.node[tied]})])

    def _apart(self, label: np.ndarray, groups: Callable[[np.ndarray], np.ndarray], far: int, budget: int, lane_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks (u, v, bits) of rows of candidates within ``far`` bits that ``groups`` of their labels leave apart, at the first lane of each pair."""
        key = np.repeat(np.arange(len(self.first)), np.diff(np.append(self.first, len(self.rep))))
        order = np.lexsort((label, key))  # keys are in order already
        key, sorted_label = key[order], label[order]
        wide = np.frombuffer(b"".join(self.rows["fp"].to_numpy()), np.uint8).reshape(len(order), -1)
        lane = np.array([int(x.split(".", 1)[0]) for x in self.node], np.int64)
        starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (sorted_label[1:] != sorted_label[:-1])]))
        sizes = np.diff(np.append(starts, len(order)))
        subs = np.searchsorted(key[starts], np.arange(len(self.first)))  # the first part of one label of each key
        n_subs = np.diff(np.append(subs, len(starts)))
        of = sorted_label[starts]
        one, two = self._products(np.concatenate([self.a, np.arange(len(subs))]), np.concatenate([self.b, np.arange(len(subs))]), subs, n_subs)
        apart = (of[one] != of[two]) & ((key[starts[one]] != key[starts[two]]) | (one < two))
        one, two = one[apart], two[apart]
        step = max(1, _CHUNK // int(sizes.max(initial=1)))
        for i in range(0, len(one), step):
            a, b = one[i : i + step], two[i : i + step]
            open_ = groups(of[a]) != groups(of[b])  # not linked meanwhile
            for u, v in self._blocks_of(a[open_], b[open_], starts, sizes):
                u, v = order[u], order[v]
                bits = np.bitwise_count(wide[u].view(np.uint64) ^ wide[v].view(np.uint64)).sum(axis=1)
                u, v, bits = (x[bits <= far] for x in (u, v, bits))
                # a pair meets in several lanes: where it isn't met in its first one, the group there has it in one component or tried
                lanes = np.bitwise_count(wide[u] ^ wide[v]).reshape(len(u), wide.shape[1] * 8 // lane_bits, lane_bits // 8).sum(axis=2, dtype=np.uint16) <= budget
                here = lanes.argmax(axis=1) == lane[u]
                yield u[here], v[here], bits[here]

    def crossing(self, sure: int, far: int, budget: int, lane_bits: int, similarity: float | None = None) -> pd.DataFrame:
        """Spanning links (src, dst) between candidates of different labels, and rows that have further ones to be decided by their shingle sets.

        Candidates within ``sure`` bits are links. Those within ``far`` that these leave
        apart are decided by ``similarity`` where the rows have shingles; else their rows
        are handed on as they are, with src and dst null, to come again with shingles.
        """
        number, label = np.unique(self.rows["label"].to_numpy(), return_inverse=True)
        groups = np.arange(len(number))
        links: list[tuple[int, int]] = []

        def link(u: int, v: int) -> None:
            one, two = sorted((groups[label[u]], groups[label[v]]))
            if one != two:
                groups[groups == two] = one
                links.append((int(self.rep[u]), int(self.rep[v])))

        for u, v, _ in self._apart(label, lambda x: groups[x], sure, budget, lane_bits):
            _, at = np.unique(np.stack([groups[label[u]], groups[label[v]]]), axis=1, return_index=True)
            for i in at.tolist():
                link(u[i], v[i])
        again = np.zeros(len(self.rep), bool)
        if far > sure:
            sets = None if similarity is None else self.rows["shingles"].to_numpy()
            for u, v, _ in self._apart(label, lambda x: groups[x], far, budget, lane_bits):
                if sets is None:
                    again[u] = again[v] = True
                    continue
                for x, y in zip(u.tolist(), v.tolist(), strict=True):
                    if groups[label[x]] != groups[label[y]] and _similar(sets[x], sets[y], similarity):
                        link(x, y)
        columns, whole = ["src", "dst", *_OPEN], dict.fromkeys(["src", "dst", "side", "rest", "errors", "rep", "label"], "Int64") | {"node": object, "fp": object}
        made = [pd.DataFrame(links, columns=["src", "dst"]), self.rows[again]]
        return pd.concat([x.reindex(columns=columns).astype(whole) for x in made if len(x)] or [pd.DataFrame(columns=columns).astype(whole)])

    def _blocks_of(self, a: np.ndarray, b: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row pairs of the parts a and b, about 32,000 at a time."""
        u, k = T.ranges(starts[a], sizes[a]), np.repeat(np.arange(len(a)), sizes[a])
        each = sizes[b[k]]
        total = np.cumsum(each)
        low = 0
        while low < len(u):
            high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + (1 << 15), "right")))
            yield np.repeat(u[low:high], each[low:high]), T.ranges(starts[b[k[low:high]]], each[low:high])
            low = high


def _linker(bits: int, budget: int, limit: int, of):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """``of`` of about ``limit`` rows at a time. Batches hold sorted rows; a group goes on over batch ends."""
        held: list[pd.DataFrame] = []
        n = 0
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            n += len(batch)
            if n < limit:
                continue
            whole = pd.concat(held, ignore_index=True)
            node = whole["node"].to_numpy()
            cut = int(np.flatnonzero(node != node[-1])[-1]) + 1 if (node != node[-1]).any() else 0
            if cut:
                yield of(_Groups(whole.iloc[:cut], bits, budget))
            held, n = [whole.iloc[cut:]], len(whole) - cut
        if n:
            yield of(_Groups(pd.concat(held, ignore_index=True), bits, budget))

    return rows


def _distances(far: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of (src, dst, a, b), the pairs whose fingerprints a and b are within ``far``, with their differing bits."""
        for batch in batches:
            if batch.num_rows:
                one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for i in (2, 3))
                bits = np.bitwise_count(one ^ two).sum(axis=1).astype(np.int64)
                near = pa.array(bits <= far)
                yield pa.RecordBatch.from_arrays([x.filter(near) for x in (batch.column(0), batch.column(1), pa.array(bits))], names=["src", "dst", "bits"])

    return rows


def _part(column, shift: int, width: int):
    return F.shiftrightunsigned(column, shift).bitwiseAND(F.lit((1 << width) - 1))


def _lane(lane: int, bits: int):
    """Bits [lane * bits, lane * bits + bits) of the binary fp as a bigint."""
    return F.conv(F.hex(F.substring("fp", lane * bits // 8 + 1, bits // 8)), 16, -10).cast("bigint")


def _rotated(classes: DataFrame, width: int, bits: int, budget: int, parts: int) -> tuple[DataFrame, int]:
    """Each class once for each lane and choice of blocks without an error: node (lane, choice and those blocks), rest (the other bits)."""
    blocks = _blocks(bits, parts)
    choices = list(combinations(range(parts), parts - budget))
    rests = [bits - sum(blocks[i][1] for i in c) for c in choices]

    def packed(which):
        total = F.lit(0).cast("bigint")
        for i in which:
            total = F.shiftleft(total, blocks[i][1]).bitwiseOR(_part(F.col("key"), *blocks[i]))
        return total

    keyed = classes.select("rep", F.array(*(_lane(lane, bits) for lane in range(width // bits))).alias("keys"))
    exploded = keyed.select("rep", F.posexplode("keys").alias("lane", "key"))
    structs = [
        F.struct(
            F.concat_ws(".", F.col("lane"), F.lit(n), packed(choice)).alias("node"),
            packed([i for i in range(parts) if i not in choice]).alias("rest"),
            F.lit(rests[n]).alias("bits"),
        )
        for n, choice in enumerate(choices)
    ]
    rows = exploded.select("rep", F.explode(F.array(*structs)).alias("x")).select("rep", "x.*")
    return rows.withColumns({"side": F.lit(0), "errors": F.lit(0)}), max(rests)


def _deeper(rows: DataFrame, step: int, budget: int) -> DataFrame:
    """Replaces node pairs by the pairs of their descendants ``step`` bits further down, or at the leaves."""
    down = f"least({step}, bits)"
    below = F.expr(f"CAST(shiftrightunsigned(rest, bits - {down}) & (shiftleft(1L, {down}) - 1) AS INT)")
    # of a pair, side 1 names its child first; of a node with itself, the lesser child comes first
    near = F.expr(f"filter(sequence(0, shiftleft(1, {down}) - 1), o -> errors + bit_count(o ^ child) <= {budget})")
    out = rows.withColumn("child", below).withColumn("other", F.explode(near))
    first = F.expr("CASE WHEN side = 0 THEN least(child, other) WHEN side = 1 THEN child ELSE other END")
    second = F.expr("CASE WHEN side = 0 THEN greatest(child, other) WHEN side = 1 THEN other ELSE child END")
    side = F.expr("CASE WHEN side <> 0 THEN side WHEN child = other THEN 0 WHEN child < other THEN 1 ELSE 2 END")
    return out.select(
        "rep",
        F.concat_ws(".", "node", first, second).alias("node"),
        F.expr(f"rest & (shiftleft(1L, bits - {down}) - 1)").alias("rest"),
        F.expr(f"bits - {down}").alias("bits"),
        side.alias("side"),
        F.expr("errors + bit_count(child ^ other)").alias("errors"),
    )


def _stars(leaves: DataFrame) -> DataFrame:
    """Each row of a node of equal keys, tied to the node's least class."""
    least = leaves.groupBy("node").agg(F.min("rep").alias("src"))
    return leaves.join(least, "node").where("rep <> src").select("src", F.col("rep").alias("dst"), "node")


def _squared(leaves: DataFrame, limit: int) -> DataFrame:
    """Nodes of equal keys cut into parts of about ``limit`` rows, as a node for each two parts: any two rows of a node meet."""
    n = leaves.groupBy("node").agg(F.ceil(F.count("*") / limit).cast("int").alias("parts"))
    cut = leaves.join(n, "node").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    return cut.withColumn("node", F.concat_ws("/", "node", F.least("part", "other"), F.greatest("part", "other"))).drop("parts", "part", "other")


def links(
    classes: DataFrame,
    width: int = 64,
    budget: int = 2,
    lane_bits: int = 64,
    lane_budget: int | None = None,
    parts: int | None = None,
    group_limit: int = GROUP_LIMIT,
    step: int = 8,
    sure: int | None = None,
    confirm: _Jaccard | None = None,
) -> DataFrame:
    """(src, dst) links that join the classes (rep bigint, fp binary, distinct) as all pairs within the budget would.

    With lanes shorter than the fingerprint a pair is a candidate if any lane has
    at most ``lane_budget`` differing bits, and linked if the whole fingerprint
    has at most ``budget``; with one lane that is the lane's own budget and the
    result is exact. ``confirm`` decides candidates (src, dst) of more than ``sure`` bits.
    """
    whole = lane_bits == width
    lane_budget = budget if whole else (lane_budget if lane_budget is not None else 2)
    rows, bits = _rotated(classes, width, lane_bits, lane_budget, parts or lane_budget + 2)
    cold: list[DataFrame] = []
    leaves: list[DataFrame] = []
    while True:
        large = rows.groupBy("node").agg(F.count("*").alias("n"), F.max("bits").alias("left")).where(F.col("n") > group_limit)
        if large.isEmpty():
            break
        large = written(large)
        cold.append(rows.join(large, "node", "left_anti"))
        leaves.append(rows.join(large.where("left = 0"), "node", "left_semi"))
        rows = written(_deeper(rows.join(large.where("left > 0"), "node", "left_semi"), step, lane_budget))
    cold.append(rows)

    def aligned(rows: DataFrame) -> DataFrame:
        return rows.withColumn("rest", F.expr(f"shiftleft(rest, {bits} - bits)"))

    n = shuffle_partitions(classes.sparkSession)

    def grouped(rows: DataFrame, columns: list[str], of, schema: str, limit: int = group_limit) -> DataFrame:
        found = rows.select("node", "side", "rest", "errors", *columns)
        return found.repartition(n, "node").sortWithinPartitions("node", "side", "rest").mapInPandas(_linker(bits, lane_budget, limit, of), schema)

    if whole:
        # of equal keys there is one class each: a leaf pair is a link by itself
        return reduce(DataFrame.unionByName, [grouped(aligned(x), ["rep"], _Groups.forest, "src bigint, dst bigint") for x in [*cold, *leaves]])
    tried = [grouped(aligned(x), ["rep"], _Groups.pairs, "src bigint, dst bigint, node string") for x in cold]
    tried = written(reduce(DataFrame.unionByName, [*tried, *map(_stars, leaves)]))
    one, two = (classes.select(F.col("rep").alias(i), F.col("fp").alias(c)) for i, c in (("src", "a"), ("dst", "b")))
    pairs = tried.select("src", "dst").distinct().join(one, "src").join(two, "dst").select("src", "dst", "a", "b")
    sure = budget if sure is None else sure

    def decided(near: DataFrame) -> DataFrame:
        if confirm is None:
            return near.select("src", "dst")
        near = written(near)
        return near.where(F.col("bits") <= sure).select("src", "dst").unionByName(confirm(near.where(F.col("bits") > sure).select("src", "dst")))

    first = written(decided(pairs.mapInArrow(_distances(budget), "src bigint, dst bigint, bits bigint")))
    trees = tried.where("node is not null")
    label = components(first)
    apart = trees.select("src", "dst").distinct().join(first, ["src", "dst"], "left_anti")
    for side in ("src", "dst"):
        known = label.select(F.col("id").alias(side), F.col("component").alias(f"{side}_in"))
        apart = apart.join(known, side, "left").withColumn(f"{side}_in", F.coalesce(f"{side}_in", side))
    again = written(trees.join(apart.where("src_in <> dst_in"), ["src", "dst"], "left_semi").select("node").distinct())
    if again.isEmpty():
        return first
    known = classes.join(label, F.col("rep") == F.col("id"), "left").select("rep", "fp", F.coalesce("component", "rep").alias("label"))
    open_rows = [x.join(again, "node", "left_semi") for x in cold] + [_squared(x.join(again, "node", "left_semi"), group_limit) for x in leaves]
    schema, few = f"src bigint, dst bigint, {_OPEN_SCHEMA}", min(group_limit, SET_ROWS)
    crossing = [grouped(aligned(x).join(known, "rep"), ["rep", "fp", "label"], lambda g: g.crossing(sure, budget, lane_budget, lane_bits), schema, few) for x in open_rows]
    crossing = written(reduce(DataFrame.unionByName, crossing))
    more = crossing.where("src is not null").select("src", "dst")
    if confirm is None:
        return first.unionByName(more)
    undecided = crossing.where("src is null").select(*_OPEN)
    held = undecided.join(confirm.sets(undecided.select("rep").distinct()), "rep")
    similarity = confirm.similarity
    last = grouped(held, ["rep", "fp", "label", "shingles"], lambda g: g.crossing(sure, budget, lane_budget, lane_bits, similarity), schema, few)
    return first.unionByName(more).unionByName(last.select("src", "dst"))


def _sets(shingle: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of (rep, sid, text), the shingle sets of the texts that sid names."""
        for batch in batches:
            keep, out = [], []
            for i, hashes in enumerate(_hashed_texts(batch.column(2), shingle, True)):
                if _named(hashes) == batch.column(1)[i].as_py():
                    keep.append(i)
                    out.append(hashes.view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(out, pa.list_(pa.int64()))], names=["rep", "shingles"])

    return rows


def _alike(similarity: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of blocks of sets (kind 0: a, shingles) and pairs (kind 1: a, b), the pairs whose sets are alike."""
        for table in whole_groups(batches, ["block"], rows=1):
            table = table.combine_chunks()
            block, kind = (table[c].to_numpy() for c in ("block", "kind"))
            flat = table["shingles"].combine_chunks()
            values, bounds = flat.values.to_numpy(), flat.offsets.to_numpy()
            one, two = table["a"].to_numpy(), table["b"].fill_null(0).to_numpy()
            kept: list[tuple[int, int]] = []
            sets: dict[int, np.ndarray] = {}
            now = None
            for i in range(len(block)):
                if block[i] != now:
                    now, sets = block[i], {}
                if kind[i] == 0:
                    sets[one[i]] = values[bounds[i] : bounds[i + 1]]
                    continue
                x, y = sets.get(one[i]), sets.get(two[i])
                if x is not None and y is not None and _similar(x, y, similarity):
                    kept.append((int(one[i]), int(two[i])))
            yield pa.RecordBatch.from_arrays([pa.array([k[j] for k in kept], pa.int64()) for j in (0, 1)], names=["src", "dst"])

    return rows


def _possible(rows: DataFrame, keys: DataFrame, key: str, n_keys: int) -> DataFrame:
    """``rows`` without most of those whose key isn't among ``keys``, by a Bloom filter, so that few of them are shuffled to a join."""
    blocks = seen.blocks_for(n_keys)
    if blocks > seen.MOST_BLOCKS:
        return rows
    return seen.marked(rows, seen.seen_filter(keys, key, blocks), key, blocks).where("possible").select(*rows.columns)


class _Jaccard:
    """Keeps the pairs of classes whose shingle sets have a Jaccard similarity of ``similarity`` or more.

    Classes are dealt to blocks of about BLOCK_SETS, and pairs to pairs of blocks:
    a class that a third of all pairs have goes once to each block it meets, and a
    task holds the sets of two blocks.
    """

    def __init__(self, classes: DataFrame, texts: DataFrame, shingle: int, similarity: float):
        self.classes, self.texts, self.shingle, self.similarity = classes, texts, shingle, similarity

    def _wanted(self, reps: DataFrame) -> DataFrame:
        return written(self.classes.join(reps, "rep", "left_semi").select("rep", "sid"))

    def _sets(self, wanted: DataFrame, n: int) -> DataFrame:
        texts = _possible(self.texts, wanted.select(F.col("rep").alias("id")), "id", n)
        found = texts.join(wanted, F.col("id") == F.col("rep")).select("rep", "sid", "text").mapInArrow(_sets(self.shingle), "rep bigint, shingles array<bigint>")
        return found.dropDuplicates(["rep"])

    def sets(self, reps: DataFrame) -> DataFrame:
        """(rep, shingles) of the classes ``reps``."""
        wanted = self._wanted(reps)
        return self._sets(wanted, wanted.count())

    def __call__(self, pairs: DataFrame) -> DataFrame:
        pairs = written(pairs.distinct())
        wanted = self._wanted(pairs.select(F.col("src").alias("rep")).unionByName(pairs.select(F.col("dst").alias("rep"))).distinct())
        count = wanted.count()
        blocks = -(-count // BLOCK_SETS) or 1
        one, two = (F.pmod(F.xxhash64(c), F.lit(blocks)) for c in ("src", "dst"))
        keyed = pairs.withColumn("block", F.least(one, two) * blocks + F.greatest(one, two))  # whichever of a pair comes first
        needed = keyed.select("block", F.col("src").alias("rep")).unionByName(keyed.select("block", F.col("dst").alias("rep"))).distinct()
        sets = needed.join(self._sets(wanted, count), "rep").select("block", F.lit(0).alias("kind"), F.col("rep").alias("a"), F.lit(None).cast("bigint").alias("b"), "shingles")
        rows = sets.unionByName(keyed.select("block", F.lit(1).alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), F.lit(None).cast("array<bigint>").alias("shingles")))
        n = shuffle_partitions(pairs.sparkSession)
        return rows.repartition(n, "block").sortWithinPartitions("block", "kind").mapInArrow(_alike(self.similarity), "src bigint, dst bigint")


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    width: int = 64,
    budget: int = 2,
    lane_bits: int | None = None,
    lane_budget: int = 2,
    parts: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_limit: int = GROUP_LIMIT,
    similarity: float | None = None,
) -> DataFrame:
    """(id, fp, component_id): each row's fingerprint and the least id that links of at most ``budget`` differing bits reach.

    With ``similarity``, fingerprints are of distinct shingles, and it is the Jaccard
    similarity of the shingle sets that links: fingerprints decide alone where they
    are more than MARGIN standard deviations from what that similarity has.

    Rows that share an id are one document and repeat in the result. A row of a
    null id has a fingerprint and no component, and links nothing. A null or
    empty text has no words and the fingerprint zero, linked like any other.
    """
    exact = similarity is not None
    found = written(fingerprints(docs, shingle, width, id_col, text_col, exact))
    named = found.where("id is not null")
    if exact:
        least = named.groupBy("fp").agg(F.min(F.struct("id", "sid")).alias("x"))
        classes = written(least.select("fp", F.col("x.id").alias("rep"), F.col("x.sid").alias("sid")))
        texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
        sure, far = similarity_bits(similarity, width)
        edges = links(classes.select("rep", "fp"), width, far, lane_bits or width, lane_budget, parts, group_limit, sure=sure, confirm=_Jaccard(classes, texts, shingle, similarity))
    else:
        classes = written(named.groupBy("fp").agg(F.min("id").alias("rep")))
        edges = links(classes, width, budget, lane_bits or width, lane_budget, parts, group_limit)
    # an id with several texts joins their classes
    repeats = named.groupBy("id").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a <> b").select("id")
    same = named.join(repeats, "id").join(classes, "fp").select(F.col("id").alias("src"), F.col("rep").alias("dst"))
    reached = components(edges.unionByName(same))
    roots = classes.join(reached, F.col("rep") == F.col("id"), "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return found.join(roots, "fp", "left").select("id", "fp", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


#: Standard deviations around the expected distance within which shingle sets are compared themselves.
MARGIN = 3.0


def similarity_bits(similarity: float, width: int, margin: float = MARGIN) -> tuple[int, int]:
    """Differing bits of ``width`` up to which, and beyond which, shingle sets are above or below that Jaccard similarity.

    Jaccard j of sets of about equal size is a cosine of 2j / (1 + j); the
    expected share of differing bits is the angle over pi, with ``margin``
    standard deviations to either side.
    """
    share = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    middle, spread = width * share, margin * np.sqrt(width * share * (1 - share))
    return max(int(middle - spread), 0), int(middle + spread)


#: Parameters of near-duplicates at a similarity of 0.8 on shingles of five words: 24 tries of 32 bits.
SIMILAR = {"shingle": 5, "width": 768, "lane_bits": 32, "lane_budget": 2, "parts": 3}


def keep_one(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, the one with the least doc_id; rows of a null doc_id stay.

    Two texts are near-duplicates if their sets of five-word shingles have a Jaccard
    similarity of at least ``similarity``. Rows are told apart by id and text, so
    that unlike texts that share an id stay each; rows of one id and text are
    repeats, of which one stays.
    """
    key = unused(docs, "row_key")
    keyed = docs.where("doc_id is not null").withColumn(key, row_key())
    near = near_duplicates(keyed, id_col=key, similarity=similarity, **SIMILAR)
    named = keyed.groupBy(key).agg(F.min("doc_id").alias("place"), F.count("*").alias("n"))
    members = near.select(F.col("id").alias(key), "component_id").distinct().join(named, key)
    firsts = members.groupBy("component_id").agg(F.min(F.struct("place", key)).alias("x"), F.sum("n").alias("rows")).where("rows > 1")
    firsts = firsts.select("component_id", F.col(f"x.{key}").alias("first"))
    # keys of rows that go, and of rows that repeat and stay once
    marked = members.join(firsts, "component_id").where((F.col(key) != F.col("first")) | (F.col("n") > 1)).select(key, (F.col(key) == F.col("first")).alias("again"))
    marked = written(marked)
    return _without(docs, key, marked).unionByName(docs.where("doc_id is null"))


def _without(docs: DataFrame, key: str, marked: DataFrame) -> DataFrame:
    """Rows of a doc_id without those whose key is ``marked``, one row a key where ``again``. Texts are shuffled for marked rows and a few others only."""
    rows = docs.where("doc_id is not null").select(F.struct("*").alias("row"), row_key().alias(key))
    blocks = seen.blocks_for(marked.count())
    clear, doubtful = None, rows
    if blocks <= seen.MOST_BLOCKS:
        met = seen.marked(rows, seen.seen_filter(marked, key, blocks), key, blocks)
        clear, doubtful = met.where("not possible").drop("possible"), met.where("possible").drop("possible")
    doubtful = doubtful.join(marked, key, "left")
    kept = [doubtful.where("again is null").select("row", key), doubtful.where("again").dropDuplicates([key]).select("row", key)]
    return reduce(DataFrame.unionByName, [*([clear] if clear is not None else []), *kept]).select("row.*")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select(F.col("id").alias("doc_id"), F.lower(F.hex("fp")).alias("fingerprint"), "component_id")
