"""Edit-aware token counts: a segment tree of pre-token runs per document.

A text is cut where the pre-tokeniser always cuts: before a single blank or line
feed between two characters that are no white space. Runs of at least
``RUN_CHARS`` characters between such cuts are the leaves of a tree whose nodes
hold the sums of characters and tokens below. An edit descends to the leaves it
touches, widens them by neighbours until both borders are such cuts again,
encodes that region alone, and updates the sums above. The count of the edited
text equals that of encoding it whole.

Each row is handled by itself (no shuffle): trees are made in the task that
reads the text, and kept as columns of a table beside it (``trees``), from which
later edits start.

A null text counts as empty: no token. An edit is (pos, del, ins): at code point
``pos`` (held within 0 and the length), ``del`` code points go and ``ins``
enters; edits of a row apply in order, null edits and null fields are no change.
A text without white space is one run, however long.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import written

#: Vocabulary file of ranks, read by the driver and broadcast (a file's fixed size, under a megabyte); a parameter of all functions.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-tokeniser's pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RUN_CHARS = 256
#: A leaf above so many characters is cut again when it is edited.
_MOST = 8 * RUN_CHARS
_CUT = re.compile(r"(?<=\S)[ \n](?=\S)")

EDITS = "array<struct<pos:bigint,del:bigint,ins:string>>"


def read_ranks(path: str = RANKS) -> bytes:
    with open(path, "rb") as file:
        return file.read()


@lru_cache(2)
def encoder(ranks: bytes | None = None, pattern: str = PATTERN) -> tiktoken.Encoding:
    """The encoder of a vocabulary file's content; once in each process."""
    lines = (read_ranks() if ranks is None else ranks).splitlines()
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def _sent(df: DataFrame, ranks: str) -> Broadcast:
    return df.sparkSession.sparkContext.broadcast(read_ranks(ranks))


def runs(text: str, least: int = RUN_CHARS) -> list[str]:
    """Pieces of at least ``least`` characters, but for the last, between cuts of the pre-tokeniser."""
    out, at = [], 0
    while m := _CUT.search(text, at + least):
        out.append(text[at : m.start()])
        at = m.start()
    if at < len(text):
        out.append(text[at:])
    return out


class TokenTree:
    """Leaves of text with sums of characters and tokens above them, in arrays of a heap."""

    def __init__(self, leaves: list[str], counts: list[int], encode: tiktoken.Encoding):
        self.encode, self.leaves, self.encoded = encode, leaves, 0
        self.width = 1 << max(len(leaves) - 1, 0).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        self.chars[self.width : self.width + len(leaves)] = map(len, leaves)
        self.tokens[self.width : self.width + len(leaves)] = counts
        for i in range(self.width - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @classmethod
    def of(cls, text: str, encode: tiktoken.Encoding) -> TokenTree:
        leaves = runs(text)
        return cls(leaves, [len(encode.encode_ordinary(x)) for x in leaves], encode)

    @property
    def count(self) -> int:
        return self.tokens[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(self.leaves)

    def _leaf(self, pos: int) -> tuple[int, int]:
        """The leaf that holds character ``pos`` and the place in it."""
        i = 1
        while i < self.width:
            i *= 2
            if pos >= self.chars[i]:
                pos -= self.chars[i]
                i += 1
        return i - self.width, pos

    def _put(self, i: int, text: str) -> None:
        self.leaves[i] = text
        node = i + self.width
        chars, tokens = len(text) - self.chars[node], (len(self.encode.encode_ordinary(text)) if text else 0) - self.tokens[node]
        while node:
            self.chars[node] += chars
            self.tokens[node] += tokens
            node //= 2

    def _beside(self, i: int, step: int) -> int | None:
        """The next leaf with text to the left or right."""
        i += step
        while 0 <= i < len(self.leaves):
            if self.leaves[i]:
                return i
            i += step
        return None

    def edit(self, pos: int, delete: int, insert: str) -> None:
        pos = min(max(pos, 0), self.length)
        delete = min(max(delete, 0), self.length - pos)
        if not delete and not insert:
            return
        if not self.length:
            self.__dict__.update(TokenTree.of(insert, self.encode).__dict__ | {"encoded": self.encoded + len(insert)})
            return
        first, at = self._leaf(min(pos, self.length - 1))
        at += pos - min(pos, self.length - 1)
        last = first if not delete else self._leaf(pos + delete - 1)[0]
        region = "".join(self.leaves[first : last + 1])
        region = region[:at] + insert + region[at + delete :]
        while (left := self._beside(first, -1)) is not None and not (len(region) > 1 and _CUT.match(self.leaves[left][-1] + region[:2], 1)):
            region, first = self.leaves[left] + region, left
        while (right := self._beside(last, 1)) is not None and not (region and _CUT.match(region[-1] + self.leaves[right][:2], 1)):
            region, last = region + self.leaves[right], right
        self.encoded += len(region)
        if len(region) > _MOST:
            cut = runs(region)
            leaves = self.leaves[:first] + cut + self.leaves[last + 1 :]
            known = self.tokens[self.width : self.width + len(self.leaves)]
            counts = known[:first] + [len(self.encode.encode_ordinary(x)) for x in cut] + known[last + 1 :]
            self.__dict__.update(TokenTree(leaves, counts, self.encode).__dict__ | {"encoded": self.encoded})
            return
        self._put(first, region)
        for i in range(first + 1, last + 1):
            if self.leaves[i]:
                self._put(i, "")


def _edited(ranks: Broadcast, pattern: str, with_trees: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks.value, pattern)
        for batch in batches:
            ids, texts, edits = (batch.column(i) for i in range(3))
            out: list[tuple] = []
            for i, (text, todo) in enumerate(zip(texts, edits, strict=True)):
                text = text.as_py() or ""
                if with_trees and batch.column(3)[i].is_valid:
                    sizes, counts = batch.column(3)[i].as_py(), batch.column(4)[i].as_py()
                    ends = np.cumsum(sizes).tolist()
                    tree = TokenTree([text[e - n : e] for e, n in zip(ends, sizes, strict=True)], counts, encode)
                else:
                    tree = TokenTree.of(text, encode)
                before = (tree.length, tree.count)
                for e in todo.as_py() or []:
                    if e is not None and e["pos"] is not None:
                        tree.edit(e["pos"], e["del"] or 0, e["ins"] or "")
                out.append((*before, tree.length, tree.count, tree.encoded))
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", "n_chars", "n_tokens", "edited_n_chars", "edited_n_tokens", "n_encoded_again"])

    return rows


_COUNTS = "doc_id bigint, n_chars bigint, n_tokens bigint, edited_n_chars bigint, edited_n_tokens bigint, n_encoded_again bigint"


def count_edited(docs: DataFrame, edits: Column, ranks: str = RANKS, pattern: str = PATTERN, id_col: str = "doc_id", text_col: str = "text", kept: tuple[str, str] | None = None) -> DataFrame:
    """Token counts of each row's text before and after its edits.

    ``edits`` is an array of (pos, del, ins) over the columns of ``docs``;
    ``kept`` names the columns of leaf sizes and counts that ``trees`` made, so
    that only the edits' regions are encoded. n_encoded_again is the number of
    characters that the edits had encoded again.
    """
    columns = [F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), edits.cast(EDITS).alias("edits")]
    rows = docs.select(*columns, *(F.col(c).alias(f"kept{i}") for i, c in enumerate(kept or ())))
    return rows.mapInArrow(_edited(_sent(docs, ranks), pattern, kept is not None), _COUNTS)


def _tree_rows(ranks: Broadcast, pattern: str, with_text: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks.value, pattern)
        for batch in batches:
            made = [TokenTree.of(t.as_py() or "", encode) for t in batch.column(1)]
            sizes = [t.chars[t.width : t.width + len(t.leaves)] for t in made]
            counts = [t.tokens[t.width : t.width + len(t.leaves)] for t in made]
            columns = [batch.column(0), pa.array([t.count for t in made], pa.int64()), pa.array(sizes, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32())), *([batch.column(1)] if with_text else [])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "leaf_chars", "leaf_tokens", "text"][: len(columns)])

    return rows


def trees(docs: DataFrame, ranks: str = RANKS, pattern: str = PATTERN, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_tokens and the leaves of each text's tree (characters and tokens of each), to be kept beside the texts, or with them as ``text``."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id bigint, n_tokens bigint, leaf_chars array<int>, leaf_tokens array<int>" + ", text string" * with_text
    return rows.mapInArrow(_tree_rows(_sent(docs, ranks), pattern, with_text), schema)


def sample_edits(text: Column) -> Column:
    """An insertion at a third, a deletion at the middle and a replacement at two thirds of a text."""
    n = F.coalesce(F.length(text), F.lit(0)).cast("bigint")

    def edit(pos: Column, delete: int, insert: str) -> Column:
        return F.struct(F.floor(pos).cast("bigint").alias("pos"), F.lit(delete).cast("bigint").alias("del"), F.lit(insert).alias("ins"))

    return F.array(edit(n / 3, 0, " a new passage, as an editor adds it "), edit(n / 2, 20, ""), edit(n * 2 / 3, 12, "changed"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts all texts and keeps their trees with them; edits then start from the kept trees."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = written(trees(docs, with_text=True))
    return count_edited(kept, sample_edits(F.col("text")), kept=("leaf_chars", "leaf_tokens"))
