"""Token counts that follow edits, by a segment tree of pre-tokens for every document.

Pre-tokens are the matches of the vocabulary's pattern; merges never cross them, so the tokens of a
text are the sum over its pre-tokens. `LEAF` pre-tokens make a leaf, and a binary tree over the leaves
holds sums of characters and tokens. An edit descends the tree to the leaves it touches, goes back to
a place that no look-ahead can reach across, and encodes from there until a new pre-token ends where an
old leaf ends: from that point on everything is as before. The new pre-tokens fill the same leaves, and
only the sums above them are updated.

The vocabulary (ranks of byte strings) is read by the driver and broadcast. Null is the empty text
with no tokens. Edits are (start, length, replacement) in code points, applied in order; a null list, a
null replacement, and parts beyond the end of the text count as empty. Rows are handled one by one;
columns other than the named ones are dropped.
"""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF = 64
#: Pre-tokens that a task remembers; beyond, it begins anew. This changes no result.
KEPT = 1 << 18

_TREES = "doc_id bigint, text string, edits array<struct<start:int,length:int,replacement:string>>, chars array<int>, tokens array<int>"


class Counter:
    """Pre-tokens of a text and the number of tokens of each."""

    def __init__(self, content: bytes, pattern: str):
        import regex
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.cut = regex.compile(pattern).findall
        self.known: dict[str, int] = {}

    def count(self, pre_tokens: list[str]) -> np.ndarray:
        known = self.known
        new = set(pre_tokens).difference(known)
        if new:
            if len(known) > KEPT:
                known.clear()
                new = set(pre_tokens)
            for word in new:
                known[word] = len(self.encoding.encode_ordinary(word))
        return np.fromiter((known[t] for t in pre_tokens), np.int64, len(pre_tokens))


class Tree:
    """Sums of characters and tokens; node i has the children 2i and 2i + 1, node 1 is the root."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.sums = np.stack([chars, tokens], axis=1).astype(np.int64)
        self.leaves = len(self.sums) // 2

    @classmethod
    def over(cls, lengths: np.ndarray, tokens: np.ndarray) -> Tree:
        used = max(1, -(-len(lengths) // LEAF))
        size = 1 << (used - 1).bit_length()
        sums = np.zeros((2 * size, 2), np.int64)
        if len(lengths):
            firsts = np.arange(0, len(lengths), LEAF)
            sums[size : size + used, 0] = np.add.reduceat(lengths, firsts)
            sums[size : size + used, 1] = np.add.reduceat(tokens, firsts)
        while size > 1:
            sums[size // 2 : size] = sums[size : 2 * size : 2] + sums[size + 1 : 2 * size : 2]
            size //= 2
        return cls(sums[:, 0], sums[:, 1])

    def find(self, at: int) -> tuple[int, int]:
        """(leaf, its first character) of the character `at`; the last filled leaf beyond the end."""
        node, first = 1, 0
        at = min(at, int(self.sums[1, 0]) - 1)
        while node < self.leaves:
            node *= 2
            if at - first >= self.sums[node, 0]:
                first += int(self.sums[node, 0])
                node += 1
        return node - self.leaves, first

    def refill(self, low: int, high: int, lengths: np.ndarray, tokens: np.ndarray) -> None:
        """Spread new pre-tokens over the leaves low .. high - 1 and update the sums above."""
        edges = np.linspace(0, len(lengths), high - low + 1).astype(np.int64)
        both = np.concatenate([[[0, 0]], np.cumsum(np.stack([lengths, tokens], axis=1), axis=0)])
        self.sums[self.leaves + low : self.leaves + high] = np.diff(both[edges], axis=0)
        first, last = self.leaves + low, self.leaves + high - 1
        while first > 1:
            first, last = first // 2, last // 2
            for node in range(first, last + 1):
                self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]


def edit(tree: Tree, text: str, start: int, length: int, replacement: str, counter: Counter) -> tuple[str, int]:
    """Apply one edit to the text and its tree; the new text, and how many characters were encoded."""
    start = min(max(start, 0), len(text))
    end = min(start + max(length, 0), len(text))
    new = text[:start] + replacement + text[end:]
    shift = len(new) - len(text)
    leaf, first = tree.find(max(0, start - 2)) if text else (0, 0)  # a contraction may begin two characters before
    while first > 0 and text[first - 1].isspace():  # a run of spaces looks ahead; start before it
        leaf -= 1
        first -= int(tree.sums[tree.leaves + leaf, 0])
    stop, read = tree.find(end)[0] if text else 0, 1
    while True:
        high = min(stop + read, tree.leaves)
        ends = first + np.cumsum(tree.sums[tree.leaves + leaf : tree.leaves + high, 0])  # of the old leaves
        whole = int(ends[-1]) >= len(text)
        region = new[first : len(new) if whole else int(ends[-1]) + shift]
        found = counter.cut(region)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        if whole:
            high = tree.leaves
            break
        borders = first + np.cumsum(lengths)[:-2]  # the last ones may go on beyond the region
        meeting = np.flatnonzero((ends > end) & np.isin(ends + shift, borders))
        if len(meeting):
            high = leaf + int(meeting[0]) + 1
            kept = int(np.searchsorted(first + np.cumsum(lengths), ends[meeting[0]] + shift)) + 1
            found, lengths = found[:kept], lengths[:kept]
            break
        read *= 2
    tree.refill(leaf, high, lengths, counter.count(found))
    return new, int(lengths.sum())


def _build(content, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(content.value, pattern)
        for batch in batches:
            chars, tokens = [], []
            for text in batch.column(1).to_pylist():
                found = counter.cut(text or "")
                tree = Tree.over(np.fromiter(map(len, found), np.int64, len(found)), counter.count(found))
                chars.append(tree.sums[:, 0].astype(np.int32))
                tokens.append(tree.sums[:, 1].astype(np.int32))
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(chars, kind), pa.array(tokens, kind)],
                names=["doc_id", "text", "edits", "chars", "tokens"],
            )

    return run


_COUNTS = "doc_id bigint, n_tokens bigint, edited_tokens bigint, edited_chars bigint, encoded_chars bigint, edited_text string, chars array<int>, tokens array<int>"


def _recount(content, pattern: str, wanted: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(content.value, pattern)
        for batch in batches:
            rows = []
            for text, edits, chars, tokens in zip(*(batch.column(i).to_pylist() for i in range(1, 5)), strict=True):
                tree, text, work = Tree(np.array(chars), np.array(tokens)), text or "", 0
                before = int(tree.sums[1, 1])
                for e in edits or ():
                    text, more = edit(tree, text, e["start"] or 0, e["length"] or 0, e["replacement"] or "", counter)
                    work += more
                rows.append((before, int(tree.sums[1, 1]), len(text), work, text, tree.sums[:, 0].astype(np.int32), tree.sums[:, 1].astype(np.int32)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] + [pa.list_(pa.int32())] * 2
            names = ["n_tokens", "edited_tokens", "edited_chars", "encoded_chars", "edited_text", "chars", "tokens"]
            made = {"doc_id": batch.column(0)}
            made |= {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True) if n in wanted}
            yield pa.RecordBatch.from_arrays([made[n] for n in wanted], names=wanted)

    return run


def _content(spark, path: str):
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def build_trees(docs: DataFrame, path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """doc_id, text, edits (as given, or null), and the tree's sums of characters and of tokens."""
    kind = "array<struct<start:int,length:int,replacement:string>>"
    edits = F.col("edits").cast(kind) if "edits" in docs.columns else F.lit(None).cast(kind)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), edits.alias("edits"))
    return rows.mapInArrow(_build(_content(docs.sparkSession, path), pattern), _TREES)


def recount(trees: DataFrame, path: str = VOCABULARY, pattern: str = PATTERN, columns: tuple[str, ...] = ()) -> DataFrame:
    """Apply each row's edits to its tree. Columns: those of `_COUNTS`, all unless some are named."""
    kinds = dict(c.split(" ") for c in _COUNTS.split(", "))
    wanted = list(columns or kinds)
    rows = trees.select("doc_id", "text", "edits", "chars", "tokens")
    return rows.mapInArrow(_recount(_content(trees.sparkSession, path), pattern, wanted), ", ".join(f"{c} {kinds[c]}" for c in wanted))
