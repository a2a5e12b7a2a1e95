"""Byte-pair encoding with word ends, and decoding, on vectors of short words.

A text is cut at white space, each piece once per task into words (contractions, runs of letters,
single digits, runs of the rest). A word is an array of part ids with the ranks of adjacent pairs
beside it. Words of one length are worked on together: find the least rank of each, delete the
boundary there, look up the ranks of the new part with its neighbours, until no pair has a rank.
Words beyond `SHORT` bytes use a heap instead, so that a very long run stays cheap.

The vocabulary file is read by the driver and broadcast. Null is the empty text, which has no tokens.
Decoding joins the tokens by single spaces, as the vocabulary names no decoder. Each row is handled
by itself; columns other than the id and the text play no part.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import words

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOCABULARY = str(public_tokenizers.path("word_bpe_49k.json"))
SHORT = 48
#: Pieces that a task keeps; beyond, it begins anew. This changes no result.
KEPT = 1 << 18
_NO_RANK = np.int64(1 << 40)


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Ids, merges and word pattern of a vocabulary file of kind BPE with a word-end mark."""

    def __init__(self, content: bytes):
        data = json.loads(content)
        model = data["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.tokens = [""] * (max([*vocab.values(), *(t["id"] for t in data["added_tokens"])]) + 1)
        for token, i in vocab.items():
            self.tokens[i] = token
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        for token, i in self.special.items():
            self.tokens[i] = token
        split = next(p for p in data["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = split["pattern"]["Regex"]
        letters = _byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + end] for c in letters], np.int64)
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        keys = np.array([(vocab[a] << 20) | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        if np.any(self.keys[1:] == self.keys[:-1]):
            raise ValueError("a pair has two ranks")

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 20) | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], _NO_RANK)

    def merge_short(self, parts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, ids) of words of one length, as they end; parts is words x bytes."""
        rows = np.arange(len(parts))
        ranks = self.rank(parts[:, :-1], parts[:, 1:])
        while len(rows):
            if parts.shape[1] == 1:
                yield rows, parts
                return
            place = np.argmin(ranks, axis=1)
            least = ranks[np.arange(len(rows)), place]
            ended = least == _NO_RANK
            if ended.any():
                yield rows[ended], parts[ended]
                rows, parts, ranks, place, least = (x[~ended] for x in (rows, parts, ranks, place, least))
                if not len(rows):
                    return
            every = np.arange(len(rows))
            parts[every, place] = self.made[least]
            width = parts.shape[1]
            # the boundary after `place` goes: all that stands right of it moves left by one
            keep = np.arange(width - 1)[None, :]
            parts = np.take_along_axis(parts, keep + (keep > place[:, None]), axis=1)
            if width == 2:
                continue
            keep = np.arange(width - 2)[None, :]
            ranks = np.take_along_axis(ranks, keep + (keep >= place[:, None]), axis=1)
            left, right = place > 0, place < width - 2
            ranks[every[left], place[left] - 1] = self.rank(parts[every[left], place[left] - 1], parts[every[left], place[left]])
            ranks[every[right], place[right]] = self.rank(parts[every[right], place[right]], parts[every[right], place[right] + 1])

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same for one long word, with a heap of (rank, place) and links to the neighbours."""
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.rank(np.array(parts[:-1]), np.array(parts[1:]))
        heap = [(int(r), i) for i, r in enumerate(first) if r != _NO_RANK]
        heapq.heapify(heap)
        current = [int(r) for r in first] + [int(_NO_RANK)]

        def refresh(i: int) -> None:
            j = after[i]
            r = int(self.rank(np.array([parts[i]]), np.array([parts[j]]))[0]) if j < n else int(_NO_RANK)
            current[i] = r
            if r != _NO_RANK:
                heapq.heappush(heap, (r, i))

        while heap:
            r, i = heapq.heappop(heap)
            if current[i] != r:
                continue
            j = after[i]
            parts[i], parts[j], current[j] = int(self.made[r]), -1, int(_NO_RANK)
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            refresh(i)
            if before[i] >= 0:
                refresh(before[i])
        return [p for p in parts if p >= 0]

    def encode_words(self, found: Iterable[bytes]) -> dict[bytes, list[int]]:
        out: dict[bytes, list[int]] = {}
        by_length: dict[int, list[bytes]] = {}
        for word in found:
            by_length.setdefault(len(word), []).append(word)
        for length, group in by_length.items():
            if length > SHORT:
                for word in group:
                    letters = np.frombuffer(word, np.uint8)
                    out[word] = self.merge_long([*self.inner[letters[:-1]].tolist(), int(self.last[letters[-1]])])
                continue
            letters = np.frombuffer(b"".join(group), np.uint8).reshape(-1, length)
            parts = self.inner[letters]
            parts[:, -1] = self.last[letters[:, -1]]
            for rows, ids in self.merge_short(parts):
                for row, own in zip(rows.tolist(), ids.tolist(), strict=True):
                    out[group[row]] = own
        return out


class Encoder:
    """Ids of white-space separated pieces, each piece encoded once."""

    def __init__(self, vocabulary: Vocabulary):
        import regex

        self.vocabulary = vocabulary
        self.find = regex.compile(vocabulary.pattern).findall
        self.special = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")") if vocabulary.special else None
        self.odd_spaces = re.compile("[\x1c-\x1f]")  # Python splits there, the word pattern doesn't
        self.spaces = regex.compile(r"\s+")
        self.known: dict[str, tuple[int, str, str]] = {}
        self.names = [str(i) for i in range(len(vocabulary.tokens))]

    def pieces(self, text: str) -> list[str]:
        if self.odd_spaces.search(text):
            return [p for p in self.spaces.split(text) if p]
        return text.split()

    def _words(self, piece: str) -> list[bytes | int]:
        """Words of a piece as bytes; special tokens as ids."""
        if self.special and "<" in piece and self.special.search(piece):
            out: list[bytes | int] = []
            for part in self.special.split(piece):
                out += [self.vocabulary.special[part]] if part in self.vocabulary.special else self._words(part)
            return out
        plain = piece if piece.isascii() else unicodedata.normalize("NFC", piece).replace("Σ", "σ")
        return [w.encode() for w in self.find(plain.lower())]

    def learn(self, found: set[str]) -> None:
        if len(self.known) > KEPT:
            self.known.clear()
        new = {p: self._words(p) for p in found if p not in self.known}
        ids_of = self.vocabulary.encode_words({w for own in new.values() for w in own if isinstance(w, bytes)})
        names, tokens = self.names, self.vocabulary.tokens
        for piece, own in new.items():
            ids = [i for w in own for i in (ids_of[w] if isinstance(w, bytes) else (w,))]
            self.known[piece] = (len(ids), " ".join([names[i] for i in ids]), " ".join([tokens[i] for i in ids]))

    def encode(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """(number of tokens, ids in decimal, tokens) of each text, joined by spaces."""
        cut = [self.pieces(t) for t in texts]
        found = set().union(*cut)
        if len(self.known) + len(found) > KEPT:
            self.known.clear()
        self.learn(found)
        known = self.known
        for own in cut:
            parts = [known[p] for p in own]
            yield sum([p[0] for p in parts]), " ".join([p[1] for p in parts if p[0]]), " ".join([p[2] for p in parts if p[0]])


def _encode(content, wanted: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(content.value))
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for chunk in words.in_chunks(((i, t or "") for i, t in rows), 1, 4 << 20):
                out = list(encoder.encode([t for _, t in chunk]))
                columns = {
                    "doc_id": lambda: pa.array([i for i, _ in chunk], pa.int64()),
                    "n_tokens": lambda: pa.array([n for n, _, _ in out], pa.int64()),
                    "ids": lambda: pa.array([np.array(i.split(), np.int32) for _, i, _ in out], pa.list_(pa.int32())),
                    "decoded": lambda: pa.array([d for _, _, d in out], pa.string()),
                    "ids_sha256": lambda: pa.array([hashlib.sha256(i.encode()).hexdigest() for _, i, _ in out], pa.string()),
                    "decoded_sha256": lambda: pa.array([hashlib.sha256(d.encode()).hexdigest() for _, _, d in out], pa.string()),
                }
                yield pa.RecordBatch.from_arrays([columns[c]() for c in wanted], names=wanted)

    return run


_KINDS = {"doc_id": "bigint", "n_tokens": "bigint", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


def encode(docs: DataFrame, path: str = VOCABULARY, columns: tuple[str, ...] = ("doc_id", "n_tokens", "ids")) -> DataFrame:
    """Encode and decode every text; `columns` picks from doc_id, n_tokens, ids, decoded, ids_sha256, decoded_sha256."""
    with open(path, "rb") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_encode(content, list(columns)), ", ".join(f"{c} {_KINDS[c]}" for c in columns))


def decode(encoded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, decoded) from (doc_id, ids)."""
    with open(path, "rb") as file:
        content = encoded.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Vocabulary(content.value).tokens
        for batch in batches:
            texts = [" ".join([tokens[i] for i in ids or ()]) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "decoded"])

    return encoded.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids").mapInArrow(run, "doc_id bigint, decoded string")
