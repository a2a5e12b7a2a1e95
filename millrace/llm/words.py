"""Words of byte texts, hashes of words and of word windows, as vectors.

A text is handled as UTF-8 bytes. A hash of a byte range is polynomial: with S the running sum of
value[byte] * base**position, the range (a, b) hashes to (S[b] - S[a]) * base**-a, mixed afterwards.
Modulo 2**64 such sums lose bits over long, regular ranges (Thue-Morse words of 2,048 letters are all alike),
so words of more than `LONG` bytes are hashed by BLAKE2 instead, and windows are of few words.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD1342543DE82EF95
_BLOCK = 1 << 20
#: Bytes of the longest word that is hashed by its sum.
LONG = 24

WHITE_SPACE = bytes([9, 10, 11, 12, 13, 32])


class _Kept(dict):
    """Arrays that a worker keeps between calls; they don't travel with a function."""

    def __reduce__(self):
        return (_Kept, ())


_KEPT = _Kept()


def _powers(base: int, n: int) -> np.ndarray:
    if (base, n) not in _KEPT:
        if len(_KEPT) > 8:  # of a few very long texts
            _KEPT.clear()
        out = np.full(n, base, np.uint64)
        out[0] = 1
        _KEPT[base, n] = np.cumprod(out)
    return _KEPT[base, n]


def _power_pair(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(20, (n - 1).bit_length())
    return _powers(base, size)[:n], _powers(pow(base, -1, 2**64), size)[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all bits; one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _range_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    forth, back = _power_pair(base, len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * forth, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * back[starts])


def byte_set(members: bytes, inverted: bool = False) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return ~out if inverted else out


NOT_SPACE = byte_set(WHITE_SPACE, inverted=True)


def spans(data: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of bytes of one kind; kind 0 (False) lies between words."""
    own = np.zeros(len(data) + 2, kinds.dtype)
    own[1:-1] = kinds[data]
    edges = np.flatnonzero(own[1:] != own[:-1])
    inside = np.flatnonzero(own[1:][edges[:-1]]) if len(edges) else edges
    return edges[inside], edges[inside + 1]


def hashed_words(texts: list[bytes], kinds: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the number of words of each text.

    A space must be of kind 0. The work goes block by block, cut between words.
    """
    data = b" ".join(texts)
    view = np.frombuffer(data, np.uint8)
    hashes, firsts = [], []
    low = 0
    while low < len(data):
        high = min(low + _BLOCK, len(data))
        while high < len(data) and kinds[data[high]]:
            high += 1
        block = view[low:high]
        starts, ends = spans(block, kinds)
        if len(starts):
            own = _range_sums(_BYTE_VALUES[block], starts, ends, _BASE)
            for i in np.flatnonzero(ends - starts > LONG):
                word = data[low + starts[i] : low + ends[i]]
                own[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
            hashes.append(own)
            firsts.append(starts + low)
        low = high
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return np.concatenate(hashes), np.diff(np.searchsorted(np.concatenate(firsts), offsets))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` words; a run may cross the border of two texts."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    starts = np.arange(n)
    return _range_sums(words, starts, starts + size, _WORD_BASE)


def sequence_hash(words: np.ndarray) -> np.ndarray:
    """One hash for all words together, told apart from the hashes of full windows by the length."""
    one = _range_sums(words, np.array([0]), np.array([len(words)]), _WORD_BASE)
    return mix(one + np.uint64(len(words)))


def utf8(column) -> list[bytes]:
    """The texts of an Arrow string column as bytes; null is the empty text."""
    import pyarrow as pa

    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [v or b"" for v in column.cast(kind).to_pylist()]


def in_chunks(rows: Iterator[tuple], text_at: int, limit: int = 2 << 20) -> Iterator[list[tuple]]:
    """Groups of rows whose texts have `limit` bytes together; a longer text comes alone."""
    chunk, held = [], 0
    for row in rows:
        if chunk and held + len(row[text_at]) > limit:
            yield chunk
            chunk, held = [], 0
        chunk.append(row)
        held += len(row[text_at])
    if chunk:
        yield chunk
