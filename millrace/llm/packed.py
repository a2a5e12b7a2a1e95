"""Hashes of many documents, packed into binary rows by hash bucket.

A row per chunk of documents and bucket holds the documents, how many hashes each has there, and the
hashes, seven bytes each. The bucket is the low bits of a hash, so a row loses at most the top bits:
56 bits and those of the bucket remain, and among n hashes a chance meeting is expected
n * n / 2**(57 + bucket bits) times. `DIGEST_BYTES` 8 keeps them all, for one more byte a hash.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIGEST_BYTES = 7
BUCKET_BYTES = 16 << 20
#: At least 64 buckets, for even work on small inputs too.
LEAST_BITS = 6


def bucket_bits(docs: DataFrame, text: str = "text") -> int:
    """So many bits that the hashes of one bucket stem from about 16 MB of text, or less."""
    total = docs.select(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    return max(LEAST_BITS, (total // BUCKET_BYTES).bit_length())


def cut(hashes: np.ndarray, bits: int) -> np.ndarray:
    """What is left of a hash after packing and unpacking: a value that still has its bucket in it."""
    kept = min(64, 8 * DIGEST_BYTES + bits)
    return hashes & np.uint64((1 << kept) - 1)


def pack(hashes: np.ndarray, bits: int) -> bytes:
    rest = (hashes >> np.uint64(bits)).astype("<u8")
    return rest.view(np.uint8).reshape(-1, 8)[:, :DIGEST_BYTES].tobytes()


def unpack(data: bytes, bucket: int, bits: int) -> np.ndarray:
    wide = np.zeros((len(data) // DIGEST_BYTES, 8), np.uint8)
    wide[:, :DIGEST_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, DIGEST_BYTES)
    return (wide.view("<u8").ravel() << np.uint64(bits)) | np.uint64(bucket)


def by_bucket(docs: np.ndarray, hashes: np.ndarray, bits: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """(bucket, documents, hashes of each, hashes) for parallel arrays; equal documents stand together."""
    buckets = (hashes & np.uint64((1 << bits) - 1)).astype(np.int64)
    order = np.argsort(buckets, kind="stable")
    edges = np.searchsorted(buckets[order], np.arange((1 << bits) + 1))
    for bucket in np.flatnonzero(np.diff(edges)):
        at = order[edges[bucket] : edges[bucket + 1]]
        own = docs[at]
        firsts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        runs = np.diff(np.append(firsts, len(own)))
        steps = np.diff(own[firsts], prepend=0)
        yield int(bucket), steps.astype("<i8").tobytes(), runs.astype("<u4").tobytes(), pack(hashes[at], bits)


def from_bucket(rows: list[tuple[bytes, bytes, bytes]], bucket: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and hashes as parallel arrays again."""
    docs, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for steps, runs, packed in rows:
        docs.append(np.repeat(np.cumsum(np.frombuffer(steps, "<i8")), np.frombuffer(runs, "<u4")))
        hashes.append(unpack(packed, bucket, bits))
    return np.concatenate(docs), np.concatenate(hashes)


def runs_of(ordered: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin in a sorted array."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1]]))


def per_document(docs: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(document, places of its entries in the arrays)."""
    order = np.argsort(docs, kind="stable")
    edges = np.append(runs_of(docs[order]), len(order))
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        yield int(docs[order[low]]), order[low:high]
