"""Removal of passages that repeat across documents, by hashes of every fixed-length window.

Every run of `size` words of every document is hashed by a rolling polynomial. Spark shuffles the
hashes by bucket; a bucket finds, for each hash, the smallest document that has it. All other
documents get the hash back, hash their windows again, and merge the windows found into maximal
intervals, which are taken out.

* A chunk of documents sends each hash with its smallest document of the chunk only; the others of
  the chunk know at once that a smaller one exists. What they know goes by document, in groups of its own
  (`PARTS` for each bucket), so of a hot passage its bucket gets one entry per chunk.
* A null text has no words. A document without id removes nothing and keeps all its words. Rows
  that share an id count as one document and don't remove each other's words. Columns other than
  the id and the text play no part. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import packed, words

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 50
#: Groups that share what is known of one bucket's hashes already.
PARTS = 16

_ROWS = "bucket int, doc_id bigint, steps binary, runs binary, hashes binary"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def _windows(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each window that lies within one text."""
    hashes, counts = words.hashed_words(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    found = words.window_hashes(hashes, size)
    inside = owner[: len(found)] == owner[size - 1 :] if len(found) else np.zeros(0, bool)
    return found[inside], owner[: len(found)][inside]


def _emit(size: int, bits: int):
    schema = _schema(_ROWS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(batch.column(0).to_pylist(), words.utf8(batch.column(1)), strict=True)

    def chunk_rows(chunk: list[tuple]) -> Iterator[tuple]:
        chunk = sorted(chunk, key=lambda r: r[0])
        ids = np.array([r[0] for r in chunk], np.int64)
        hashes, owner = _windows([r[1] for r in chunk], size)
        hashes, docs = packed.cut(hashes, bits), ids[owner]
        order = np.argsort(hashes, kind="stable")  # documents come in rising order within a hash
        firsts = packed.runs_of(hashes[order])
        least = np.repeat(docs[order[firsts]], np.diff(np.append(firsts, len(order))))
        late = np.zeros(len(order), bool)
        late[order] = docs[order] > least
        for bucket, steps, runs, digests in packed.by_bucket(docs[~late], hashes[~late], bits):
            yield bucket, None, steps, runs, digests
        docs, hashes = docs[late], hashes[late]
        for doc, at in packed.per_document(docs):
            own = np.unique(hashes[at])
            for bucket, _, _, digests in packed.by_bucket(np.full(len(own), doc), own, bits):
                yield bucket, doc, None, None, digests

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in words.in_chunks(rows(batches), 1):
            out = list(chunk_rows(chunk))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return emit


def _settle(bits: int):
    schema = _schema("doc_id bigint, bucket int, hashes binary")

    def settle(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        known, open_ = [], []
        for doc, *row in zip(*(table[c].to_pylist() for c in ("doc_id", "steps", "runs", "hashes")), strict=True):
            known.append((doc, bucket, row[2])) if doc is not None else open_.append(row)
        docs, hashes = packed.from_bucket(open_, bucket, bits)
        order = np.argsort(hashes)
        docs, hashes = docs[order], hashes[order]
        firsts = packed.runs_of(hashes)
        if len(firsts):
            least = np.repeat(np.minimum.reduceat(docs, firsts), np.diff(np.append(firsts, len(docs))))
            late = docs > least
            docs, hashes = docs[late], hashes[late]
            known += [(doc, bucket, packed.pack(np.unique(hashes[at]), bits)) for doc, at in packed.per_document(docs)]
        columns = zip(*known, strict=True) if known else ([], [], [])
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return settle


def repeated_windows(docs: DataFrame, size: int = WINDOW, bits: int | None = None) -> DataFrame:
    """(doc_id, bucket, hashes): the windows of each document that a smaller document has too."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null")
    bits = packed.bucket_bits(texts) if bits is None else bits
    sent = texts.where("text is not null").mapInArrow(_emit(size, bits), _ROWS)
    part = F.when(F.col("doc_id").isNull(), 0).otherwise(1 + F.pmod("doc_id", F.lit(PARTS)))
    return sent.withColumn("part", part).groupBy("bucket", "part").applyInArrow(_settle(bits), "doc_id bigint, bucket int, hashes binary")


def _remove(size: int, bits: int):
    kinds = _schema("doc_id bigint, n_words bigint, n_removed bigint, kept string, kept_sha256 string")

    def one(text: bytes, found: list | None) -> tuple[int, int, bytes]:
        own = text.split()
        kept = own
        if found:
            late = np.unique(np.concatenate([packed.unpack(f["hashes"], f["bucket"], bits) for f in found]))
            hashes, _ = _windows([text], size)
            starts = np.flatnonzero(np.isin(packed.cut(hashes, bits), late))
            depth = np.zeros(len(own) + 1, np.int64)
            np.add.at(depth, starts, 1)
            np.add.at(depth, starts + size, -1)
            kept = [own[i] for i in np.flatnonzero(np.cumsum(depth)[:-1] == 0)]
        return len(own), len(own) - len(kept), b" ".join(kept)

    def remove(with_text: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = [one(t, f) for t, f in zip(words.utf8(batch.column(1)), batch.column(2).to_pylist(), strict=True)]
                total, removed, kept = zip(*out, strict=True) if out else ((), (), ())
                columns = {
                    "doc_id": batch.column(0),
                    "n_words": pa.array(total, pa.int64()),
                    "n_removed": pa.array(removed, pa.int64()),
                    "kept": pa.array(kept, pa.binary()).cast(pa.string()),
                    "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                }
                names = [f.name for f in kinds if with_text or f.name != "kept"]
                yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

        return run

    return remove


def remove_repeats(docs: DataFrame, size: int = WINDOW, with_text: bool = True) -> DataFrame:
    """Each document without the words that a repeated window covers.

    Columns doc_id, n_words, n_removed, kept (the rest, joined by spaces; only `with_text`) and
    kept_sha256.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    bits = packed.bucket_bits(texts)
    found = repeated_windows(texts, size, bits).groupBy("doc_id").agg(F.collect_list(F.struct("bucket", "hashes")).alias("found"))
    out = "doc_id bigint, n_words bigint, n_removed bigint, kept string, kept_sha256 string"
    out = out if with_text else out.replace("kept string, ", "")
    return texts.join(found, "doc_id", "left").select("doc_id", "text", "found").mapInArrow(_remove(size, bits)(with_text), out)
