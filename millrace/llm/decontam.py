"""Benchmark passages in documents, by a prefix-filtered set join of item windows.

A window is a run of `size` item words (a shorter item is one window). Containment asks for all of
a window's words, so its necessary prefix is its rarest word, here taken with the rarer of that word's
two neighbours. Spark counts how often each benchmark word occurs in the documents, files every window
under the hash of that pair and the pair's place, and drops windows with a word that no document has.
Each place of a document that may hold a filed pair becomes a candidate, with the words around it.
Candidates are joined with the windows on the pair; place and length bound where the window would have
to lie, and there the words themselves are compared. Items are joined to the windows found, once for
each set of windows that documents have in common.

Everything goes by Spark joins, whatever the size of the benchmark; a side is broadcast only below a
checked size. Tasks are told which words and pairs are filed by bit maps of at most `MOST_BITS` bits
(16 MB), the only thing that passes through the driver. A bit map lets some false candidates
pass, which the join drops; beyond some 10**7 windows they become many, so the join grows, not the map.

Hits belong to the digest of a text, so repeated texts are looked up once. A null or empty text has no
words and no hits. An item that is null, empty or without an id is left out; items that share an id are
one item. Rows that share a doc_id are judged each by its own text. Other columns are ignored. An empty
benchmark leaves every document clean.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import words
from millrace.operators.joins import broadcast_if_small
from millrace.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 10
#: Bits of a bit map: 64 for each member, within these bounds.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27
_PIECE_BITS = 8 * 4096
_PAIR = np.uint64(0x9E3779B97F4A7C15)

#: A-Z become lower case; what is no digit, no letter and below 0x80 separates words.
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32) for c in range(256))

_CANDIDATE = pa.struct([("key", pa.int64()), ("place", pa.int32()), ("before", pa.int32()), ("around", pa.string())])
_SCANNED = pa.schema([("doc_id", pa.int64()), ("digest", pa.string()), ("n_words", pa.int64()), ("found", pa.list_(_CANDIDATE))])
_SCANNED_SQL = "doc_id bigint, digest string, n_words bigint, found array<struct<key: bigint, place: int, before: int, around: string>>"


def split_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _pairs(hashes: np.ndarray) -> np.ndarray:
    return words.mix(hashes[:-1] * _PAIR + hashes[1:])


def _single(hashes: np.ndarray) -> np.ndarray:
    """The key of a window of one word."""
    return words.mix(hashes ^ _PAIR)


def _item_windows(size: int):
    schema = pa.schema([("item_id", pa.string()), ("window", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), words.utf8(batch.column(1)), strict=True):
                own = split_words(text)
                found = [b" ".join(own[i : i + size]).decode() for i in range(max(1, len(own) - size + 1)) if own]
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(found), pa.string()), pa.array(found, pa.string())], schema=schema)

    return run


def _window_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of a window's words, and the key of each pair of neighbours (of the word, if it is one)."""
    for batch in batches:
        hashes, keys = [], []
        for window in words.utf8(batch.column(0)):
            own, _ = words.hashed_words([window])
            hashes.append(own.view(np.int64).tolist())
            keys.append((_pairs(own) if len(own) > 1 else _single(own)).view(np.int64).tolist())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(hashes, pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64()))], names=["window", "hashes", "keys"]
        )


def _bit_map(members: DataFrame):
    """Two bits for each different hash of the one column, as a broadcast array of bytes."""
    name = members.columns[0]
    members = members.distinct()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (64 * members.count()).bit_length()))
    slots = members.select(F.explode(F.array(*[F.col(name).bitwiseAND(bits - 1), F.shiftrightunsigned(name, 32).bitwiseAND(bits - 1)])).alias("slot"))
    pieces = slots.groupBy(F.expr(f"slot div {_PIECE_BITS}").alias("piece")).agg(F.bitmap_construct_agg(F.col("slot") % _PIECE_BITS).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for row in pieces.collect():  # at most MOST_BITS
        low = row["piece"] * (_PIECE_BITS // 8)
        out[low : low + _PIECE_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    return members.sparkSession.sparkContext.broadcast(out)


def _among(hashes: np.ndarray, bit_map: np.ndarray) -> np.ndarray:
    mask = np.uint64(len(bit_map) * 8 - 1)

    def has(slots: np.ndarray) -> np.ndarray:
        return (bit_map[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1 == 1

    out = has(hashes & mask)
    out[out] = has((hashes[out] >> np.uint64(32)) & mask)
    return out


def _word_counts(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in words.in_chunks(((t,) for t in words.utf8(batch.column(0))), 0):
                hashes, _ = words.hashed_words([t.translate(_FOLD) for (t,) in chunk])
                own, n = np.unique(hashes[_among(hashes, vocabulary.value)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(n.astype(np.int64))], names=["hash", "n"])

    return run


def _candidates(filed, size: int, singles: bool):
    """Each document with the places where a filed pair, or word, may stand, and the words around it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), words.utf8(batch.column(2)), strict=True)
            for chunk in words.in_chunks(table, 2):
                texts = [row[2].translate(_FOLD) for row in chunk]
                hashes, counts = words.hashed_words(texts)
                ends = np.cumsum(counts)
                places, keys = [], []
                if len(hashes) > 1:
                    pairs = _pairs(hashes)
                    inside = np.ones(len(pairs), bool)
                    borders = ends[(ends > 0) & (ends < len(hashes))] - 1
                    inside[borders] = False
                    places.append(np.flatnonzero(_among(pairs, filed.value) & inside))
                    keys.append(pairs[places[-1]])
                if singles and len(hashes):
                    single = _single(hashes)
                    places.append(np.flatnonzero(_among(single, filed.value)))
                    keys.append(single[places[-1]])
                found: list[list[dict]] = [[] for _ in chunk]
                if places:
                    at, key = np.concatenate(places), np.concatenate(keys).view(np.int64)
                    owners = np.searchsorted(ends, at, side="right")
                    split: dict[int, list[bytes]] = {}
                    for i, k, owner in zip(at.tolist(), key.tolist(), owners.tolist(), strict=True):
                        if owner not in split:
                            split[owner] = texts[owner].split()
                        place = i - int(ends[owner] - counts[owner])
                        low = max(0, place - size + 2)
                        around = b" ".join(split[owner][low : place + size]).decode()
                        found[owner].append({"key": k, "place": place, "before": place - low, "around": around})
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row[0] for row in chunk], pa.int64()),
                        pa.array([row[1] for row in chunk], pa.string()),
                        pa.array(counts.astype(np.int64)),
                        pa.array(found, pa.list_(_CANDIDATE)),
                    ],
                    schema=_SCANNED,
                )

    return run


def _digest() -> Column:
    return F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)


def _file_windows(windows: DataFrame, texts: DataFrame) -> DataFrame:
    """window, n, at (place of its pair) and key (of the pair) of every window that can occur."""
    vocabulary = _bit_map(windows.select(F.explode("hashes").alias("hash")))
    counts = texts.mapInArrow(_word_counts(vocabulary), "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("count"))
    placed = windows.select("window", F.posexplode("hashes").alias("place", "hash")).join(counts, "hash")
    order = F.array_sort(F.collect_list(F.struct("place", "count")))  # of one window: at most `size`
    full = placed.groupBy("window").agg(order.alias("order"), F.min_by("place", F.struct("count", "place")).alias("rarest"))
    known = windows.join(full, "window").where(F.size("order") == F.size("hashes"))
    count_at = lambda place: F.get("order", place)["count"]
    left, right = count_at(F.col("rarest") - 1), count_at(F.col("rarest") + 1)
    with_left = (F.col("rarest") > 0) & (right.isNull() | (left < right))
    at = F.when(with_left, F.col("rarest") - 1).otherwise(F.col("rarest"))
    return known.select("window", F.size("hashes").alias("n"), at.alias("at"), F.get("keys", at).alias("key"))


def _spans(met: DataFrame) -> DataFrame:
    """Per digest the merged stretches of hit words, their sum, and the windows met."""
    order = Window.partitionBy("digest").orderBy("first", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = met.select("digest", "first", "end").distinct().withColumn("opens", (reach.isNull() | (F.col("first") > reach)).cast("int"))
    numbered = marked.withColumn("stretch", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy("digest", "stretch").agg(F.min("first").alias("first"), F.max("end").alias("end"))
    spans = merged.groupBy("digest").agg(
        F.sum(F.col("end") - F.col("first")).cast("bigint").alias("n_hit"),
        F.array_sort(F.collect_list(F.struct("first", "end"))).alias("spans"),  # of one text
    )
    windows = met.groupBy("digest").agg(F.array_sort(F.collect_set("window_id")).alias("windows"))
    return spans.join(windows, "digest")


def _search(docs: DataFrame, benchmark: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Every document (doc_id, digest, n_words), and what the texts with hits hold."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _digest().alias("digest"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("item_id is not null and text is not null")
    owned = cut_lineage(items.mapInArrow(_item_windows(size), "item_id string, window string").distinct())
    keyed = owned.select("window").distinct().mapInArrow(_window_keys, "window string, hashes array<bigint>, keys array<bigint>")
    filed = cut_lineage(_file_windows(cut_lineage(keyed), texts.select("text")))
    singles = not filed.where("n = 1").isEmpty()
    scan = _candidates(_bit_map(filed.select("key")), size, singles)
    scanned = cut_lineage(texts.mapInArrow(scan, _SCANNED_SQL))

    candidates = scanned.where(F.size("found") > 0).select("digest", F.explode("found").alias("c")).select("digest", "c.*").distinct()
    start = F.col("before") - F.col("at")
    there = F.array_join(F.slice(F.split("around", " "), start + 1, F.col("n")), " ")
    same = F.when(start >= 0, there == F.col("window")).otherwise(False)
    met = candidates.join(broadcast_if_small(filed), "key").where(same)
    met = met.select(
        "digest",
        (F.col("place") - F.col("at")).alias("first"),
        (F.col("place") - F.col("at") + F.col("n")).alias("end"),
        F.sha2("window", 256).alias("window_id"),
    )
    hits = cut_lineage(_spans(cut_lineage(met)))
    sets = hits.select("windows").distinct()
    ids = owned.select(F.sha2("window", 256).alias("window_id"), "item_id")
    item_sets = (
        sets.select("windows", F.explode("windows").alias("window_id"))
        .join(ids, "window_id")
        .groupBy("windows")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    return scanned.select("doc_id", "digest", "n_words"), hits.join(item_sets, "windows").select("digest", "n_hit", "spans", "items")


def find_passages(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, spans (first and end of every stretch of hit words), items (ids, as sorted strings).

    Without a hit, n_hit is 0 and spans and items are empty.
    """
    scanned, hits = _search(docs, benchmark, size)
    return scanned.join(broadcast_if_small(hits), "digest", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<first: int, end: int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document: words, hit words, items met, their digest, and whether it is contaminated."""
    return find_passages(docs, benchmark, size).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of docs, all columns, whose text holds no window of the benchmark."""
    own, other = (f"digest_{uuid.uuid4().hex}" for _ in range(2))  # no column of the caller's
    _, hits = _search(docs, benchmark, size)
    dirty = broadcast_if_small(hits.select(F.col("digest").alias(other)))
    return docs.withColumn(own, _digest()).join(dirty, F.col(own) == F.col(other), "left_anti").drop(own)
