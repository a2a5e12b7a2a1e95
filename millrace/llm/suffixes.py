"""Removal of long strings that occur more than once, by column-wise construction of sorted suffixes.

Every byte covered by a string of `SIZE` bytes that also starts anywhere else, in the same text or another,
is taken out. Two places with the same string are neighbours in the order of all suffixes; the order is built
for many texts at once, one column after the other from the right (after BCR and the positional
Burrows-Wheeler transform): each round inserts one symbol of every string in front of what is there. The
symbols in front of the sorted suffixes, which are the transform's next column, sort them anew, stably, and
the lengths that neighbours have in common are carried over by range minima.

So that no task needs the whole collection, and rounds do not grow with the longest text:

1. Each string of `SIZE` bytes has a landmark: the place of the least hash among its `KGRAM`-byte pieces,
   the leftmost of ties. The string alone decides it, so equal strings have the same landmark at the same place.
   All strings around one landmark together are one stretch of at most 2 * `SIZE` - `KGRAM` bytes.
2. Spark counts the landmarks' hashes. Stretches whose landmark comes once hold nothing that is repeated.
   Of the others, those that stand under one hash are sent to one place, sorted by it: Spark's sorted
   shuffle files are the sequential external files. Equal texts are one text, of which all copies are gone.
3. A task reads them in that order, batch by batch, lines a batch's stretches up by their landmarks and
   runs one round per column. Neighbours with `SIZE` bytes in common are repeated strings.
4. A landmark of more than `HOT` stretches would not fit into a batch. Its strings are told apart by digests of
   128 bits instead, one by one; of equal strings or stretches a task sends two at most, so a passage that
   a third of all texts share costs a few rows per task.
5. What is repeated comes back to its text, and is merged into maximal spans.

Strings are found among the input, not among what is left. A null text is empty; texts shorter than `SIZE`
stay whole. A row without id is judged like any other, and rows that share an id or a text are rows of their own:
equal texts of `SIZE` bytes or more are gone in all rows. Columns other than doc_id and text play no part.
An empty table gives an empty result.
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

from millrace.llm import words
from millrace.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIZE = 400
KGRAM = 96
HOT = 4096
#: Stretches that one construction takes together, at least (whole landmarks).
BATCH = 4096
#: Digests that a task remembers of what it has sent.
REMEMBERED = 200_000

#: Bytes whose landmarks are found together.
PART = 1 << 20
_PLACE_BITS = 20
_BYTE_VALUES = words.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: No byte of a text in UTF-8.
_MISSING = 255

_MARK = "struct<hash: bigint, at: int, start: int, stop: int, settled: boolean, several: boolean>"
_TEXTS = f"doc_id bigint, class binary, n_bytes bigint, sha string, marks array<{_MARK}>"
_SENT = "spread bigint, content binary, column int, class binary, start bigint, stop bigint"
_REPEATED = "class binary, start bigint, stop bigint"
_SPANS = "array<struct<start: bigint, stop: bigint>>"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def _batch(out: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*out, strict=True) if out else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every `width` neighbouring values."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def landmarks(texts: list[bytes], size: int, k: int) -> tuple[np.ndarray, ...]:
    """(text, hash, place, first start, last start) of the landmarks of all strings of `size` bytes, in order."""
    if len(texts) == 1 and len(texts[0]) > PART:  # parts that share no string
        found = []
        for low in range(0, len(texts[0]) - size + 1, PART - size + 1):
            own = landmarks([texts[0][low : low + PART]], size, k)
            found.append((own[0], own[1], *(c + low for c in own[2:])))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))
    lengths = [len(t) for t in texts]
    view = np.frombuffer(b"".join(texts), np.uint8)
    if len(view) < size:
        return (np.zeros(0, np.int64),) * 5
    owner = np.repeat(np.arange(len(texts)), lengths)
    hashes = words.window_hashes(_BYTE_VALUES[view], k)
    places = np.uint64((1 << _PLACE_BITS) - 1)
    least = _window_least((hashes & ~places) | np.arange(len(hashes), dtype=np.uint64), size - k + 1)
    inside = np.zeros(len(least) + 2, bool)
    inside[1:-1] = owner[: len(least)] == owner[size - 1 :]
    other = np.ones(len(least) + 1, bool)
    other[1:-1] = least[1:] != least[:-1]
    first = np.flatnonzero(inside[1:-1] & (other[:-1] | ~inside[:-2]))
    last = np.flatnonzero(inside[1:-1] & (other[1:] | ~inside[2:]))
    at = (least[first] & places).astype(np.int64)
    offset = np.cumsum([0, *lengths])[owner[first]]
    return owner[first], hashes[at].view(np.int64), at - offset, first - offset, last - offset


def _marks(size: int, k: int):
    """Every text with its class, its digest and its landmarks.

    A stretch that stands in the same text more than once is marked once, as settled; the later ones are
    marked as covered, without a hash.
    """

    def chunk_rows(chunk: list[tuple[int, bytes]]) -> pa.RecordBatch:
        texts = [t for _, t in chunk]
        owner, hashes, at, first, last = landmarks(texts, size, k)
        stop = last + size
        order = np.lexsort((hashes, owner))
        again = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        several, settled, covered = (np.zeros(len(owner), bool) for _ in range(3))
        several[order[1:][again]] = several[order[:-1][again]] = True
        seen: dict[tuple[int, bytes], int] = {}
        for i in np.flatnonzero(several):
            stretch = (int(owner[i]), texts[owner[i]][first[i] : stop[i]])
            if stretch in seen:
                covered[i] = settled[seen[stretch]] = True
            else:
                seen[stretch] = i
        seen.clear()
        mark = pa.StructArray.from_arrays(
            [
                pa.array(hashes, pa.int64(), mask=covered), pa.array(at, pa.int32()), pa.array(first, pa.int32()),
                pa.array(stop, pa.int32()), pa.array(settled | covered), pa.array(several),
            ],
            names=["hash", "at", "start", "stop", "settled", "several"],
        )
        offsets = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32())
        digests = [hashlib.sha256(t) for t in texts]
        columns = [
            pa.array([doc for doc, _ in chunk], pa.int64()), pa.array([d.digest()[:16] for d in digests], pa.binary()),
            pa.array([len(t) for t in texts], pa.int64()), pa.array([d.hexdigest() for d in digests], pa.string()),
            pa.ListArray.from_arrays(offsets, mark),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "class", "n_bytes", "sha", "marks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(b.column(0).to_pylist(), words.utf8(b.column(1)), strict=True))
        for chunk in words.in_chunks(rows, 1, PART):
            yield chunk_rows(chunk)

    return run


def _send(size: int, k: int):
    """Stretches (or digests of strings) that go out, and spans that are known to be repeated already.

    Of what a task sends, the first carries its text's class; the second is there to be found by the first.
    """
    schema = _schema(_SENT)

    def pieces(text: bytes, mark: tuple) -> Iterator[tuple[int, bytes, int, int, int]]:
        spread, at, start, stop, hot = mark
        if not hot:
            yield spread, text[start:stop], start - at + size - k, start, stop
            return
        for low in range(start, stop - size + 1):
            digest = hashlib.blake2b(text[low : low + size], digest_size=16).digest()
            yield int.from_bytes(digest[:8], "little", signed=True), digest, -1, low, low + size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone: dict[bytes, bool] = {}
        for batch in batches:
            asked = batch.column(2)
            edges = asked.offsets.to_numpy()
            fields = [asked.values.field(f) for f in ("hash", "at", "start", "stop", "hot")]
            marks = list(zip(*(f.to_pylist() for f in fields), strict=True))
            settled = asked.values.field("settled").to_pylist()
            out, held = [], 0
            for i, (owner, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                known = []
                for j in range(edges[i], edges[i + 1]):
                    if settled[j]:
                        known.append(marks[j][2:4])
                    if marks[j][0] is None:
                        continue
                    for spread, content, column, start, stop in pieces(text, marks[j]):
                        name = content if column < 0 else hashlib.blake2b(content, digest_size=16).digest()
                        waiting = alone.get(name)
                        if waiting is not None and not settled[j]:
                            known.append((start, stop))
                        if waiting is None:
                            alone[name] = not settled[j]
                            out.append((spread, content, column, None if settled[j] else owner, start, stop))
                        elif waiting:
                            alone[name] = False
                            out.append((spread, content, column, None, start, stop))
                        held += len(content)
                spread = int.from_bytes(owner[:8], "little", signed=True)
                out += [(spread, None, None, owner, start, stop) for start, stop in _merged(known)]
                if len(alone) > REMEMBERED:
                    alone.clear()
                if held > 4 << 20:
                    yield _batch(out, schema)
                    out, held = [], 0
            yield _batch(out, schema)

    return run


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Spans that overlap or touch, as one."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return out


class RangeMinima:
    """Minima of ranges, from those of all ranges whose lengths are powers of two."""

    def __init__(self, values: np.ndarray):
        self.levels = np.empty((max(1, len(values).bit_length()), len(values)), values.dtype)
        self.levels[0] = values
        for level in range(1, len(self.levels)):
            half = 1 << (level - 1)
            self.levels[level] = self.levels[level - 1]
            np.minimum(self.levels[level - 1, :-half], self.levels[level - 1, half:], out=self.levels[level, :-half])

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Of values low to high - 1; no range is empty."""
        level = _LOGARITHMS[high - low]
        return np.minimum(self.levels[level, low], self.levels[level, high - (1 << level)])


_LOGARITHMS = np.zeros(1 << 16, np.int64)
for _bit in range(1, 16):
    _LOGARITHMS[1 << _bit :] = _bit


def repeated_starts(symbols: np.ndarray, size: int) -> np.ndarray:
    """Where strings of `size` symbols start that another row has in the same columns.

    symbols: columns x rows, with `_MISSING` where a row has none. The result has as many columns as
    a string can start in.
    """
    columns, rows = symbols.shape
    out = np.zeros((columns - size + 1, rows), bool)
    order = np.arange(rows)
    apart = np.full(rows, columns, np.int16)  # the first column in which a row differs from the one before it
    for column in range(columns - 1, -1, -1):
        front = symbols[column, order]  # one symbol of every row, in the order of what follows it
        moved = np.argsort(front, kind="stable")
        front = front[moved]
        same = np.flatnonzero((front[1:] == front[:-1]) & (front[1:] != _MISSING)) + 1
        minima = RangeMinima(apart)
        apart = np.full(rows, column, np.int16)
        apart[same] = minima.least(moved[same - 1] + 1, moved[same] + 1)
        order = order[moved]
        if column < len(out):
            alike = np.flatnonzero(apart >= column + size)
            out[column, order[alike]] = out[column, order[alike - 1]] = True
    return out


def _construct(size: int, k: int):
    """Repeated spans of the stretches that stand together, batch by batch."""
    schema = _schema(_REPEATED)
    width = 2 * size - k

    def stretches(rows: list[tuple]) -> Iterator[tuple]:
        symbols = np.full((len(rows), width), _MISSING, np.uint8)
        for i, (content, column, *_) in enumerate(rows):
            symbols[i, column : column + len(content)] = np.frombuffer(content, np.uint8)
        found = repeated_starts(np.ascontiguousarray(symbols.T), size)
        first, last = found.argmax(axis=0), len(found) - 1 - found[::-1].argmax(axis=0)
        for i in np.flatnonzero(found.any(axis=0)):
            _, column, owner, start, _ = rows[i]
            if owner is not None:  # places between two repeated strings of a stretch are covered by them
                yield owner, start + int(first[i]) - column, start + int(last[i]) - column + size

    def strings(rows: list[tuple]) -> Iterator[tuple]:
        times: dict[bytes, int] = {}
        for content, *_ in rows:
            times[content] = times.get(content, 0) + 1
        found: dict[bytes, list[tuple[int, int]]] = {}
        for content, _, owner, start, stop in rows:
            if owner is not None and times[content] > 1:
                found.setdefault(owner, []).append((start, stop))
        for owner, spans in found.items():
            yield from ((owner, start, stop) for start, stop in _merged(spans))

    def settle(rows: list[tuple]) -> list[tuple]:
        long = [r for r in rows if r[1] >= 0]
        short = [r for r in rows if r[1] < 0]
        return [*(stretches(long) if len(long) > 1 else ()), *strings(short)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None  # rows of whole landmarks, and of the one that may go on
        going: list[tuple] = []
        for batch in batches:
            known = []
            for spread, content, column, owner, start, stop in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if content is None:
                    known.append((owner, start, stop))
                    continue
                if spread != last:
                    held += going
                    going, last = [], spread
                    if len(held) >= BATCH:
                        known += settle(held)
                        held = []
                going.append((content, column, owner, start, stop))
            yield _batch(known, schema)
        yield _batch(settle(held + going), schema)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text without its spans."""
    for batch in batches:
        out = []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            merged = _merged([(s["start"], s["stop"]) for s in spans])
            edges = [0, *(e for span in merged for e in span), len(text)]
            digest = hashlib.sha256(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))).hexdigest()
            out.append((sum(b - a for a, b in merged), [{"start": a, "stop": b} for a, b in merged], digest))
        removed, merged, digests = zip(*out, strict=True) if out else ((), (), ())
        kinds = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        columns = [batch.column(0), pa.array(removed, pa.int64()), pa.array(merged, kinds), pa.array(digests, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["class", "n_removed", "spans", "kept"])


def remove_repeats(docs: DataFrame, size: int = SIZE, k: int = KGRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (array of start, stop: the bytes taken out)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = cut_lineage(rows.mapInArrow(_marks(size, k), _TEXTS))
    marks = texts.select("class", F.explode("marks").alias("m")).select("class", "m.*")

    name = F.xxhash64("class")
    counts = marks.where("hash is not null").groupBy("hash").agg(
        F.count("*").alias("n"), F.min(name).alias("low"), F.max(name).alias("high"), F.max("several").alias("several")
    )
    counts = counts.where("low <> high or several").select("hash", (F.col("n") > HOT).alias("hot"))
    open_ = marks.where("hash is not null").join(counts, "hash")
    open_ = open_.unionByName(marks.where("hash is null").withColumn("hot", F.lit(False)))
    asked = F.collect_set(F.struct("hash", "at", "start", "stop", "settled", "hot")).alias("asked")
    asked = open_.groupBy("class").agg(asked)

    data = F.col("text").cast("binary")
    class_ = F.substring(F.unhex(F.sha2(data, 256)), 1, 16)
    distinct = rows.where(F.octet_length("text") >= size).select(class_.alias("class"), data.alias("text")).where("class is not null")
    distinct = distinct.groupBy("class").agg(F.first("text").alias("text"))
    sent = distinct.join(asked, "class").select("class", "text", "asked").mapInArrow(_send(size, k), _SENT)
    found = sent.repartition("spread").sortWithinPartitions("spread").mapInArrow(_construct(size, k), _REPEATED)
    spans = found.groupBy("class").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    cut = distinct.join(spans, "class").select("class", "text", "spans").mapInArrow(_cut, f"class binary, n_removed bigint, spans {_SPANS}, kept string")

    copies = texts.where(F.col("n_bytes") >= size).groupBy("class").agg(F.count("*").alias("copies")).where("copies > 1")
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("stop")))
    own = F.when(F.col("copies").isNotNull(), whole).otherwise(F.coalesce("spans", F.array().cast(_SPANS))).alias("spans")
    gone = F.when(F.col("copies").isNotNull(), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed")
    kept = F.when(F.col("copies").isNotNull(), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256")
    joined = texts.drop("marks").join(copies, "class", "left").join(cut, "class", "left")
    joined = joined.select("doc_id", "n_bytes", gone, own, kept)
    return joined.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256", "spans")
