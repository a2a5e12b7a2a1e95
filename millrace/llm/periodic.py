"""Runs: maximal stretches of a text that repeat with a period, found tile by tile at the scale of the period.

A run is a stretch of consecutive words in which words `period` apart are equal, with no smaller period, of
at least `LEAST_WORDS` words and `LEAST_TIMES` periods, that no neighbouring word extends.

1. Periods fall into octaves: octave o has those from 2**o to 2**(o+1) - 1. For each octave a document is cut
   into tiles around boundaries that stand so close that every run of the octave has two whole periods
   behind one of them. So a document has about as many pairs of boundary and period in each octave as
   words, and the work is n log n.
2. Tiles are solved independently. A pair is open if the words behind the boundary come again one period
   later: single words are compared first, then hashes of the whole period. A pair is left out if it has a
   smaller period, which then divides it. For the others, the tile's boundary Z-functions (how far words
   and words one period later agree, to the right and to the left) are read off the words themselves, so no
   hash decides about a run's extent. They give a fragment, cut off at the tile's edges.
3. Fragments are shuffled by document and period. Those that overlap by a period are one run. Tiles
   reach as far as the next boundary, so the fragments of one run always do, and those of two runs never.

Words are numbered, not hashed. The hashes of periods are two polynomials modulo 2**31 - 1; a chance meeting
of both can open a pair, which the comparison of words closes again, or hide a run as a multiple of a smaller
period (less than 2**-60 per test).

A null, empty or blank text has no words and no runs. Each row is judged for itself: rows without id, or of
one id, are found as often as they are there. Columns other than doc_id and text play no part. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import sys
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import words
from millrace.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST_WORDS = 24
LEAST_TIMES = 3
#: Pairs of boundary and period that are compared at once.
PAIRS = 1 << 19

_MODULUS = np.uint64((1 << 31) - 1)
_BASES = (1_220_703_125, 48_271)  # of large order

_FRAGMENT = "array<struct<period: bigint, start: bigint, stop: bigint>>"
_FOUND = f"row bigint, doc_id bigint, n_words bigint, text binary, digest string, fragments {_FRAGMENT}"
_RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_COLLAPSED = f"doc_id bigint, n_words bigint, runs {_RUNS}, collapsed string, collapsed_sha256 string"


def spacing(octave: int) -> int:
    """The largest distance of boundaries at which a run of the octave has one with two periods behind it."""
    least = lambda q: max(LEAST_WORDS, LEAST_TIMES * q) - 2 * q + 1
    low, high = 1 << octave, (2 << octave) - 1
    # falls while the least number of words counts, and grows afterwards
    turn = min(max(LEAST_WORDS // LEAST_TIMES, low), high)
    return max(1, min(least(low), least(turn), least(high)))


class Hashes:
    """Equality of two ranges of numbered words, by polynomials modulo a prime."""

    def __init__(self, ids: np.ndarray):
        values = words.mix(ids.astype(np.uint64) + np.uint64(1)) % _MODULUS
        self.powers, self.sums = [], []
        for base in _BASES:
            powers = np.ones(len(ids) + 1, np.uint64)
            done, top = 1, base
            while done < len(powers):
                n = min(done, len(powers) - done)
                powers[done : done + n] = powers[:n] * np.uint64(top) % _MODULUS
                done, top = done * 2, top * top % int(_MODULUS)
            sums = np.zeros(len(ids) + 1, np.uint64)
            np.cumsum(values * powers[:-1] % _MODULUS, out=sums[1:])
            self.powers.append(powers)
            self.sums.append(sums % _MODULUS)

    def same(self, at: np.ndarray, shift: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether `length` words from `at` are those from `at + shift`."""
        out = np.ones(len(at), bool)
        for powers, sums in zip(self.powers, self.sums, strict=True):
            first = (sums[at + length] + _MODULUS - sums[at]) % _MODULUS * powers[shift] % _MODULUS
            out &= first == (sums[at + shift + length] + _MODULUS - sums[at + shift]) % _MODULUS
        return out


def _least_factors(most: int) -> np.ndarray:
    """The smallest prime factor of every number up to `most`."""
    out = np.arange(most + 1)
    for r in range(2, int(most**0.5) + 1):
        if out[r] == r:
            multiples = out[r * r :: r]
            multiples[multiples == np.arange(r * r, most + 1, r)] = r
    return out


def _open_pairs(ids: np.ndarray, firsts: np.ndarray, ends: np.ndarray, octave: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, boundary, period) of an octave whose words agree in the places looked at."""
    low, step = 1 << octave, spacing(octave)
    lengths = ends - firsts
    docs = np.flatnonzero(lengths >= max(LEAST_WORDS, LEAST_TIMES * low))
    counts = (lengths[docs] - 2 * low) // step + 1
    owner = np.repeat(docs, counts)
    boundary = firsts[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)) * step
    later = np.lib.stride_tricks.sliding_window_view(np.concatenate([ids, np.full(2 * low, -1, ids.dtype)]), low)
    tiles = max(1, PAIRS // low)
    for a in range(0, len(boundary), tiles):
        c, own = boundary[a : a + tiles], owner[a : a + tiles]
        at, q = np.nonzero(later[c + low] == ids[c, None])
        c, own, q = c[at], own[at], q + low
        whole = (c + 2 * q <= ends[own]) & (LEAST_TIMES * q <= lengths[own])
        c, own, q = c[whole], own[whole], q[whole]
        for share in (1, 2, 3):
            place = (q - 1) // share
            agree = ids[c + place] == ids[c + q + place]
            c, own, q = c[agree], own[agree], q[agree]
        if len(c):
            yield own, c, q


def _primitive(hashes: Hashes, c: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether the two periods behind a boundary have no smaller period."""
    out = np.ones(len(c), bool)
    factors = _least_factors(int(q.max(initial=1)))
    rest = q.copy()
    while len(at := np.flatnonzero(out & (rest > 1))):
        r = factors[rest[at]]
        rest[at] //= r
        shift = q[at] // r
        out[at] = ~hashes.same(c[at], shift, 2 * q[at] - shift)
    return out


def _agreement(ids: np.ndarray, c: int, q: int, low: int, high: int) -> tuple[int, int]:
    """First and last + 1 place around c, between low and high, where words and words q later agree throughout."""
    right = np.flatnonzero(ids[c:high] != ids[c + q : high + q])
    left = np.flatnonzero(ids[low:c] != ids[low + q : c + q])
    return (low + int(left[-1]) + 1 if len(left) else low), (c + int(right[0]) if len(right) else high)


def fragments(ids: np.ndarray, firsts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(document, period, start, stop) of every tile's part of a run; documents are ranges of `ids`."""
    longest = int((ends - firsts).max(initial=0))
    hashes, octave = None, 0
    while max(LEAST_WORDS, LEAST_TIMES << octave) <= longest:
        reach = max(spacing(octave), 2 << octave)
        for own, c, q in _open_pairs(ids, firsts, ends, octave):
            hashes = hashes or Hashes(ids)
            same = hashes.same(c, q, q)
            own, c, q = own[same], c[same], q[same]
            first = _primitive(hashes, c, q)
            for doc, at, period in zip(own[first].tolist(), c[first].tolist(), q[first].tolist(), strict=True):
                low, high = max(int(firsts[doc]), at - reach), min(int(ends[doc]) - period, at + period + reach)
                start, stop = _agreement(ids, at, period, low, high)
                if stop >= at + period:
                    yield doc, period, start - int(firsts[doc]), stop + period - int(firsts[doc])
        octave += 1


def _numbered(texts: list[list[bytes]]) -> np.ndarray:
    names: dict[bytes, int] = defaultdict(count().__next__)
    total = sum(map(len, texts))
    return np.fromiter((names[w] for own in texts for w in own), np.int32, total)


def _tiles(with_text: bool):
    """Each document with the fragments of its tiles; without any, and if the text is not asked for, its digest instead."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.list_(pa.struct([(n, pa.int64()) for n in ("period", "start", "stop")]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), words.utf8(b.column(2)), strict=True))
        for chunk in words.in_chunks(rows, 2):
            texts = [r[2].split() for r in chunk]
            ends = np.cumsum([len(t) for t in texts])
            firsts = ends - [len(t) for t in texts]
            found: list[list[dict]] = [[] for _ in chunk]
            for doc, period, start, stop in fragments(_numbered(texts), firsts, ends):
                found[doc].append({"period": period, "start": start, "stop": stop})
            out = []
            for (row, doc, text), own, parts in zip(chunk, texts, found, strict=True):
                plain = not with_text and not parts
                digest = hashlib.sha256(b" ".join(own)).hexdigest() if plain else None
                out.append((row, doc, len(own), None if plain else text, digest, parts))
            arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "doc_id", "n_words", "text", "digest", "fragments"])

    return run


def stitched(found: DataFrame) -> DataFrame:
    """(row, period, start, stop) of runs from fragments (row, period, start, stop)."""
    ordered = Window.partitionBy("row", "period").orderBy("start", "stop")
    reached = F.max("stop").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.col("start") > reached - F.col("period"), F.lit(True))
    numbered = found.withColumn("apart", apart).withColumn("run", F.sum(F.col("apart").cast("bigint")).over(ordered))
    runs = numbered.groupBy("row", "period", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    length = F.col("stop") - F.col("start")
    return runs.where(length >= F.greatest(F.lit(LEAST_WORDS), LEAST_TIMES * F.col("period"))).drop("run")


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of a text when of each run only the first period stays."""
    for batch in batches:
        out = []
        for text, runs in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            own = text.split()
            if runs:
                depth = np.zeros(len(own) + 1, np.int64)
                for r in runs:
                    depth[r["start"] + r["period"]] += 1
                    depth[r["start"] + r["length"]] -= 1
                own = [own[i] for i in np.flatnonzero(np.cumsum(depth)[:-1] == 0)]
            out.append(b" ".join(own))
        collapsed = pa.array(out, pa.binary()).cast(pa.string())
        digests = pa.array([hashlib.sha256(t).hexdigest() for t in out], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], batch.column(3), collapsed, digests], names=["doc_id", "n_words", "runs", "collapsed", "collapsed_sha256"])


def find_runs(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period, by start, then period), collapsed, collapsed_sha256.

    `collapsed` is the text without those words that some run repeats, joined by one space; it is there
    only `with_text`.
    """
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = cut_lineage(texts.mapInArrow(_tiles(with_text), _FOUND))
    parts = found.where(F.size("fragments") > 0).select("row", F.explode("fragments").alias("f")).select("row", "f.*")
    run = F.struct("start", (F.col("stop") - F.col("start")).alias("length"), "period").alias("run")
    runs = stitched(parts).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "period", run))).alias("runs"))
    runs = runs.select("row", F.col("runs.run").alias("runs"))
    listed = found.where("text is not null").join(runs, "row", "left").select("doc_id", "n_words", "text", "runs")
    listed = listed.withColumn("runs", F.coalesce("runs", F.array().cast(_RUNS))).mapInArrow(_collapse, _COLLAPSED)
    if with_text:
        return listed
    plain = found.where("text is null").select("doc_id", "n_words", F.array().cast(_RUNS).alias("runs"), F.col("digest").alias("collapsed_sha256"))
    return listed.drop("collapsed").union(plain)


def report(found: DataFrame) -> DataFrame:
    """How many runs a text has, the one repeated most often (ties: smallest start, then period), and digests."""
    better = lambda most, r: F.coalesce(r["length"] * most["period"] > most["length"] * r["period"], F.lit(True))
    most = F.reduce("runs", F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), lambda m, r: F.when(better(m, r), r).otherwise(m))
    line = lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    exponent = F.floor(1000 * F.col("most.length") / F.col("most.period")).alias("exponent_milli")
    return found.withColumn("most", most).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "most.start", "most.length", "most.period", exponent,
        F.sha2(lines, 256).alias("runs_sha256"), "collapsed_sha256",
    )
