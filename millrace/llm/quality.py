"""Choice of documents by importance resampling on hashed n-grams.

A text is cut into runs of word bytes and runs of other signs; each such token and each pair of
neighbours is hashed into `BUCKETS` buckets. Two generative models are bucket frequencies: of the raw
corpus (all documents) and of the target (documents labelled as good). A document is summed up by the mean
of log target - log raw over its n-grams, so that long texts are not judged by their length. Its importance
is the odds of being a target document at that mean: a line fitted to the labelled sample by logistic
regression, with smoothed labels, so that cleanly parted samples too give finite odds.

Adding Gumbel noise to log importances and taking the k largest draws k documents without replacement
in proportion to their importances. Unless the caller gives k, it is the expected number of target documents of the
whole corpus, the sum of the odds' probabilities over all documents. So documents of clear quality are as good
as certain to stay or go, and the noise decides about those in between; another seed draws others.
The noise is a function of the seed and the document, not of the run. The k-th largest key is found
by counting its leading bits, round by round, over all documents.

The labelled sample is bounded by `LABELLED` ids (those of the smallest hash of the id; the rows of an id
count as one, by their average); raw counts, importances and the choice cover every document. Null is the
empty text. A text without n-grams gives nothing to judge by and stays, outside of the draw. Rows without id get
their noise from the text; rows of one id have the same noise. Equal keys at the end of the draw (repeated
rows) all stay. Without labels of both sorts nothing can be told apart and every row stays. Columns other
than doc_id and text are carried along, whatever their names.
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
from pyspark.sql import types as T

from millrace.llm import words
from millrace.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 14
LABELLED = 50_000
#: Counts are smoothed by this many of the corpus's average bucket.
_SMOOTHING = 0.01

_KINDS = np.full(256, 2, np.uint8)
_KINDS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KINDS[list(words.WHITE_SPACE)] = 0


def _grams(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The buckets of all unigrams and bigrams of each text."""
    hashes, counts = words.hashed_words(texts, _KINDS)
    ones = (hashes % np.uint64(BUCKETS)).astype(np.int64)
    twos = (words.window_hashes(hashes, 2) % np.uint64(BUCKETS)).astype(np.int64)
    twos[hashes[1:] == hashes[:-1]] = 0  # a token said twice is one n-gram, whatever the token
    at = 0
    for count in counts:
        yield np.concatenate([ones[at : at + count], twos[at : at + max(0, count - 1)]])
        at += count


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    rows = (r for b in batches for r in zip(b.column(0).to_pylist(), words.utf8(b.column(1)), strict=True))
    return words.in_chunks(rows, 1)


def _count(target):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for chunk in _rows(batches):
            for (doc, _), grams in zip(chunk, _grams([t for _, t in chunk]), strict=True):
                own = np.bincount(grams, minlength=BUCKETS)
                raw += own
                if doc in target.value:
                    good += own
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(good[some])], names=["bucket", "raw", "good"])

    return run


class Model:
    """Log ratios of the buckets, and the line from a document's mean log ratio to its log importance."""

    def __init__(self, ratios: np.ndarray, slope: float, offset: float):
        self.ratios, self.slope, self.offset = ratios, slope, offset


def _log_frequencies(counts: np.ndarray) -> np.ndarray:
    smoothed = counts + _SMOOTHING * max(1.0, counts.mean())
    return np.log(smoothed / smoothed.sum())


def _odds_line(means: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the log odds of being good, by Newton's method; labels are smoothed as if there were one
    more document of either sort in each."""
    ones = good.sum()
    target = np.where(good, (ones + 1) / (ones + 2), 1 / (len(good) - ones + 2))
    middle, spread = means.mean(), max(means.std(), 1e-9)
    x = np.column_stack([(means - middle) / spread, np.ones(len(means))])
    w = np.zeros(2)
    loss = lambda w: float(np.logaddexp(0, x @ w).sum() - target @ (x @ w))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2), x.T @ (p - target))
        while loss(w - step) > loss(w) and np.abs(step).max() > 1e-12:
            step /= 2
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / spread), float(w[1] - w[0] * middle / spread)


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Model | None:
    """The model, or None if the labels do not show both sorts."""
    sc = docs.sparkSession.sparkContext
    marks = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    marks = marks.agg((F.max("quality") > 0).alias("good")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled).collect()
    if len({r["good"] for r in marks}) < 2:
        return None
    target = sc.broadcast({r["doc_id"] for r in marks if r["good"]})
    texts = _numbered(docs)
    counts = texts.mapInArrow(_count(target), "bucket bigint, raw bigint, good bigint").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counts.collect():  # at most BUCKETS rows
        raw[row["bucket"]], good[row["bucket"]] = row["raw"], row["good"]
    ratios = _log_frequencies(good) - _log_frequencies(raw)
    known = docs.sparkSession.createDataFrame([(r["doc_id"], r["good"]) for r in marks], "doc_id bigint, good boolean")
    sample = texts.join(F.broadcast(known), "doc_id").select("doc_id", "text", "good")
    means = sample.mapInArrow(_means(sc.broadcast(ratios)), "doc_id bigint, good boolean, mean double")
    shown = means.groupBy("doc_id", "good").agg(F.avg("mean").alias("mean")).collect()  # at most `labelled` rows
    if len({r["good"] for r in shown}) < 2:
        return None
    shown.sort(key=lambda r: r["doc_id"])
    return Model(ratios, *_odds_line(np.array([r["mean"] for r in shown]), np.array([r["good"] for r in shown])))


def _means(ratios):
    """Mean log ratio of rows (doc_id, text, good); texts without n-grams are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(b.column(0).to_pylist(), words.utf8(b.column(1)), b.column(2).to_pylist(), strict=True))
        for chunk in words.in_chunks(rows, 1):
            out = [(doc, good, float(ratios.value[g].mean())) for (doc, _, good), g in zip(chunk, _grams([r[1] for r in chunk]), strict=True) if len(g)]
            columns = zip(*out, strict=True) if out else ((), (), ())
            kinds = (pa.int64(), pa.bool_(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "good", "mean"])

    return run


def gumbel(names: np.ndarray, seed: int) -> np.ndarray:
    """Gumbel noise of documents known by 64-bit numbers."""
    chance = words.mix(words.mix(names) ^ words.mix(np.array([seed], np.int64).view(np.uint64) + np.uint64(1)))
    even = (chance >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54
    return -np.log(-np.log(even))


def _scored(ratios, slope: float, offset: float, seed: int, text_at: int):
    """Rows (row, doc_id): the row with its log importance, number of n-grams and noise."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = words.utf8(batch.column(0).field(text_at))
            weights, sizes = [], []
            for chunk in words.in_chunks(((t,) for t in texts), 0):
                for grams in _grams([t for (t,) in chunk]):
                    weights.append(float(ratios.value[grams].mean()) * slope + offset if len(grams) else None)
                    sizes.append(len(grams))
            names = [
                int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little", signed=True) if i is None else i
                for i, t in zip(batch.column(1).to_pylist(), texts, strict=True)
            ]
            noise = gumbel(np.array(names, np.int64).view(np.uint64), seed)
            extra = [pa.array(weights, pa.float64()), pa.array(sizes, pa.int64()), pa.array(noise, pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *extra], names=["row", *_EXTRA])

    return run


_EXTRA = ("weight", "n_grams", "gumbel")


def _kth_largest(keys: DataFrame, k: int) -> int | None:
    """The k-th largest bigint of column `key`, by four rounds of counting 16 bits; None if there are fewer."""
    found, left = [], k
    for shift in (48, 32, 16, 0):
        digit = F.shiftright("key", shift).bitwiseAND(0xFFFF) if shift < 48 else F.shiftright("key", shift)
        rows = keys
        for s, d in found:
            rows = rows.where((F.shiftright("key", s).bitwiseAND(0xFFFF) if s < 48 else F.shiftright("key", s)) == d)
        counts = rows.groupBy(digit.alias("digit")).agg(F.count("*").alias("n")).collect()  # at most 65,536 rows
        for row in sorted(counts, key=lambda r: -r["digit"]):
            if left <= row["n"]:
                found.append((shift, row["digit"]))
                break
            left -= row["n"]
        else:
            return None
    return sum(d << s for s, d in found)


def _sortable(x):
    """Doubles as bigints of the same order, to a billionth."""
    return F.round(F.greatest(F.least(x, F.lit(9e9)), F.lit(-9e9)) * F.lit(1e9)).cast("bigint")


def resample(docs: DataFrame, model: Model | None, k: int | None = None, seed: int = 0) -> DataFrame:
    """The drawn rows of docs, all columns, with weight (log importance), n_grams and gumbel behind them.

    Columns of docs that have one of these names stay as they are.
    """
    ratios, line = (model.ratios, (model.slope, model.offset)) if model else (np.zeros(BUCKETS), (0.0, 0.0))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"))
    kinds = (T.DoubleType(), T.LongType(), T.DoubleType())
    schema = T.StructType([rows.schema["row"], *(T.StructField(n, t) for n, t in zip(_EXTRA, kinds, strict=True))])
    scored = rows.mapInArrow(_scored(docs.sparkSession.sparkContext.broadcast(ratios), *line, seed, docs.columns.index("text")), schema)
    if model is not None:
        scored = scored.withColumn("key", _sortable(F.col("weight") + F.col("gumbel")))
        share = F.round(1e6 / (1 + F.exp(-F.col("weight")))).cast("bigint")  # whole numbers add up alike in any order
        keys = cut_lineage(scored.where("n_grams > 0").select("key", share.alias("share")))
        if k is None:
            k = round((keys.agg(F.sum("share")).first()[0] or 0) / 1e6)
        least = _kth_largest(keys.select("key"), k) if k > 0 else (1 << 63) - 1
        if least is not None:  # else there are no more than k
            scored = scored.where((F.col("n_grams") == 0) | (F.col("key") >= least))
    return scored.select("row.*", *(n for n in _EXTRA if n not in docs.columns))
