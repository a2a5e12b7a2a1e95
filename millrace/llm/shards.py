"""Shards of near equal bytes, by sampled splitters.

Records are ordered by (hash of the text, document), so copies stand together. A sample of keys,
drawn with a chance in proportion to the record's size, gives quantile boundaries; records are
partitioned into the ranges between them. A range that turns out to be overfull (a hot group of
copies, say) is subdivided at boundaries from a denser sample of its own. Exact sums of the ranges,
and running sums inside each, then place every record in the global order of bytes, and the n-th
part of that order is the n-th shard. No shard is off by more than one record's size.

Only sums of ranges (at most a few thousand rows) are handled in one task, and only boundaries pass
through the driver. All work is in DataFrame operations.

A null text has no bytes and counts one. Rows without id sort as the smallest id. Rows that are equal
in id and text share a key and get different slots. An empty table gives an empty result; other
columns are ignored. More shards than records leave shards empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.ranges import range_of
from millrace.session import cut_lineage

SHARDS = 16
RANGES = 512
SAMPLES_PER_RANGE = 16
_DENSER = 16
_ROUNDS = 4


def _sample(records: DataFrame, step: int, seed: int) -> DataFrame:
    """About one record per `step` bytes, each standing for so many bytes, or for its own if larger."""
    chance = F.pmod(F.xxhash64("hash", "key", F.lit(seed)), F.lit(1 << 40))
    # as doubles: whole numbers would overflow on records of 8 MB or samples of few records
    drawn = records.where(chance / float(1 << 40) < F.col("size") / float(step))
    return drawn.select("range", "hash", "key", F.greatest("size", F.lit(step)).alias("weight"))


def _boundaries(sample: DataFrame, width: int) -> list[tuple[int, int]]:
    """Keys at which the running weight of a range enters the next stretch of `width` bytes."""
    ordered = Window.partitionBy("range").orderBy("hash", "key")
    stretch = sample.withColumn("stretch", (F.sum("weight").over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - F.col("weight")) / width)
    before = F.lag(F.floor("stretch")).over(ordered)
    cuts = stretch.withColumn("before", before).where("before < floor(stretch)").select("hash", "key").distinct()
    return [(r["hash"], r["key"]) for r in cuts.collect()]


def _split(records: DataFrame, total: int, ranges: int) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Records with their range, subdivided until no divisible range holds twice its share."""
    width = max(1, total // ranges)
    step = max(1, width // SAMPLES_PER_RANGE)
    placed = records.withColumn("range", F.lit(0))
    splitters = sorted(set(_boundaries(_sample(placed, step, 0), width)))
    for seed in range(1, _ROUNDS + 1):
        placed = records.withColumn("range", range_of(splitters, "hash", "key"))
        full = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).where(f"bytes > {2 * width} and rows > 1")
        names = [r["range"] for r in full.select("range").collect()]
        if not names:
            break
        step = max(1, step // _DENSER)
        more = set(_boundaries(_sample(placed.where(F.col("range").isin(names)), step, seed), width))
        if more <= set(splitters):
            break
        splitters = sorted(more.union(splitters))
    return records.withColumn("range", range_of(splitters, "hash", "key")), splitters


def assign(docs: DataFrame, shards: int = SHARDS, ranges: int = RANGES) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of docs."""
    text = F.coalesce("text", F.lit(""))
    records = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("hash"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("key"),
    )
    records = cut_lineage(records)
    total = records.select(F.sum("size").alias("n")).first()["n"] or 0
    placed, _ = _split(records, total, max(ranges, shards))

    sums = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        "range",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("base_bytes"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("base_rows"),
    )
    inside = Window.partitionBy("range").orderBy("hash", "key")
    running = placed.withColumns(
        {
            "own_bytes": F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)),
            "own_rows": F.row_number().over(inside),
        }
    ).join(F.broadcast(bases), "range")  # one row per range
    middle = 2 * (F.col("base_bytes") + F.col("own_bytes")) - F.col("size")
    dealt = cut_lineage(
        running.select(
            "doc_id",
            "size",
            "text_crc32",
            F.least(F.floor(middle * shards / (2 * max(1, total))), F.lit(shards - 1)).cast("int").alias("shard"),
            (F.col("base_rows") + F.col("own_rows") - 1).alias("place"),
        )
    )
    firsts = dealt.groupBy("shard").agg(F.min("place").alias("first"))
    return dealt.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("first")).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
