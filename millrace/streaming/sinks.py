"""Micro-batch sinks. Each one is safe to replay: what a batch writes depends on its id only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from millrace.operators import cdc
from millrace.operators.joins import last_per_key
from millrace.operators.ordered import row_numbers
from millrace.operators.routing import quarantine
from millrace.sources import jdbc
from millrace.sources.envelope import next_offsets
from millrace.streaming.run import batch_folders

Handler = Callable[[DataFrame, int], None]


def has_files(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def upsert_sink(path: str, key: str, order: list[str]) -> Handler:
    """Keyed table, merged on read: a batch writes the last row of each of its keys and no more."""
    write = batch_folders(path)
    return lambda df, batch_id: write(last_per_key(df, [key], order), batch_id)


def read_upserts(spark: SparkSession, path: str, key: str, order: list[str]) -> DataFrame:
    """The current row of each key over all batches."""
    return last_per_key(spark.read.parquet(path).drop("batch_id"), [key], order)


def counter_sink(path: str, key: str, count: str) -> Handler:
    """Running totals per key: a batch writes its own sums, readers add them up."""
    write = batch_folders(path)
    return lambda df, batch_id: write(df.groupBy(key).agg(F.sum(count).alias(count)), batch_id)


def read_counters(spark: SparkSession, path: str, key: str, count: str) -> DataFrame:
    return spark.read.parquet(path).groupBy(key).agg(F.sum(count).alias(count))


def compact(current: DataFrame, path: str) -> None:
    """Write a resolved table as the first batch of a new folder, to shorten later reads."""
    batch_folders(path)(current, -1)


def persisted(handle: Handler) -> Handler:
    """For handlers that read their batch more than once."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            handle(df, batch_id)
        finally:
            df.unpersist()

    return write


def jdbc_sink(**options) -> Handler:
    """Batched appends to a JDBC table; a replayed batch is appended again (at least once)."""
    return lambda df, batch_id: jdbc.append(df, **options)


def cdc_sink(path: str, key: str, order: list[str], partition: str) -> Handler:
    """Merge each batch of (op, ...) rows into a partitioned table; replay gives the same table."""

    def write(df: DataFrame, batch_id: int) -> None:
        if not df.isEmpty():
            cdc.merge_into(df.sparkSession, path, df, key, order, partition)

    return write


def ledger_sink(path: str, group: str, handle: Handler) -> Handler:
    """Handle the batch, then note the next offsets in the ledger under the batch id."""
    note = batch_folders(path)

    def write(df: DataFrame, batch_id: int) -> None:
        handle(df, batch_id)
        note(next_offsets(df, group), batch_id)

    return persisted(write)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows.groupBy("topic", "partition", "group_id").agg(F.max("offset").alias("offset"))


def quarantine_sink(good_path: str, bad_path: str, checks: dict[str, Column]) -> Handler:
    """Rows that fail a check go to the quarantine table with a reason; the batch goes on."""
    good_sink, bad_sink = batch_folders(good_path), batch_folders(bad_path)

    def write(df: DataFrame, batch_id: int) -> None:
        good, bad = quarantine(df, checks)
        good_sink(good, batch_id)
        bad_sink(bad, batch_id)

    return persisted(write)


def with_attempts(handle: Handler, attempts: int = 3) -> Handler:
    """Try a batch several times; the last failure is raised, so no offset is committed for it."""

    def write(df: DataFrame, batch_id: int) -> None:
        for left in reversed(range(attempts)):
            try:
                return handle(df, batch_id)
            except Exception:
                if left == 0:
                    raise

    return write


def late_router(
    on_time_path: str, late_path: str, ledger_path: str, ts: str, size: str, delay: str, lateness: str
) -> Handler:
    """Split each batch by the watermark of the batches before it, kept in a ledger by batch id.

    A streaming watermark moves between micro-batches, so all rows of a batch see the same one.
    """
    note = batch_folders(ledger_path)
    on_time, late = batch_folders(on_time_path), batch_folders(late_path)
    columns = StructType(
        [StructField("max_ts", TimestampType()), StructField("batch_id", LongType())]
    )

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        seen = None
        if has_files(spark, ledger_path):
            earlier = spark.read.schema(columns).parquet(ledger_path)
            seen = earlier.where(F.col("batch_id") < batch_id).agg(F.max("max_ts")).first()[0]
        limit = F.lit(seen) - F.expr(f"interval {delay}") - F.expr(f"interval {lateness}")
        closed = F.lit(False) if seen is None else F.window(ts, size)["end"] <= limit
        tagged = df.withColumn("__late", closed)
        on_time(tagged.where(~F.col("__late")).drop("__late"), batch_id)
        late(tagged.where("__late").drop("__late"), batch_id)
        note(df.agg(F.max(ts).alias("max_ts")), batch_id)

    return persisted(write)


_NUMBERED = "part string, n long, seen long, first long, total long, batch_id long"


def numbering_sink(path: str, ledger_path: str, part: str, order: list[str], name: str = "number") -> Handler:
    """Give every row a number that no other row of the stream has: 1, 2, 3, ... without gaps.

    Batches follow each other, and within a batch the source's partitions, each in its order. What each
    partition had before is kept in a ledger by batch id: `n` rows in the batch, `seen` in all, `first` the numbers given
    away before its own, `total` those after the whole batch. So a replayed batch gives the same numbers,
    and a batch reads the last ledger entries only, one for each partition.
    """
    note, write_rows = batch_folders(ledger_path), batch_folders(path)

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        before, total = None, 0
        if has_files(spark, ledger_path):
            earlier = spark.read.schema(_NUMBERED).parquet(ledger_path).where(F.col("batch_id") < batch_id)
            before = earlier.groupBy("part").agg(F.max("seen").alias("before"))
            total = earlier.agg(F.max("total")).first()[0] or 0
        counts = df.groupBy(F.col(part).cast("string").alias("part")).agg(F.count(F.lit(1)).alias("n"))
        counts = counts.join(before, "part", "left") if before is not None else counts.withColumn("before", F.lit(None).cast("long"))
        # one row per partition of the source
        until = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
        whole = F.sum("n").over(Window.partitionBy(F.lit(0)))
        placed = counts.select(
            "part", "n", (F.coalesce("before", F.lit(0)) + F.col("n")).alias("seen"), (until - F.col("n") + total).alias("first"), (whole + total).alias("total")
        )
        note(placed, batch_id)
        own = spark.read.schema(_NUMBERED).parquet(f"{ledger_path}/batch_id={batch_id}").select(F.col("part").alias("__part"), "first")
        ranked = row_numbers(df, [part], order, "__rank")
        numbered = ranked.join(F.broadcast(own), F.col(part).cast("string").eqNullSafe(F.col("__part")))
        write_rows(numbered.withColumn(name, F.col("first") + F.col("__rank")).drop("__rank", "__part", "first"), batch_id)

    return persisted(write)


def read_partition_counts(spark: SparkSession, ledger_path: str) -> DataFrame:
    """How many rows each partition of the source has had."""
    return spark.read.schema(_NUMBERED).parquet(ledger_path).groupBy("part").agg(F.max("seen").alias("seen"))
