"""Draining a stream into tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_path


def drain(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Run over all available input and return the rows the stream has emitted.

    append writes files directly; update and complete keep each micro-batch in its own folder,
    seen as ``batch_id`` in the result.
    """
    spark = stream.sparkSession
    out, checkpoint = scratch_path(spark, f"{label}-out"), scratch_path(spark, f"{label}-state")
    schema = stream.schema
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        query = writer.outputMode("append").format("parquet").start(out)
        query.awaitTermination()
        return spark.read.schema(schema).parquet(out)
    query = writer.outputMode(mode).foreachBatch(batch_folders(out)).start()
    query.awaitTermination()
    return read_batches(spark, out, schema)


def drain_until(
    stream: DataFrame, ts: str, delay: str, until: Column, build: Callable[[DataFrame], DataFrame], label: str
) -> DataFrame:
    """Run ``build(stream)`` over all available input, then move the watermark on to ``until``.

    A stream that has come to its end never passes its last rows by itself: the watermark stays the delay
    behind them. So the query is started twice from one checkpoint. The second time a closing mark comes
    in beside the stream, ``delay`` after ``until``; it moves the watermark and goes no further.
    """
    spark = stream.sparkSession
    out, checkpoint, marks = (scratch_path(spark, f"{label}-{p}") for p in ("out", "state", "marks"))
    rows = stream.withColumn("__mark", F.lit(False))
    spark.createDataFrame([], rows.schema).write.parquet(marks)
    ends = spark.readStream.schema(rows.schema).parquet(marks)
    # a condition on the time as well (never true of a mark) keeps the filter above the watermark
    unmarked = ~F.col("__mark") | (F.col(ts) < F.lit("0001-01-01").cast("timestamp"))
    built = build(rows.unionByName(ends).withWatermark(ts, delay).where(unmarked).drop("__mark"))

    def go() -> None:
        writer = built.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        writer.outputMode("append").format("parquet").start(out).awaitTermination()

    go()
    mark = [F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema if f.name != ts]
    at = (until.cast("timestamp") + F.expr(f"interval {delay}")).alias(ts)
    spark.range(1).select(*mark, at, F.lit(True).alias("__mark")).write.mode("append").parquet(marks)
    go()
    return spark.read.schema(built.schema).parquet(out)


def batch_folders(path: str):
    """Sink that is idempotent per micro-batch: a replayed batch replaces its own folder."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(_with_batch(schema)).parquet(path)


def _with_batch(schema):
    from pyspark.sql.types import LongType, StructField, StructType

    return StructType([*schema.fields, StructField("batch_id", LongType())])


def each_batch(stream: DataFrame, label: str, handle, checkpoint: str | None = None) -> None:
    """Run ``handle(df, batch_id)`` over all available input; an exception fails the query.

    With the ``checkpoint`` of an earlier run it goes on where that run has stopped. Offsets are committed after the handler has returned, so a failed batch is replayed as it was.
    """
    checkpoint = checkpoint or scratch_path(stream.sparkSession, f"{label}-state")
    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(handle)
        .start()
    )
    query.awaitTermination()
