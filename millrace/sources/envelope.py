"""Message envelopes (topic, partition, offset, timestamp, key, value)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.text import computed_once
from millrace.operators.joins import broadcast_if_small
from millrace.sources.tables import MAX_BYTES_PER_TRIGGER

ENVELOPE = (
    "topic string, partition int, offset bigint, timestamp timestamp, key string, value string"
)
JSON_STRICT = {"mode": "FAILFAST"}


def kafka_options(
    servers: str,
    topics: list[str],
    starting: str | dict[str, dict[int, int]] = "earliest",
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Options of a Kafka read; explicit offsets come as {topic: {partition: offset}}."""
    if not isinstance(starting, str):
        starting = json.dumps({t: {str(p): o for p, o in ps.items()} for t, ps in starting.items()})
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_kafka(spark: SparkSession, streaming: bool = True, **kwargs) -> DataFrame:
    """Needs the Kafka connector on the class path."""
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    return decode(reader.options(**kafka_options(**kwargs)).load())


def topic_rows(df: DataFrame) -> DataFrame:
    """What a topic takes: the value, and the key where there is one; rows of a key keep their order."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in ("key", "value") if c in df.columns])


def write_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """One batch of rows to a topic."""
    writer = topic_rows(df).write.format("kafka")
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def write_kafka_stream(df: DataFrame, servers: str, topic: str, checkpoint: str):
    return (
        topic_rows(df)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def read_envelope_files(spark: SparkSession, path: str, max_bytes_per_trigger: int = MAX_BYTES_PER_TRIGGER) -> DataFrame:
    """The same records as a file stream, for sources without a broker."""
    return (
        spark.readStream.schema(ENVELOPE)
        .option("maxBytesPerTrigger", max_bytes_per_trigger)
        .parquet(path)
    )


def decode(raw: DataFrame) -> DataFrame:
    """Key and value bytes as UTF-8 text."""
    return raw.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def topic_values(envelope: DataFrame) -> DataFrame:
    return envelope.select("topic", F.col("value").cast("string").alias("value"))


def to_envelope(
    df: DataFrame, topic: Column, partition: Column, offset: Column, ts: Column, key: Column, value: Column
) -> DataFrame:
    return df.select(
        topic.alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        ts.alias("timestamp"),
        key.cast("string").alias("key"),
        value.alias("value"),
    )


def json_value(df: DataFrame, columns: list[str] | None = None) -> Column:
    """A row as one JSON text."""
    return F.to_json(F.struct(*[F.col(c) for c in (columns or df.columns)]))


def parse_json(df: DataFrame, value: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejected rows): malformed text is set aside, not failed on."""
    with_corrupt = f"{schema}, _corrupt string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = computed_once(df, F.from_json(F.col(value), with_corrupt, options), "__j")
    bad = F.col("__j").isNull() | F.col("__j._corrupt").isNotNull()
    rest = [c for c in df.columns if c != value]
    good = parsed.where(~bad).select(*rest, *[F.col(f"__j.{n}").alias(n) for n in _names(schema)])
    return good, parsed.where(bad).drop("__j")


def parse_json_strict(df: DataFrame, value: str, schema: str) -> DataFrame:
    """Typed rows; malformed text or a missing field fails the query."""
    parsed = df.withColumn("__j", F.from_json(F.col(value), schema, JSON_STRICT))
    rest = [c for c in df.columns if c != value]

    def required(name: str) -> Column:
        field = F.col(f"__j.{name}")
        message = F.concat(F.lit(f"field {name} is missing: "), F.col(value))
        return F.when(field.isNull(), F.raise_error(message)).otherwise(field).alias(name)

    return parsed.select(*rest, *[required(n) for n in _names(schema)])


def _names(schema: str) -> list[str]:
    return StructType.fromDDL(schema).fieldNames()


def next_offsets(envelope: DataFrame, group: str) -> DataFrame:
    """The ledger: per topic and partition the offset to go on from."""
    return envelope.groupBy("topic", "partition").agg(
        F.lit(group).alias("group_id"), (F.max("offset") + 1).alias("offset")
    )


def save_offsets(ledger: DataFrame, new: DataFrame) -> DataFrame:
    """Replace on conflict of (topic, partition, group_id); an older offset never wins."""
    return (
        ledger.unionByName(new).groupBy("topic", "partition", "group_id").agg(F.max("offset").alias("offset"))
    )


def resume(envelope: DataFrame, ledger: DataFrame, group: str) -> DataFrame:
    """Records at or after the saved offset; partitions unknown to the ledger start at 0."""
    saved = ledger.where(F.col("group_id") == group).select(
        "topic", "partition", F.col("offset").alias("__saved")
    )
    joined = envelope.join(broadcast_if_small(saved), ["topic", "partition"], "left")
    return joined.where(F.col("offset") >= F.coalesce("__saved", F.lit(0))).drop("__saved")
