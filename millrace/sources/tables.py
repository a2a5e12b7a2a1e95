"""Parquet tables, by folder and name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BYTES_PER_TRIGGER = 256 * 1024 * 1024


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stream_table(
    spark: SparkSession, sf_dir: str, table: str, max_bytes_per_trigger: int = MAX_BYTES_PER_TRIGGER
) -> DataFrame:
    """The same table as a file stream; a bounded number of bytes enters each micro-batch.

    Event-time operators in streams want TIMESTAMP, so TIMESTAMP_NTZ columns are read as UTC.
    """
    schema = load(spark, sf_dir, table).schema
    pattern = f"{sf_dir.rstrip('/')}/{table[:-1]}[{table[-1]}].parquet"
    stream = (
        spark.readStream.schema(schema)
        .option("maxBytesPerTrigger", max_bytes_per_trigger)
        .parquet(pattern)
    )
    return ntz_to_timestamp(stream)


def ntz_to_timestamp(df: DataFrame) -> DataFrame:
    names = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in names})


def timestamp_to_ntz(df: DataFrame) -> DataFrame:
    names = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in names})
