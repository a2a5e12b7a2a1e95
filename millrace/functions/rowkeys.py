"""Salted row keys of wide-column tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def string_hash(c: Column) -> Column:
    """31-polynomial hash over UTF-16 code units, modulo 2^32 as a non-negative bigint."""
    # the text is encoded once and bound to `h`; each place then reads its own four digits
    def code_units(h: Column) -> Column:
        places = F.sequence(F.lit(1), F.length(h), F.lit(4))
        return F.transform(places, lambda i: F.conv(F.substring(h, i, F.lit(4)), 16, 10).cast("long"))

    units = F.get(F.transform(F.array(F.hex(F.encode(c, "UTF-16BE"))), code_units), 0)
    folded = F.aggregate(
        units, F.lit(0).cast("long"), lambda acc, u: F.pmod(acc * 31 + u, F.lit(4294967296))
    )
    return F.when(F.length(c) == 0, F.lit(0).cast("long")).otherwise(folded)


def salted_row_key(c: Column, regions: int) -> Column:
    """Four-digit region prefix from the hash, then 12 characters of the md5."""
    bucket = (string_hash(c).bitwiseAND(F.lit(2147483647).cast("long"))) % regions
    return F.concat(F.lpad(bucket.cast("string"), 4, "0"), F.substring(F.md5(c), 1, 12))


def split_points(spark, regions: int) -> DataFrame:
    """Upper bound ``0000|``, ``0001|``, ... of each region."""
    return spark.range(regions).select(
        F.col("id").alias("region"),
        F.concat(F.lpad(F.col("id").cast("string"), 4, "0"), F.lit("|")).alias("split_point"),
    )


def region_of(row_key: Column) -> Column:
    return F.substring(row_key, 1, 4).cast("int")


def prefix_balance(df: DataFrame, row_key: str) -> DataFrame:
    """Rows per region prefix."""
    return df.groupBy(F.substring(F.col(row_key), 1, 4).alias("prefix")).agg(
        F.count(F.lit(1)).alias("n")
    )


def write_regions(df: DataFrame, row_key: str, path: str, files: int) -> None:
    """Range-partitioned and sorted, so that key ranges and prefixes prune row groups."""
    df.repartitionByRange(files, row_key).sortWithinPartitions(row_key).write.parquet(path)
