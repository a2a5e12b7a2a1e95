"""A table sorted by row key and cut into regions at sampled split points, so that scans open what they need.

    region=<n>/part-...   rows of a region, sorted by key within a file
    splits                one row per region: region, low, high (its first and last key), rows

A scan or get looks at the splits first and opens only regions that overlap it; within them the files' key
ranges let the reader skip row groups. All cells of a row stand in one region; a region that is much larger than
the others, as one row key holds it, is split into several files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

#: Keys that the split points are chosen from, for each region.
SAMPLED = 200


def split_points(df: DataFrame, key: str, regions: int) -> list[str]:
    """Up to regions - 1 keys that cut the rows into about equal parts, from a bounded sample of rows."""
    rows = df.where(F.col(key).isNotNull()).select(key)
    share = min(1.0, SAMPLED * regions / max(1, rows.count()))
    drawn = rows if share == 1.0 else rows.sample(share, seed=1)
    keys = sorted(r[0] for r in drawn.limit(2 * SAMPLED * regions).collect())
    return sorted({keys[i * len(keys) // regions] for i in range(1, regions)} - {keys[0]}) if keys else []


def with_region(df: DataFrame, key: str, points: list[str]) -> DataFrame:
    """``region``: how many split points are at or below the key; a row without key goes to the first one.

    A binary search with one projection per step, see `ordered`.
    """
    out, known = df.withColumn("region", F.lit(0)), F.array(*map(F.lit, points)) if points else None
    for bit in reversed(range(len(points).bit_length())):
        at = F.col("region") + ((1 << bit) - 1)
        reached = (at < len(points)) & (F.get(known, at) <= F.col(key))
        out = out.withColumn("region", F.col("region") + F.when(reached, 1 << bit).otherwise(0))
    return out


@dataclass(frozen=True)
class Regions:
    spark: SparkSession
    path: str
    key: str

    def write(self, df: DataFrame, regions: int = 16, points: list[str] | None = None) -> Regions:
        """Replace the table. Without split points they are sampled from the rows."""
        points = split_points(df, self.key, regions) if points is None else sorted(set(points))
        placed = with_region(df, self.key, points).hint("rebalance", "region")
        placed.sortWithinPartitions("region", self.key).write.mode("overwrite").partitionBy("region").parquet(f"{self.path}/rows")
        key = F.col(self.key)
        splits = self.spark.read.schema(StructType([*df.schema.fields, StructField("region", IntegerType())])).parquet(f"{self.path}/rows").groupBy("region")
        splits = splits.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("rows"))
        splits.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/splits")
        return self

    def splits(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/splits")

    def _rows(self, regions: list[int]) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows").where(F.col("region").isin(regions)).drop("region")

    def scan(self, start: str | None = None, stop: str | None = None) -> DataFrame:
        """Rows with start <= key < stop."""
        own, rows = F.lit(True), F.lit(True)
        if start is not None:
            own, rows = own & (F.col("high") >= start), rows & (F.col(self.key) >= start)
        if stop is not None:
            own, rows = own & (F.col("low") < stop), rows & (F.col(self.key) < stop)
        return self._rows([r["region"] for r in self.splits().where(own).select("region").collect()]).where(rows)

    def scan_prefix(self, prefix: str) -> DataFrame:
        """Rows whose keys begin so, as those of one salt do."""
        stop = prefix[:-1] + chr(ord(prefix[-1]) + 1) if prefix else None
        return self.scan(prefix or None, stop)

    def get(self, keys: DataFrame) -> DataFrame:
        """All rows of some keys (a column of the key's name); opens only regions that can hold one."""
        asked = keys.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        held = F.col(self.key).between(F.col("low"), F.col("high"))
        own = [r["region"] for r in asked.join(F.broadcast(self.splits()), held).select("region").distinct().collect()]
        return self._rows(own).join(asked, self.key, "left_semi")
