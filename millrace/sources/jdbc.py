"""JDBC tables: partitioned scans, pushed-down queries, batched appends and upserts.

No query or test opens a database; these functions only hand options to Spark's JDBC source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

APPEND_BATCH = 1000  # rows per statement batch


def scan_options(
    url: str,
    table: str,
    column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    parts: int | None = None,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options of a table scan; with a numeric or time column it is read in parallel ranges."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if column is not None:
        if lower is None or upper is None or parts is None:
            raise ValueError("a partitioned scan needs lower, upper and parts")
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(parts),
        }
    return options


def query_options(url: str, query: str, **extra: str) -> dict[str, str]:
    """The database runs the query; only its result is read."""
    return {"url": url, "query": query, **extra}


def append_options(url: str, table: str, batch: int = APPEND_BATCH, **extra: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batch), **extra}


def read_table(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**scan_options(**kwargs)).load()


def read_query(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**query_options(**kwargs)).load()


def append(df: DataFrame, max_connections: int = 32, **kwargs) -> None:
    """Batched inserts; at most ``max_connections`` tasks write at a time."""
    options = append_options(**kwargs) | {"numPartitions": str(max_connections)}
    df.write.format("jdbc").options(**options).mode("append").save()
