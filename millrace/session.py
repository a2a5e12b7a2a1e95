"""Session set-up and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with AQE on; shuffle width and memory are left to the cluster."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
        "spark.ui.enabled": "false",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keyed state processors need the RocksDB provider."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)


def shared_dir(spark: SparkSession) -> str:
    """Folder named by spark.checkpoint.dir; local sessions without one get a temporary folder."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if root is None and current is not None:
        root = current
    if root is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="millrace-")
    if current is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and go on from there.

    Like a reliable checkpoint it survives the loss of executors; being columnar it is smaller and
    faster, and the planner knows its size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
