"""Text lines, whole files, packing of small files, partition folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

TARGET_FILE_BYTES = 256 * 1024 * 1024
OPEN_COST_BYTES = 16 * 1024
# Fixed value: the folder name of a null partition.
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(path)


def whole_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, modificationTime, length, content); a file is never split."""
    reader = spark.read.format("binaryFile")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


def pack_small_files(
    spark: SparkSession, path: str, target: str, glob: str | None = None, target_bytes: int = TARGET_FILE_BYTES
) -> None:
    """Many small files into few parquet files of (path, content), in one pass without a shuffle.

    Spark combines whole files into read splits of ``target_bytes``; each split is written as one
    file. The cost assumed per opened file is lowered, else a split would hold few small files.
    """
    settings = {
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.files.openCostInBytes": str(OPEN_COST_BYTES),
        "spark.sql.files.minPartitionNum": "1",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        files = whole_files(spark, path, glob).select("path", "content")
        files.sortWithinPartitions("path").write.mode("overwrite").parquet(target)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def unpack_lines(packed: DataFrame) -> DataFrame:
    """Lines of the packed files."""
    text = F.regexp_replace(F.col("content").cast("string"), r"\n$", "")
    return packed.select("path", F.explode(F.split(text, "\n")).alias("value"))


def read_partitioned(spark: SparkSession, path: str, partition: str, kind: str | None = None) -> DataFrame:
    """A partitioned table whose partition values keep the given type (text unless named).

    Spark would otherwise infer a type from the folder names, and `01` would turn into 1.
    """
    fields = [
        StructField(f.name, _parse_type(kind or "string") if f.name == partition else f.dataType)
        for f in spark.read.parquet(path).schema.fields
    ]
    return spark.read.schema(StructType(fields)).parquet(path)


def _parse_type(ddl: str) -> DataType:
    return StructType.fromDDL(f"c {ddl}")["c"].dataType


def latest_partition(spark: SparkSession, path: str, column: str) -> str | None:
    """Greatest partition name of the first level in text order, from folder names alone; null is left out."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in folder.getFileSystem(conf).listStatus(folder)]
    values = [n[len(column) + 1 :] for n in names if n.startswith(f"{column}=")]
    values = [v for v in values if v != _NULL_PARTITION]
    if not values:
        return None
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return max(unescape(v) for v in values)


def scan_latest_partition(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Only the latest partition; the equality on the partition column prunes all others."""
    value = latest_partition(spark, path, column)
    df = read_partitioned(spark, path, column)
    return df.where(F.col(column) == F.lit(value)) if value is not None else df.limit(0)


def follow_latest_partition(
    spark: SparkSession, path: str, column: str, handle, ledger: str, every: str = "1 minute"
):
    """Look for a newer partition again and again; ``handle(df, value)`` gets each new one once.

    The last value handled is kept as a small table at ``ledger``, so a restart goes on from there. A
    crash between handling and noting hands the partition over again.
    """
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return ticks.writeStream.trigger(processingTime=every).foreachBatch(
        lambda _, __: follow_once(spark, path, column, handle, ledger)
    )


def follow_once(spark: SparkSession, path: str, column: str, handle, ledger: str) -> None:
    """Hand over the latest partition if it is newer than what the ledger holds, and note it."""
    value = latest_partition(spark, path, column)
    note = spark._jvm.org.apache.hadoop.fs.Path(f"{ledger}/_SUCCESS")
    known = note.getFileSystem(spark._jsc.hadoopConfiguration()).exists(note)
    done = spark.read.parquet(ledger).first()[0] if known else None
    if value is not None and (done is None or value > done):
        handle(scan_latest_partition(spark, path, column), value)
        spark.createDataFrame([(value,)], "value string").coalesce(1).write.mode("overwrite").parquet(ledger)
