"""Change feeds: parsing, row images, current state, merge into a partitioned table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import computed_once, lower_keys
from millrace.operators.joins import broadcast_if_small
from millrace.session import cut_lineage
from millrace.sources.files import read_partitioned

CANAL_SCHEMA = """
    `table` string, type string, data array<map<string,string>>, database string, es bigint,
    id bigint, isDdl boolean, mysqlType map<string,string>, old array<map<string,string>>,
    pkNames array<string>, sql string, sqlType map<string,int>, ts bigint
"""
# Change types that are kept, and the table operation each one means.
OPERATIONS = {"INSERT": "upsert", "UPDATE": "upsert", "DELETE": "delete"}


def operation(kind: Column) -> Column:
    """upsert, delete, or null for every other kind of message."""
    out = F.lit(None).cast("string")
    for name, op in OPERATIONS.items():
        out = F.when(kind == name, F.lit(op)).otherwise(out)
    return out


def parse_canal(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages to (database, table, op, cdc_es, cdc_id, data); other kinds and broken JSON are dropped.

    Columns to `keep`, such as the time of a stream, come along.
    """
    message = F.from_json(F.col(value), CANAL_SCHEMA)
    parsed = computed_once(df.select(*keep, value), message, "m")
    return parsed.select(
        *keep,
        F.col("m.database").alias("database"),
        F.col("m.table").alias("table"),
        operation(F.col("m.type")).alias("op"),
        F.col("m.es").alias("cdc_es"),
        F.col("m.id").alias("cdc_id"),
        F.col("m.data").alias("data"),
    ).where(F.col("op").isNotNull() & F.col("table").isNotNull())


def of_table(parsed: DataFrame, database: str, table: str) -> DataFrame:
    return parsed.where((F.col("database") == database) & (F.col("table") == table))


def change_rows(parsed: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row per changed record: op, cdc_es, cdc_id, cdc_pos and the declared columns.

    Keys are lower-cased; text that does not cast to the declared type becomes null, and columns
    the message does not carry are null, so a batch can never change the table's schema.
    """
    rows = parsed.select("op", "cdc_es", "cdc_id", F.posexplode("data").alias("cdc_pos", "__row"))
    rows = rows.withColumn("__row", lower_keys(F.col("__row")))
    return rows.select(
        "op",
        "cdc_es",
        "cdc_id",
        "cdc_pos",
        *[F.col("__row")[c.lower()].try_cast(kind).alias(c) for c, kind in columns.items()],
    )


def rows_to_json(parsed: DataFrame) -> DataFrame:
    """One JSON text per changed record, with lower-case keys."""
    rows = parsed.select("op", "cdc_es", "cdc_id", F.explode("data").alias("__row"))
    return rows.select("op", "cdc_es", "cdc_id", F.to_json(lower_keys(F.col("__row"))).alias("json"))


def row_images(entries: DataFrame) -> DataFrame:
    """Columns of each row change: DELETE shows the image before, INSERT after, UPDATE both.

    entries: (entry_id, entry_type, event_type, before, after) with images as arrays of
    (name, value). Transaction marks are skipped. A column of an after image is ``updated`` if its
    value differs from the image before.
    """
    changes = entries.where(F.col("entry_type") == "ROWDATA")
    kind = F.col("event_type")
    images = F.filter(
        F.array(
            F.struct(
                F.lit("before").alias("image"), F.col("before").alias("cols"),
                kind.isin("DELETE", "UPDATE").alias("shown"),
            ),
            F.struct(
                F.lit("after").alias("image"), F.col("after").alias("cols"),
                kind.isin("INSERT", "UPDATE").alias("shown"),
            ),
        ),
        lambda i: i["shown"],
    )
    old = F.map_from_arrays(
        F.transform("before", lambda c: c["name"]), F.transform("before", lambda c: c["value"])
    )
    exploded = changes.select(
        "entry_id", "event_type", F.explode(images).alias("__i"), old.alias("__old")
    ).select("entry_id", "event_type", "__i.image", F.explode("__i.cols").alias("__c"), "__old")
    same = F.try_element_at(F.col("__old"), F.col("__c.name")).eqNullSafe(F.col("__c.value"))
    known = F.coalesce(F.map_contains_key(F.col("__old"), F.col("__c.name")), F.lit(False))
    return exploded.select(
        "entry_id",
        "event_type",
        "image",
        F.col("__c.name").alias("name"),
        F.col("__c.value").alias("value"),
        ((F.col("image") == "after") & ~(known & same)).alias("updated"),
    )


def precombine(changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last change of each key by sequence; max_by combines map-side."""
    rest = [c for c in changes.columns if c != key]
    row = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return changes.groupBy(key).agg(row).select(key, *[F.col(f"__row.{c}") for c in rest])


def current_rows(changes: DataFrame, key: str, order: list[str], op: str = "op") -> DataFrame:
    """Table state after all changes."""
    return precombine(changes, key, order).where(F.col(op) != "delete").drop(op)


def merge(base: DataFrame, changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Base rows that no change touches, plus the surviving changed rows."""
    last = precombine(changes, key, order)
    kept = base.join(broadcast_if_small(last.select(key)), key, "left_anti")
    upserts = last.where(F.col("op") != "delete").select(*base.columns)
    return kept.unionByName(upserts)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def merge_into(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    key: str,
    order: list[str],
    partition: str,
    columns: list[str] | None = None,
    keys_move: bool = True,
) -> None:
    """Merge changes into a partitioned parquet table, rewriting only partitions that change.

    A key is looked up in all partitions, so an update that moves the partition value removes the
    old copy; ``keys_move=False`` states that a key never changes its partition, and then only the
    partitions of the batch are read. Partitions left without rows are dropped at the end. A null
    (or empty) partition value is a partition like any other. A table that does not exist is created
    with ``columns``, by default all columns of the changes but the operation and those that start
    with ``cdc_``.
    """
    kind = changes.schema[partition].dataType
    exists = _exists(spark, path)
    base = read_partitioned(spark, path, partition, kind.simpleString()) if exists else None
    if columns is None:
        columns = base.columns if exists else [c for c in changes.columns if c != "op" and not c.startswith("cdc_")]
    value = F.col(partition)
    if kind.typeName() == "string":  # the empty text has no folder of its own
        value = F.when(value != "", value)
    last = cut_lineage(precombine(changes.withColumn(partition, value), key, order))
    upserts = last.where(F.col("op") != "delete").select(*columns)
    if not exists:
        overwrite_partitions(upserts, path, [partition])
        return

    keys = broadcast_if_small(last.select(key))
    own = last.select(F.col(partition).alias("__partition")).distinct()
    same = F.col(partition).eqNullSafe(F.col("__partition"))
    searched = base if keys_move else base.join(broadcast_if_small(own), same, "left_semi")
    # partition values, not rows: one entry per table folder
    hit = searched.select(key, partition).join(keys, key, "left_semi").select(partition)
    touched = cut_lineage(hit.unionByName(upserts.select(partition)).distinct().withColumnRenamed(partition, "__partition"))
    rewritten = (
        base.join(broadcast_if_small(touched), same, "left_semi").join(keys, key, "left_anti").unionByName(upserts)
    )
    staged = cut_lineage(rewritten)
    overwrite_partitions(staged, path, [partition])
    emptied = touched.join(staged.select(partition).distinct(), same, "left_anti")
    drop_partitions(spark, path, partition, emptied)


def overwrite_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Insert overwrite: only partitions present in df are replaced.

    The rebalance hint gathers small partitions and splits large ones at run time.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def drop_partitions(spark: SparkSession, path: str, partition: str, values: DataFrame) -> None:
    """Remove partition folders; the values are folder names, bounded by the table's layout."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for (value,) in values.toLocalIterator():
        folder = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(
            partition, None if value is None else str(value)
        )
        target = jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
        target.getFileSystem(conf).delete(target, True)


def changelog(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Retract (-) and append (+) rows that turn one keyed snapshot into the other."""
    rest = [c for c in before.columns if c != key]
    old = before.select(key, F.struct(*rest).alias("__o"))
    new = after.select(key, F.struct(*rest).alias("__n"))
    changed = old.join(new, key, "full").where(~F.col("__o").eqNullSafe(F.col("__n")))
    sides = F.array(
        F.struct(F.lit("-").alias("flag"), F.col("__o").alias("row")),
        F.struct(F.lit("+").alias("flag"), F.col("__n").alias("row")),
    )
    out = changed.select(key, F.explode(F.filter(sides, lambda s: s["row"].isNotNull())).alias("__s"))
    return out.select(F.col("__s.flag").alias("flag"), key, *[F.col(f"__s.row.{c}") for c in rest])


def group_counts(current: DataFrame, by: str) -> DataFrame:
    """Rows per group of the current state."""
    return current.groupBy(by).agg(F.count(F.lit(1)).alias("counts"))


def group_counts_from_log(log: DataFrame, by: str) -> DataFrame:
    """The same, from (+/-) rows alone: groups whose counts fall to zero disappear."""
    sign = F.when(F.col("flag") == "+", 1).otherwise(-1)
    return log.groupBy(by).agg(F.sum(sign).alias("counts")).where(F.col("counts") != 0)


def feed_schema(row: str) -> str:
    return f"op string, key string, seq bigint, before struct<{row}>, after struct<{row}>"


def decode_feed(df: DataFrame, value: str, row: str) -> DataFrame:
    """Change records (op, key, seq, before, after) from JSON; one struct per image."""
    return df.select(F.from_json(F.col(value), feed_schema(row)).alias("m")).select("m.*")
