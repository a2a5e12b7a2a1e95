"""A keyed table of parquet files that readers see commit by commit, with an index of its keys.

    data/txn=<name>/<partition>=<value>/part-...   files, never changed once written
    index/<name>                                   (file, slot, bits): which keys a file may hold
    log/<number>                                   (file, added, txn): what the commit added and took away

A change goes through four steps. `stage` writes data and index under the transaction's name,
`pre_commit` writes the log rows into a hidden folder, `commit` renames that folder to the next number, and
`abort` removes what an unfinished transaction has left. Readers go by the numbered folders alone, so before the
rename they see nothing of a change, and after it all of it. `recover` finishes what was pre-committed, as a
restarted job may rely on that, and aborts what was only staged. A transaction that is in the log is not run
again. The rename must be atomic and fail on an existing target, as on HDFS and local disks; there is one writer at a time.

The index tells keys apart by 64 hash bits: the high ones name the slot, lower ones a bit of the slot's
bitmap. Files are clustered by slot, so a file covers few slots, and a merge opens only files
that have a key's bit set. There is about one byte of index for each row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.cdc import precombine
from millrace.operators.joins import broadcast_if_small
from millrace.session import cut_lineage

#: Bits of a slot's bitmap, as Spark's bitmap functions have them, and keys that a slot should hold.
SLOT_BITS, SLOT_KEYS = 32_768, 4096
_LOG = "file string, added boolean, txn string"
_INDEX = "file string, slot bigint, bits binary"


@dataclass(frozen=True)
class Table:
    """Where the table is, its key, its partition column, the schema of its rows, and how many slots it has."""

    spark: SparkSession
    path: str
    key: str
    partition: str
    schema: str
    slots: int = 1024

    def _fs(self):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _names(self, folder: str) -> list[str]:
        if not self._fs().exists(self._at(folder)):
            return []
        return [s.getPath().getName() for s in self._fs().listStatus(self._at(folder))]

    # ---- reading

    def commits(self) -> list[int]:
        return sorted(int(n) for n in self._names("log") if n.isdigit())

    def _log(self) -> DataFrame | None:
        """All log rows, with the commit they belong to."""
        done = self.commits()
        if not done:
            return None
        rows = self.spark.read.schema(_LOG).parquet(*(f"{self.path}/log/{n:012d}" for n in done))
        return rows.withColumn("commit", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).cast("bigint"))

    def has(self, txn: str) -> bool:
        log = self._log()
        return log is not None and not log.where(F.col("txn") == txn).isEmpty()

    def files(self) -> list[str]:
        """The files that make up the table now: one name each, which the driver holds as any file listing."""
        log = self._log()
        if log is None:
            return []
        live = log.where("file is not null").groupBy("file").agg(F.max_by("added", "commit").alias("live"))
        return sorted(r["file"] for r in live.where("live").select("file").collect())

    def read(self, files: list[str] | None = None) -> DataFrame:
        files = self.files() if files is None else files
        wanted = [c.split()[0] for c in self.schema.split(", ")]
        if not files:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(f"{self.schema}, txn string").option("basePath", f"{self.path}/data")
        return rows.parquet(*(f"{self.path}/data/{f}" for f in files)).select(*wanted)

    # ---- the four steps

    def stage(self, rows: DataFrame, txn: str) -> list[str]:
        """Write rows and their index; the names of the new files. What an earlier attempt left is replaced."""
        wanted = [c.split()[0] for c in self.schema.split(", ")]
        self._discard(txn)
        target = f"{self.path}/data/txn={txn}"
        clustered = rows.select(*wanted).withColumn("__slot", self._slot(F.col(self.key)))
        clustered = clustered.repartitionByRange(self.partition, "__slot").sortWithinPartitions(self.partition, "__slot", self.key)
        clustered.drop("__slot").write.partitionBy(self.partition).parquet(target)
        written = self.spark.read.schema(self.schema).option("basePath", target).parquet(target)
        name = F.regexp_extract("_metadata.file_path", r"/data/(txn=.*)$", 1)
        bits = F.bitmap_construct_agg(F.bitmap_bit_position(self._bit(F.col(self.key))))
        index = written.groupBy(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("file"), self._slot(F.col(self.key)).alias("slot")).agg(bits.alias("bits"))
        index.write.parquet(f"{self.path}/index/{txn}")
        return sorted(r["file"] for r in self._index([txn]).select("file").distinct().collect())

    def pre_commit(self, txn: str, added: list[str], removed: list[str] = ()) -> None:
        """All that the commit will change, written where readers don't look."""
        rows = [(f, True, txn) for f in added] + [(f, False, txn) for f in removed] or [(None, True, txn)]
        self.spark.createDataFrame(rows, _LOG).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/log/_pending-{txn}")

    def commit(self, txn: str) -> int:
        """Make the pre-committed change the next commit of the log."""
        number = (self.commits() or [0])[-1] + 1
        if not self._fs().rename(self._at("log", f"_pending-{txn}"), self._at("log", f"{number:012d}")):
            raise RuntimeError(f"commit {number} of {txn} could not be renamed into the log")
        return number

    def abort(self, txn: str) -> None:
        """Forget a transaction that is not in the log."""
        if self.has(txn):
            raise RuntimeError(f"{txn} is committed")
        self._fs().delete(self._at("log", f"_pending-{txn}"), True)
        self._discard(txn)

    def _discard(self, txn: str) -> None:
        for parts in (("data", f"txn={txn}"), ("index", txn)):
            self._fs().delete(self._at(*parts), True)

    def recover(self) -> None:
        """After a crash: commit what was pre-committed, abort what was only staged."""
        pending = [n.removeprefix("_pending-") for n in self._names("log") if n.startswith("_pending-")]
        for txn in sorted(pending):
            whole = self._fs().exists(self._at("log", f"_pending-{txn}", "_SUCCESS"))
            (self.commit if whole and not self.has(txn) else self.abort)(txn)
        log = self._log()
        known = set() if log is None else {r["txn"] for r in log.select("txn").distinct().collect()}
        for txn in {n.removeprefix("txn=") for n in self._names("data")} - known:
            self._discard(txn)

    def run(self, txn: str, change: Callable[[], tuple[DataFrame, list[str]]]) -> None:
        """One transaction: `change` gives the new rows and the files that they take the place of."""
        if self.has(txn):
            return
        rows, removed = change()
        self.pre_commit(txn, self.stage(rows, txn), removed)
        self.commit(txn)

    # ---- the index of keys

    def _slot(self, key: Column) -> Column:
        return F.pmod(F.shiftright(F.xxhash64(key), 32), F.lit(self.slots))

    def _bit(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(SLOT_BITS))

    def _index(self, txns: list[str]) -> DataFrame:
        return self.spark.read.schema(_INDEX).parquet(*(f"{self.path}/index/{t}" for t in txns))

    def files_with(self, keys: DataFrame) -> list[str]:
        """Those of the table's files that may hold one of the keys (a column of the key's name)."""
        live = self.files()
        if not live:
            return []
        names = self.spark.createDataFrame([(f,) for f in live], "file string")
        txns = sorted({f.split("/")[0].removeprefix("txn=") for f in live})
        index = self._index(txns).join(broadcast_if_small(names), "file", "left_semi")
        key = F.col(self.key)
        asked = keys.select(self._slot(key).alias("slot"), F.bitmap_bit_position(self._bit(key)).alias("at")).distinct()
        # bits are counted from the lowest of the first byte
        byte = F.conv(F.hex(F.expr("substring(bits, cast(at div 8 as int) + 1, 1)")), 16, 10).cast("int")
        found = index.join(broadcast_if_small(asked), "slot").where(F.getbit(byte, F.pmod("at", F.lit(8)).cast("int")) == 1)
        return sorted(r["file"] for r in found.select("file").distinct().collect())

    def append(self, rows: DataFrame, txn: str) -> None:
        self.run(txn, lambda: (rows, []))

    def merge(self, changes: DataFrame, order: list[str], txn: str, op: str = "op") -> None:
        """The last change of each key takes the place of its row; a delete takes the row away.

        Only files that may hold a changed key are opened, and only they are written anew.
        """

        def change() -> tuple[DataFrame, list[str]]:
            last = cut_lineage(precombine(changes, self.key, order))
            hit = self.files_with(last.select(self.key))
            kept = self.read(hit).join(broadcast_if_small(last.select(self.key)), self.key, "left_anti")
            return kept.unionByName(last.where(F.col(op) != "delete").select(*kept.columns)), hit

        self.run(txn, change)


def slots_for(rows: int) -> int:
    """Slots of a table that will hold about so many rows."""
    return max(16, -(-rows // SLOT_KEYS))


def two_phase_sink(table: Table) -> Callable[[DataFrame, int], None]:
    """Append each micro-batch as one transaction; a replayed batch is in the log already."""
    return lambda df, batch_id: table.append(df, f"batch-{batch_id}")


def merge_sink(table: Table, order: list[str]) -> Callable[[DataFrame, int], None]:
    """Merge each micro-batch as one transaction."""
    return lambda df, batch_id: table.merge(df, order, f"batch-{batch_id}")
