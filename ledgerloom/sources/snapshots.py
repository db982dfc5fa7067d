"""Ledger tables as numbered Parquet snapshots.

A table is a folder of ``snapshot=N`` folders, each holding ``part=K`` folders:
part 0 is what was published, the further ones what was appended to it. A part
counts once Spark has committed it (it holds ``_SUCCESS``); the newest snapshot
with a committed part 0 is the table. A change writes the next snapshot, an
addition the next part. The path being read is therefore never overwritten, a
job that dies leaves the table as it was, and rolling back means not publishing.
The exception is ``replace``, which rewrites some partitions of a large table in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class SnapshotTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _numbers(self, path: str, key: str, committed: bool = False) -> list[int]:
        """N of the ``key=N`` folders in a folder."""
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        if not fs.exists(folder):
            return []
        numbers = []
        for entry in fs.listStatus(folder):
            name, _, number = entry.getPath().getName().partition("=")
            marker = jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")
            if name == key and (not committed or fs.exists(marker)):
                numbers.append(int(number))
        return sorted(numbers)

    def _snapshot(self, table: str, number: int) -> str:
        return f"{self.root}/{table}/snapshot={number}"

    def current(self, table: str) -> int | None:
        for number in reversed(self._numbers(f"{self.root}/{table}", "snapshot")):
            if 0 in self._numbers(self._snapshot(table, number), "part", committed=True):
                return number
        return None

    def extent(self, table: str) -> tuple[int, int]:
        """The current snapshot and its last committed part."""
        number = self.current(table)
        if number is None:
            raise LookupError(f"table {table} has no committed snapshot under {self.root}")
        return number, self._numbers(self._snapshot(table, number), "part", committed=True)[-1]

    def read(self, table: str, schema: T.StructType | None = None,
             extent: tuple[int, int] | None = None, after: int = -1) -> DataFrame:
        """The table, or the parts that follow ``after`` up to an ``extent`` seen earlier."""
        number, last = extent or self.extent(table)
        folder = self._snapshot(table, number)
        parts = [f"{folder}/part={k}" for k in self._numbers(folder, "part", committed=True)
                 if after < k <= last]
        reader = self.spark.read.option("basePath", folder)
        if schema is None:
            return reader.parquet(*parts).drop("part")
        return reader.schema(schema).parquet(*parts).select(*schema.names)

    def publish(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
        """Make ``df`` the table. It may read the snapshot it replaces."""
        taken = self._numbers(f"{self.root}/{table}", "snapshot")
        number = taken[-1] + 1 if taken else 1
        self._write(df, f"{self._snapshot(table, number)}/part=0", partition_by)
        return number

    def append(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
        """Add rows to the current snapshot without rewriting what it holds."""
        number = self.current(table)
        if number is None:
            return self.publish(table, df, partition_by)
        folder = self._snapshot(table, number)
        part = self._numbers(folder, "part")[-1] + 1
        self._write(df, f"{folder}/part={part}", partition_by)
        return number

    def replace(self, table: str, df: DataFrame, partition_by: str, emptied: Sequence = ()) -> None:
        """Make ``df`` the content of the partitions it has rows for, and remove the ``emptied`` ones.

        ``df`` must not read the table. The files of other partitions are left alone, so
        nothing but the change is written. Spark moves the new files in when all of them are
        written; a job that dies before has changed nothing, and one that dies while it
        moves them is repeated. Readers that began before have to begin again.
        """
        number, last = self.extent(table)
        if last:
            raise ValueError(f"{table} has appended parts: publish it whole")
        path = f"{self._snapshot(table, number)}/part=0"
        self._write(df, path, [partition_by], "overwrite", partitionOverwriteMode="dynamic")
        for value in emptied:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{partition_by}={value}")
            conf = self.spark._jsparkSession.sessionState().newHadoopConf()
            folder.getFileSystem(conf).delete(folder, True)

    @staticmethod
    def _write(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "errorifexists",
               **options: str) -> None:
        if partition_by:
            # Rows of a partition meet in one task, or in several where they are many.
            df = df.hint("rebalance", *partition_by)
        writer = df.write.mode(mode).options(**options)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
