"""Intermediate results as written tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session without that setting gets a temporary folder instead.
    """
    try:
        folder = spark.conf.get(CHECKPOINT_CONF)
    except Exception:  # the setting has no value
        folder = None
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by the executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="ledgerloom-")
    return _local_folders[context.applicationId]


class Stage:
    """Writes intermediate results to the shared folder and reads them back.

    A staged result survives the loss of executors, is computed once however
    often it is read, and is a plain file scan to Catalyst: its real size is
    known, so ``autoBroadcastJoinThreshold`` decides on facts whether a join
    against it broadcasts or shuffles.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or f"{shared_folder(spark)}/ledgerloom-{uuid.uuid4().hex}"

    def always(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df``; for results that several consumers read."""
        path = f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def discard(self) -> None:
        """Delete what this stage wrote, once nothing reads it any more."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        folder.getFileSystem(conf).delete(folder, True)


class NoStage:
    """Keeps every result lazy: one plan, sized by adaptive execution at run time.

    For inputs known to be small. A lookup that stays an aggregate inside the
    plan is not a plain shuffle, so Spark cannot split a skewed join against it.
    """

    def always(self, df: DataFrame, name: str) -> DataFrame:
        return df

    def discard(self) -> None:
        pass


LAZY = NoStage()
