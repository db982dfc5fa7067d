"""What the operators share: narrow inputs, written results, bounded samples, words."""

from __future__ import annotations

import atexit
import math

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.scratch import Stage

MAX_CACHED_WORDS = 500_000
# Hashes are cheap to make again; a task keeps some 8 MB of them.
MAX_CACHED_HASHES = 1 << 16
# A task holds a batch several times over: as vectors in the JVM, as such and as texts in Python.
BATCH_BYTES = 4 << 20

_stages: dict[str, Stage] = {}


def session_stage(spark: SparkSession) -> Stage:
    """The folder of a session's intermediate tables, discarded when the process ends."""
    app = spark.sparkContext.applicationId
    if app not in _stages:
        _stages[app] = Stage(spark)
        atexit.register(_discard, app)
    return _stages[app]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, for as long as the session lives.

    Later reads survive lost executors, and Catalyst knows the real size.
    """
    return session_stage(df.sparkSession).always(df, name)


def forget(df: DataFrame) -> None:
    """Delete the files of a ``written`` table that nothing reads any more."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def _discard(app: str) -> None:
    try:
        _stages.pop(app).discard()
    except Exception:  # the session has ended: its folder is the cluster's to clear
        pass


def bound_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Send rows to Python in batches of at most ``most`` bytes, so that long texts make short batches.

    A setting of the session, which a plan takes when it is run; no result depends on it.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, as ``id`` and ``text`` (null text: empty)."""
    return docs.select(F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def sampled(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About ``rows`` rows at most, chosen by a hash of ``key``: the same ones every time."""
    total = df.count()
    if total <= rows:
        return df
    share = math.floor(rows / total * 1_000_000)
    return df.where(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < share)


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str,
                  label_col: str, rows: int, held_out: Column | None) -> DataFrame:
    """``id, text, label`` of a bounded sample of labelled rows; exact copies count once.

    The sample is drawn from the labels before any text is read, and the fold in
    ``held_out`` never enters it.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isNotNull())
    if held_out is not None:
        known = known.where(~held_out)
    chosen = sampled(known, F.col("id"), rows).dropDuplicates(["id"])
    # The sample's size is bounded by ``rows``, so it is sent to the tasks and no text is shuffled
    # but that of the sample.
    return (narrow(docs, id_col, text_col).join(F.broadcast(chosen), "id")
            .withColumn("copy", F.xxhash64("text")).dropDuplicates(["copy", "label"])
            .drop("copy"))


def in_held_out_fold(id_col: str = "id", folds: int = 5) -> Column:
    """Whether the crc32 of the id's text is divisible by ``folds``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0


def byte_words(text: str) -> list[bytes]:
    """Words between space, tab, line feed, vertical tab, form feed and carriage return."""
    return text.encode("utf-8", "replace").split()


class WordHash(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self, modulus: int = 1 << 64):
        super().__init__()
        self.modulus = modulus

    def __missing__(self, word) -> int:
        if len(self) >= MAX_CACHED_HASHES:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word) % self.modulus
        return value

    def array(self, words, dtype=np.uint64) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype, len(words))
