"""A training corpus from ``documents``: five filters and edits, one after the other.

Every stage takes all that the one before kept, and its result is written as
Parquet and read again for the next. Executors and their Python workers live through all of
them, so the stages send texts to Python in batches of bounded size.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, mixing, personal_data, simhash, toxicity
from ledgerloom.llm.frames import bound_batches, in_held_out_fold
from ledgerloom.llm.queries import TARGETS, domain_labels, table
from ledgerloom.sources.scratch import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_bounded_batches(stage: Stage) -> Stage:
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)
    return run


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose toxicity is one half or more.

    The lexicon is learned from the labelled rows of the table as it came.
    """
    lexicon = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                           held_out=in_held_out_fold())
    return toxicity.drop_toxic(docs, lexicon)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that contain a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and what reveals it replaced; ``n_chars`` follows the text."""
    safe = personal_data.sanitise(docs)
    return safe.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn at least once, with their rate and number of copies."""
    labels = domain_labels(table(spark, sf_dir, "labels"))
    model = mixing.fit(docs, labels, tuple(TARGETS), "domain")
    mixed = mixing.mix(docs, model, TARGETS)
    rate, copies, posteriors = (mixing.free_name(docs.columns, c) for c in ("rate", "copies", "posteriors"))
    drawn = mixed.withColumn(copies, mixing.copies(F.col(rate), F.col("doc_id")))
    return drawn.where(F.col(copies) > 0).drop(posteriors)


STAGES = [(name, in_bounded_batches(stage)) for name, stage in (
    ("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated), ("personal_data", sanitise), ("mixing", mix))]

# The stages are classifiers, hashes and iterations, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is a table in the shared folder."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
