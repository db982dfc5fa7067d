"""The pipeline's stages on a small table, and the queries' columns."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import frames, mixing
from ledgerloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_pass_on_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
    assert 0 < docs.count() <= before


def test_run(spark):
    result = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "rate", "copies"} <= set(result.columns)
    assert result.where("copies < 1 or rate <= 0").count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_return_a_row_for_each_row(spark, name):
    result = QUERIES[name](spark, SF)
    key = result.columns[0]
    if key in ("doc_id", "page_id") and name != "op7_decontaminate":
        source = "pages" if key == "page_id" else "documents"
        assert result.count() == spark.read.parquet(f"{SF}/{source}.parquet").count()


def test_stages_send_texts_to_python_in_bounded_batches(spark):
    """Of 24 texts of a megabyte a task gets a few at a time, not all."""
    @F.pandas_udf("int")
    def beside(texts: pd.Series) -> pd.Series:
        return pd.Series([len(texts)] * len(texts), dtype="int32")

    stage = corpus_pipeline.in_bounded_batches(lambda spark, docs, folder: docs.select(beside("text").alias("n")))
    docs = spark.range(24, numPartitions=1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
    try:
        counts = [r.n for r in stage(spark, docs, "").collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    assert len(counts) == 24 and max(counts) <= 5
    assert all(hasattr(stage, "__wrapped__") for _, stage in corpus_pipeline.STAGES)


def test_memory_of_words_and_of_the_sample_is_bounded():
    hashes = frames.WordHash(8)
    found = hashes.array([b"%d" % n for n in range(200_000)])
    assert len(hashes) <= 1 << 16 and found[:3].tolist() == [frames.WordHash(8)[b"%d" % n] for n in range(3)]
    x = np.array([[1.0, 9.0], [3.0, -9.0]], np.float32)
    assert mixing.prepared(x, np.float32([1, 0]), np.float32([2, 1])) is x and x.tolist() == [[0, 5], [1, -5]]
