"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    decontaminate, divergence, factorization, html_text, interaction_audit, mixing, personal_data,
    quality_rules, secret_scan, simhash, spans, token_counts, toxicity, url_filter,
)
from ledgerloom.llm.frames import in_held_out_fold, session_stage
from ledgerloom.sources.snapshots import SnapshotTables

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"

# The rules, shares and names below are given values of the queries.
URL_RULES = [
    url_filter.Rule("com", "/", True), url_filter.Rule("example.com", "/en/", False),
    url_filter.Rule("www.example.com", "/en/", True), url_filter.Rule("net", "/es/", False),
    url_filter.Rule("net", "/fr/", False),
]
TARGETS = {"good": 0.95, "poor": 0.05}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the cascade's verdict of every document."""
    found = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of personal data in every document."""
    found = personal_data.find(table(spark, sf_dir, "documents"), keep=("doc_id",))
    counts = [spans.number_of(kind, F.col("spans")).alias(f"n_{kind}") for kind in personal_data.KINDS]
    every = personal_data.with_terms(F.col("spans"), F.col("terms"))
    return personal_data.all_spans(found).select(
        F.col("keep_doc_id").alias("doc_id"), *counts, F.sha2(spans.joined(F.col("spans")), 256).alias("base_sha256"),
        spans.joined(every).alias("spans"), F.size("terms").cast("long").alias("n_term"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    found = url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return (pages.select("page_id", "url", html_text.text_column("html").alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; the lexicon is learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"), held_out=in_held_out_fold())
    return (toxicity.toxicity(docs, lexicon)
            .select(F.col("id").alias("doc_id"), in_held_out_fold().alias("held_out"),
                    "score", "predicted"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of every document."""
    found = token_counts.token_counts(table(spark, sf_dir, "documents"),
                                      token_counts.sentence_pieces(VOCABULARY))
    return found.withColumnRenamed("id", "doc_id")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it contains."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"),
                                        table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"),
                        F.round("containment", 6).alias("containment"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; the model is fitted outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    machine = factorization.fit(docs, table(spark, sf_dir, "labels"), held_out=in_held_out_fold())
    return (factorization.quality(docs, machine)
            .select(F.col("id").alias("doc_id"), in_held_out_fold().alias("held_out"),
                    "score", "predicted"))


def domain_labels(labels: DataFrame) -> DataFrame:
    """The domain of each labelled document: of good or poor quality."""
    domain = F.when(F.col("quality") > 0, "good").when(F.col("quality") == 0, "poor")
    return labels.select("doc_id", domain.alias("domain"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors and the fitted rate of every document."""
    docs = table(spark, sf_dir, "documents")
    model = mixing.fit(docs, domain_labels(table(spark, sf_dir, "labels")), tuple(TARGETS), "domain")
    mixed = mixing.rates(docs, model, TARGETS)
    return mixed.select(F.col("id").alias("doc_id"), "n_tokens",
                        *[F.col("posteriors")[k].alias(f"p_{d}") for k, d in enumerate(TARGETS)],
                        "rate", mixing.copies(F.col("rate"), F.col("id")).alias("copies"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents")).rows
    return rows.select(F.col("id").alias("doc_id"), simhash.as_hex().alias("fingerprint"),
                       F.col("component").alias("component_id"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of secrets in every document, by a ledger that begins empty."""
    folder = f"{session_stage(spark).folder}/blob-ledger-{uuid.uuid4().hex[:8]}"
    ledger = secret_scan.BlobLedger(SnapshotTables(spark, folder))
    found = secret_scan.scan_versions(table(spark, sf_dir, "documents"), ledger, keep=("doc_id",))
    kinds = [rule.name for rule in secret_scan.BASE]
    base = F.filter("found", lambda s: s["kind"].isin(*kinds))
    return found.select("doc_id", *[spans.number_of(k, F.col("found")).alias(f"n_{k}") for k in kinds],
                        F.sha2(spans.joined(base), 256).alias("base_sha256"),
                        spans.joined(F.col("found")).alias("spans"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language are apart, and what terms stand out in each."""
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from each source in every order."""
    return interaction_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_quality_rules, op2_personal_data, op3_url_filter, op4_html_text, op5_toxicity,
    op6_token_counts, op7_decontaminate, op8_quality_classifier, op9_mixing, op10_simhash,
    op11_secret_scan, op12_divergence, op13_interaction_audit)}
