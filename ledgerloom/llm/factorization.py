"""Document quality by a factorisation machine.

The features are hashed words, structure statistics and the length recorded for a
document. Besides a weight each feature has a low-rank vector, and the model adds
the inner products of all pairs of features. By the sum-of-squares identity,
``sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``,
that takes time linear in the features.

The fit reads at most ``fit_rows`` labelled documents. Null and empty texts are
scored like any other, from statistics that are zero. Repeated rows get equal
scores. Without labels of both kinds every score is the smoothed share of
positive ones. An empty table of documents gives an empty result. Columns other
than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.features import STATISTICS, Featurizer
from ledgerloom.llm.frames import narrow, training_rows


@dataclass(frozen=True)
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray  # features x rank
    centre: np.ndarray
    scale: np.ndarray
    buckets: int

    def prepare(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -5, 5)

    def logits(self, prepared: np.ndarray) -> np.ndarray:
        pairs = (prepared @ self.factors) ** 2 - (prepared ** 2) @ (self.factors ** 2)
        return self.bias + prepared @ self.weights + 0.5 * pairs.sum(axis=1)


def collect_features(sample: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of a bounded sample, built in tasks, and its labels."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        featurizer = Featurizer(buckets)
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at:at + 512]
                rows = featurizer(part["text"].tolist()).astype(np.float16)
                yield pd.DataFrame({"x": [r.tobytes() for r in rows],
                                    "label": part["label"].to_numpy()})

    rows = sample.mapInPandas(run, "x binary, label int").toPandas()
    width = Featurizer(buckets).width
    x = np.frombuffer(b"".join(rows.pop("x")), dtype=np.float16).reshape(-1, width)
    order = np.lexsort((x.sum(axis=1, dtype=np.float64), rows["label"].to_numpy()))
    return x[order].astype(np.float32), rows["label"].to_numpy(np.int64)[order]


def standardise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centre and scale of the statistics; word buckets keep theirs."""
    centre, scale = np.zeros(x.shape[1], np.float32), np.ones(x.shape[1], np.float32)
    if len(x):
        centre[:STATISTICS] = x[:, :STATISTICS].mean(axis=0)
        scale[:STATISTICS] = np.maximum(x[:, :STATISTICS].std(axis=0), 0.05)
    return centre, scale


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", held_out: Column | None = None, fit_rows: int = 12_000,
        buckets: int = 512, rank: int = 8, epochs: int = 12, rate: float = 0.02,
        penalty: float = 1e-4, seed: int = 5) -> Machine:
    """Adam on the logistic loss, in mini-batches over the bounded sample."""
    sample = training_rows(docs, labels, id_col, text_col, label_col, fit_rows, held_out)
    x, label = collect_features(sample.select("text", F.col("label").cast("int").alias("label")),
                                buckets)
    y = (label > 0).astype(np.float32)
    centre, scale = standardise(x)
    rng = np.random.default_rng(seed)
    width = STATISTICS + buckets
    start = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    params = {"b": np.array([start], np.float32), "w": np.zeros(width, np.float32),
              "v": rng.normal(0, 0.02, (width, rank)).astype(np.float32)}
    first = {k: np.zeros_like(p) for k, p in params.items()}
    second = {k: np.zeros_like(p) for k, p in params.items()}
    machine = Machine(start, params["w"], params["v"], centre, scale, buckets)
    x, step = machine.prepare(x), 0
    for _ in range(epochs if 0 < y.sum() < len(y) else 0):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            rows = order[at:at + 256]
            part = x[rows]
            sums = part @ params["v"]
            squares = part ** 2
            logit = (params["b"] + part @ params["w"]
                     + 0.5 * (sums ** 2 - squares @ params["v"] ** 2).sum(axis=1))
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[rows]) / len(rows)
            grads = {"b": error.sum(keepdims=True), "w": part.T @ error + penalty * params["w"],
                     "v": part.T @ (error[:, None] * sums)
                     - params["v"] * (squares.T @ error)[:, None] + penalty * params["v"]}
            step += 1
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                params[k] = params[k] - rate * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-7)
    return Machine(float(params["b"][0]), params["w"], params["v"], centre, scale, buckets)


def score_column(machine: Machine, text: str = "text") -> Column:
    """The probability of good quality."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        featurizer = Featurizer(machine.buckets)
        for texts in batches:
            logits = [machine.logits(machine.prepare(x)) for x in featurizer.batches(texts.tolist())]
            raw = np.concatenate(logits).astype(np.float64) if logits else np.empty(0)
            yield pd.Series(1 / (1 + np.exp(-np.clip(raw, -30, 30))))

    return score(F.coalesce(F.col(text), F.lit("")))


def quality(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text",
            threshold: float = 0.3) -> DataFrame:
    """``id, score, predicted`` of every row."""
    scored = narrow(docs, id_col, text_col).select("id", score_column(machine).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
