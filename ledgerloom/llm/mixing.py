"""Document rates that mix soft domains to target weights.

A softmax classifier, fitted on a labelled table, gives every document a
probability of each domain. A document of w tokens sampled at rate r adds
``r * w * p_k`` expected tokens to domain k. The rates minimise the squared distance
between those totals and the targets over all rates >= 0, and among the rates that do so they
are the nearest to one (by a small ``ridge``), so documents differ from that only as
the targets ask. That is a projected gradient whose steps add up before they are
projected: every pass is one aggregate over all documents that gives K residuals and
``M = sum w p p^T`` over the rows whose rate is positive; ``l <- l + s (M + ridge)^-1 gradient``, with
a step s that is halved until the distance falls; and the rate beside each row is
``max(0, 1 - p . l)``. Only the sums of a pass reach the driver.

Targets are weights; their sum is scaled to ``budget`` times the tokens there are.
Targets that no rates meet, such as those of a domain without any expected tokens, are
approached as far as rates can; ``fit_rates`` tells what is left.
Null and empty texts have no tokens, and rates by their posteriors alone. Repeated
rows get equal rates. An empty table gives an empty result; without labels all
domains are equally probable.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.factorization import collect_features, standardise
from ledgerloom.llm.features import Featurizer
from ledgerloom.llm.frames import training_rows, written


@dataclass(frozen=True)
class DomainModel:
    domains: tuple[str, ...]
    weights: np.ndarray  # features + 1 x domains
    centre: np.ndarray
    scale: np.ndarray
    buckets: int

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        return softmax(prepared(x, self.centre, self.scale), self.weights)


def prepared(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features, in the memory of ``x``."""
    x -= centre
    x /= scale
    return np.clip(x, -5, 5, out=x)


def softmax(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    logits = x @ weights[:-1] + weights[-1]
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, labels: DataFrame, domains: tuple[str, ...], domain_col: str,
        id_col: str = "doc_id", text_col: str = "text", fit_rows: int = 8_000,
        buckets: int = 2048, steps: int = 200, rate: float = 1.0, penalty: float = 1e-3) -> DomainModel:
    """Softmax regression on at most ``fit_rows`` labelled documents, by full gradients."""
    known = labels.where(F.col(domain_col).isin(*domains))
    sample = training_rows(docs, known, id_col, text_col, domain_col, fit_rows, None)
    number = F.array_position(F.array(*map(F.lit, domains)), F.col("label")).cast("int") - 1
    x, label = collect_features(sample.select("text", number.alias("label")), buckets)
    centre, scale = standardise(x)
    # The driver holds the sample once.
    design = np.ones((len(x), x.shape[1] + 1), np.float32)
    design[:, :-1] = prepared(x, centre, scale)
    del x
    wanted = np.eye(len(domains), dtype=np.float32)[label]
    weights = np.zeros((design.shape[1], len(domains)), np.float32)
    moment = np.zeros_like(weights)
    for _ in range(steps if len(design) else 0):
        over = softmax(design[:, :-1], weights) - wanted
        moment = 0.9 * moment + design.T @ over / len(design) + penalty * weights
        weights = weights - rate * 0.1 * moment
    return DomainModel(domains, weights, centre, scale, buckets)


def describe(model: DomainModel, text: Column) -> Column:
    """Struct of a text's words (``tokens``) and posteriors (``p``)."""
    @F.pandas_udf("tokens bigint, p array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        featurizer = Featurizer(model.buckets)
        for texts in batches:
            rows = texts.tolist()
            p = [np.round(model.posteriors(x).astype(np.float64), 6).tolist()
                 for x in featurizer.batches(rows, 256)]
            yield pd.DataFrame({"tokens": [len(t.encode("utf-8", "replace").split()) for t in rows],
                                "p": [row for part in p for row in part]})

    # So that a filter on the rate does not describe each text a second time.
    return run.asNondeterministic()(F.coalesce(text, F.lit("")))


def rate_at(moved: list[float], p: Column) -> Column:
    """A document's rate where the gradients add up to ``moved``, a number for each domain."""
    if not moved:
        return F.lit(1.0)
    product = F.zip_with(p, F.array(*map(F.lit, moved)), lambda a, b: a * b)
    return F.greatest(F.lit(0.0), 1.0 - F.aggregate(product, F.lit(0.0), lambda total, x: total + x))


def weighted_sums(table: DataFrame, moved: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
    """Over all rows: tokens, tokens * rate^2, tokens * rate * p, and of the rows with a positive
    rate tokens * p p^T. Every task adds up its rows first."""
    k = len(moved)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = np.zeros(2 + k + k * k)
        for batch in batches:
            if len(batch):
                tokens, p = batch["tokens"].to_numpy(float), np.stack(batch["p"].to_numpy())
                rate = np.maximum(0.0, 1.0 - p @ moved)
                held = np.where(rate > 0, tokens, 0.0)
                found += np.concatenate([[tokens.sum(), (tokens * rate * rate).sum()], p.T @ (rate * tokens),
                                         ((p * held[:, None]).T @ p).ravel()])
        yield pd.DataFrame({"cell": np.arange(len(found), dtype=np.int32), "value": found})

    cells = {r.cell: r.value for r in table.select("tokens", "p").mapInPandas(run, "cell int, value double")
             .groupBy("cell").agg(F.sum("value").alias("value")).collect()}
    sums = np.array([cells.get(j, 0.0) for j in range(2 + k + k * k)])
    return float(sums[0]), float(sums[1]), sums[2:2 + k], sums[2 + k:].reshape(k, k)


@dataclass(frozen=True)
class RateFit:
    """The sum of the gradients; what each domain has more than its target, as a share of all
    tokens; and the number of passes over the rows."""
    moved: list[float]
    residual: np.ndarray
    passes: int


def fit_rates(table: DataFrame, targets: list[float], budget: float = 1.0, ridge: float = 1e-6,
              tolerance: float = 1e-6, limit: int = 200) -> RateFit:
    """The projected gradient for ``tokens, p`` rows.

    Ends at the least squared distance, where what is left of the gradient is at most ``tolerance``
    of all tokens. More than ``limit`` passes over the rows are an error.
    """
    k = len(targets)
    moved = np.zeros(k)
    every, squares, expected, active = weighted_sums(table, moved)
    if not every:
        return RateFit([], np.zeros(k), 1)
    goal = np.array(targets, dtype=float) / sum(targets) * every * budget
    ridge, passes = ridge * every, 1

    def dual(at: np.ndarray, squares: float) -> float:
        """The dual of the distance, which every step lowers; its slope is minus the gradient."""
        return float(0.5 * squares + at @ goal + 0.5 * ridge * at @ at)

    while True:
        gradient = expected - goal - ridge * moved
        if np.abs(gradient).max() <= tolerance * every:
            return RateFit(moved.tolist(), (expected - goal) / every, passes)
        direction = np.linalg.solve(active + ridge * np.eye(k), gradient)
        size, here = 1.0, dual(moved, squares)
        while True:
            if passes >= limit:
                raise RuntimeError(f"rates did not settle in {limit} passes")
            # Digits that the order of summation could change are cut off.
            there = np.array([float(f"{x:.12g}") for x in moved + size * direction])
            _, squares, expected, active = weighted_sums(table, there)
            passes += 1
            if dual(there, squares) <= here - 1e-4 * size * (gradient @ direction):
                break
            size /= 2
        moved = there


def free_name(columns: list[str], name: str) -> str:
    """``name``, with as many underscores after it as make it new among the columns."""
    while name in columns:
        name += "_"
    return name


def mix(docs: DataFrame, model: DomainModel, targets: dict[str, float], budget: float = 1.0,
        text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``posteriors`` (by domain, in the model's order) and ``rate``.

    A column of ``docs`` that has one of these names stays; the new one gets an underscore
    more. Each text is read once: its description is written beside its row.
    """
    mark = free_name(docs.columns, "mix")
    described = written(docs.withColumn(mark, describe(model, F.col(text_col))), "mixing-docs")
    fitted = fit_rates(described.select(f"{mark}.*"), [targets.get(d, 0.0) for d in model.domains], budget)
    p = F.col(mark)["p"]
    new = {"n_tokens": F.col(mark)["tokens"], "posteriors": p, "rate": F.round(rate_at(fitted.moved, p), 6)}
    return described.select(*[F.col(f"`{c}`") for c in docs.columns],
                            *[value.alias(free_name(docs.columns, name)) for name, value in new.items()])


def rates(docs: DataFrame, model: DomainModel, targets: dict[str, float], budget: float = 1.0,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, posteriors, rate`` of every row; each text is read once."""
    described = docs.select(F.col(id_col).alias("id"), describe(model, F.col(text_col)).alias("d"))
    table = written(described.select("id", "d.tokens", "d.p"), "mixing")
    fitted = fit_rates(table, [targets.get(d, 0.0) for d in model.domains], budget)
    return table.select("id", F.col("tokens").alias("n_tokens"), F.col("p").alias("posteriors"),
                        F.round(rate_at(fitted.moved, F.col("p")), 6).alias("rate"))


def copies(rate: Column, key: Column, seed: int = 0) -> Column:
    """How often to take a row: the rate's whole part, once more with the rest's probability."""
    chance = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1_000_000)) / 1_000_000
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("int")).cast("int")
