"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding undoes disguise: compatibility forms and look-alike letters of other
alphabets become Latin letters, zero-width characters go, and digits or symbols
inside a word become the letters they stand for. At the end of a word they may be
meant as such, so that word is looked up as it is and, if that finds nothing, folded. The
lexicon holds whole words and word beginnings, weighted by the lower bound of their log
odds among labelled documents. Hits inside an exception phrase do not count: given
phrases, and pairs of words with a hit that the labelled documents show to be
harmless. The weights found are summed, divided by the number of words, and mapped to a probability by a logistic
curve fitted on the same sample. A second term of the curve, the sum itself, sets
how far a long text dilutes what it says.

The fit reads at most ``fit_rows`` labelled documents. Null and empty texts have no
hits and get the score of a text without any. Without labels of both kinds nothing
tells toxic texts apart: the lexicon is empty and every score is the smoothed share
of positive labels, at most ``UNTOLD``, so that no text is rejected. Repeated rows get
equal scores. An empty table of documents gives an empty result.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.frames import narrow, training_rows

# What a character stands for, and phrases in which a word is harmless.
LOOKALIKES = str.maketrans(
    "аеорсухіјѕԁһӏтмкнвАЕОРСУХІЈЅТМКНВαοιεκρτυνη",
    "aeopcyxijsdhltmkhbaeopcyxijstmkhbaoiekptuvn",
    "​‌‍⁠﻿­")
DIGITS = str.maketrans("0134578@$!", "oieastbasi")
EXCEPTIONS = ("trash can", "trash cans", "trash bag", "trash bin", "clown fish", "class clown",
              "idiot proof", "sore loser")
PLAIN = re.compile(r"[\x00-\x7fÀ-ÿ]*")
UNTOLD = 0.25
DISGUISED = re.compile(r"[^\W\d_]*[0134578@$!][0134578@$!]*[^\W\d_]+")
LAST = re.compile(r"(?<=[^\W\d_])[0134578@$!]+(?![\w@$!])")
NO_WORD = re.compile(r"[\W_]+")


def fold(text: str) -> tuple[str, list[tuple[str, str]]]:
    """Lower-case words without disguise, a space before and after each; and words that end in
    substitutes, as they are among these and folded. Exclamation marks alone are none."""
    text = text.lower()
    if not PLAIN.fullmatch(text):
        text = unicodedata.normalize("NFKC", text).translate(LOOKALIKES)
    text = DISGUISED.sub(lambda m: m.group().translate(DIGITS), text)
    ends = []
    for found in LAST.finditer(text):
        run = found.group()
        if run.strip("!"):
            start = found.start()
            while start and text[start - 1].isalpha():
                start -= 1
            word = text[start:found.start()]
            ends.append((f" {word}{NO_WORD.sub(' ', run)}".rstrip() + " ", f" {word}{run.translate(DIGITS)} "))
    return " " + NO_WORD.sub(" ", text).strip() + " ", ends


def all_terms(text: str) -> set[str]:
    """The terms of a text's words, also of those that are folded at their ends."""
    plain, ends = fold(text)
    terms = word_terms(plain)
    for _, other in ends:
        terms |= word_terms(other)
    return terms


def word_terms(folded: str, shortest: int = 4, longest: int = 6) -> set[str]:
    """Whole words as ``" word "``, their beginnings as ``" wor"``."""
    words = set(folded.split())
    terms = {f" {w} " for w in words if len(w) > 2}
    for size in range(shortest, longest + 1):
        terms.update(" " + w[:size] for w in words if len(w) > size)
    return terms


@dataclass(frozen=True)
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...]
    slopes: tuple[float, float] = (0.0, 0.0)
    offset: float = 0.0

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (len(phrase) + 2, None))
        found.make_automaton()
        return found


Hit = tuple[int, int, float]  # first and last character, weight


def outside(hits: list[Hit], harmless: list[tuple[int, int]]) -> list[Hit]:
    """The hits that lie in none of the harmless stretches."""
    hits, harmless = sorted(hits), sorted(harmless)
    kept, k, reached = [], 0, -1
    for start, end, weight in hits:
        while k < len(harmless) and harmless[k][0] <= start:
            reached = max(reached, harmless[k][1])
            k += 1
        if end > reached:
            kept.append((start, end, weight))
    return kept


def find_hits(folded: str, automaton: ahocorasick.Automaton) -> list[Hit]:
    """Terms of the lexicon outside exception phrases."""
    hits, harmless = [], []
    for last, (size, weight) in automaton.iter(folded) if len(automaton) else ():
        (harmless.append((last - size + 1, last)) if weight is None
         else hits.append((last - size + 1, last - 1, weight)))
    return outside(hits, harmless) if harmless else hits


def measures(text: str, automaton: ahocorasick.Automaton) -> tuple[float, float]:
    """Logarithms of the hits' weight, without exception phrases: of each hundred words, of all."""
    folded, ends = fold(text)
    total = sum(weight for *_, weight in find_hits(folded, automaton))
    for plain, other in ends:
        if not find_hits(plain, automaton):
            total += sum(weight for *_, weight in find_hits(other, automaton))
    return math.log1p(100 * total / max(1, folded.count(" ") - 1)), math.log1p(total)


def phrases(text: str, automaton: ahocorasick.Automaton) -> set[str]:
    """The pairs of neighbouring words of which one has a hit."""
    folded, _ = fold(text)
    found = set()
    for start, *_ in find_hits(folded, automaton):
        before, at = folded.rfind(" ", 0, start), folded.index(" ", start + 1)
        if start > 0:
            found.add(folded[before + 1:at])
        after = folded.find(" ", at + 1)
        if after > 0:
            found.add(folded[start + 1:after])
    return found


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", held_out: Column | None = None, fit_rows: int = 20_000,
        exceptions: tuple[str, ...] = EXCEPTIONS, support: int = 5, share: float = 0.01,
        least: float = 3.0) -> Lexicon:
    """A lexicon from labelled documents: terms found in ``support`` positive ones or more,
    and in that ``share`` of them, whose log odds, less 1.5 standard errors, reach ``least``."""
    sample = training_rows(docs, labels, id_col, text_col, label_col, fit_rows, held_out)
    sample = sample.select("text", (F.col("label") > 0).cast("int").alias("label")).cache()
    sizes = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    positive, negative = sizes.get(1, 0), sizes.get(0, 0)

    def counted(items, label: int, least_count: float) -> dict[str, int]:
        """In how many texts of a label each of the ``items`` of a text is found."""
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            counts: Counter = Counter()
            find = items()
            for batch in batches:
                for text in batch["text"]:
                    counts.update(find(text))
            yield pd.DataFrame({"item": list(counts), "n": list(counts.values())},
                               columns=["item", "n"]).astype({"item": "str", "n": "int64"})

        rows = sample.where(F.col("label") == label).select("text")
        return {r["item"]: r["n"] for r in rows.mapInPandas(run, "item string, n bigint")
                .groupBy("item").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count).collect()}

    def bound(a: int, of_a: int, b: int, of_b: int) -> float:
        """Lower bound of the log odds of a kind that has ``a``, against one that has ``b``."""
        return (math.log((a + 0.5) / (of_a + 1)) - math.log((b + 0.5) / (of_b + 1))
                - 1.5 * math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)))

    if not (positive and negative):
        share_of_all = min(UNTOLD, (positive + 0.5) / (positive + negative + 2))
        sample.unpersist()
        return Lexicon({}, exceptions, (0.0, 0.0), math.log(share_of_all / (1 - share_of_all)))
    hit = counted(lambda: all_terms, 1, max(support, share * positive))
    wanted = frozenset(hit)
    clean = counted(lambda: lambda text: all_terms(text) & wanted, 0, 1)
    bounds = {t: bound(n, positive, clean.get(t, 0), negative) for t, n in hit.items()}
    weights = {t: b for t, b in bounds.items() if b >= least}
    weights = {t: weights[t] for t in chosen_terms({t: hit[t] for t in weights})}

    # Pairs of words around a hit that clean texts have far more often than toxic ones.
    given = Lexicon(weights, exceptions)

    def around():
        automaton = given.automaton()
        return lambda text: phrases(text, automaton)

    harmless = counted(around, 0, support)
    if harmless:
        meant = counted(around, 1, 1)
        learned = {p for p, n in harmless.items() if bound(n, negative, meant.get(p, 0), positive) > 0}
        exceptions = tuple(sorted({*exceptions, *learned}))
    found = Lexicon(weights, exceptions)

    @F.pandas_udf("array<double>")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = found.automaton()
        for texts in batches:
            yield texts.map(lambda t: list(measures(t, automaton)))

    points = sample.select(measure("text").alias("x"), "label").toPandas()
    sample.unpersist()
    curve = logistic(np.stack(points["x"].to_numpy()), points["label"].to_numpy(float))
    return Lexicon(weights, exceptions, (float(curve[0]), float(curve[1])), float(curve[2]))


def chosen_terms(counts: dict[str, int]) -> list[str]:
    """Terms that do not repeat each other.

    A beginning stands for its words where it is found half as often again as the
    commonest of them, and is as long as its count allows.
    """
    commonest: dict[str, int] = {}
    for term, n in counts.items():
        if term.endswith(" "):
            for k in range(2, len(term) - 1):
                commonest[term[:k]] = max(n, commonest.get(term[:k], 0))
    starts = {t: n for t, n in counts.items()
              if not t.endswith(" ") and n >= 1.5 * commonest.get(t, 0)}
    best: dict[str, int] = {}  # the largest count of a longer beginning
    for term, n in starts.items():
        for k in range(2, len(term)):
            best[term[:k]] = max(n, best.get(term[:k], 0))
    starts = {t: n for t, n in starts.items() if best.get(t, 0) < 0.95 * n}
    return sorted(t for t in {*starts, *(t for t in counts if t.endswith(" "))}
                  if not any(t[:k] in starts for k in range(2, len(t))))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Slopes and offset by Newton's method; the penalty keeps separable data finite."""
    design = np.c_[x, np.ones(len(x))]
    w = np.zeros(design.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - y) + penalty * w
        hess = (design * (p * (1 - p))[:, None]).T @ design + penalty * np.eye(len(w))
        w = w - np.clip(np.linalg.solve(hess, grad), -5, 5)
    return w


def score_column(lexicon: Lexicon, text: str = "text") -> Column:
    """The probability that a text is toxic."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = lexicon.automaton()
        for texts in batches:
            found = np.array([measures(t, automaton) for t in texts], dtype=float).reshape(-1, 2)
            raw = found @ np.array(lexicon.slopes) + lexicon.offset
            yield pd.Series(1 / (1 + np.exp(-np.clip(raw, -30, 30))))

    return score(F.coalesce(F.col(text), F.lit("")))


def toxicity(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = 0.5) -> DataFrame:
    """``id, score, predicted`` of every row."""
    scored = narrow(docs, id_col, text_col).select("id", score_column(lexicon).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, lexicon: Lexicon, text_col: str = "text",
               threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more."""
    return docs.where(score_column(lexicon, text_col) < threshold)
