"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

The base counts are part of the result and so are taken of every text. What they
do not reject goes through further rules, one after the other until one rejects.
Each rule's cost and the share it rejects are measured on a bounded sample, and
the rules run by rejected rows per second. The order changes the work, not the
verdict, which is that no rule rejects.

Null and empty texts and texts of white space have no words and fail for that.
Every row gets a verdict; repeated rows get equal ones. An empty table gives an
empty result, the rules then in the order given. Columns other than id and text
are not read.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.frames import narrow, sampled

SYMBOLS = b"#*$%&|<>"
WINDOW = 8


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more in the text.

    Windows get equal numbers exactly if they are equal: numbers of words are
    joined to numbers of 2, 4 and at last ``window`` words (a power of two).
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    if len(known) == len(words):
        return 0
    size = 1
    while size < window:
        pairs = ids[:-size] * (int(ids.max()) + 1) + ids[size:]
        ids = np.unique(pairs, return_inverse=True)[1]
        size *= 2
    again = np.bincount(ids)[ids] > 1
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, np.flatnonzero(again), 1)
    np.add.at(edge, np.flatnonzero(again) + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


class Text:
    """A text and what rules ask about it, computed when first asked."""

    def __init__(self, text: str):
        self.text = text
        self.data = text.encode("utf-8", "replace")
        self.words = self.data.split()

    @cached_property
    def word_chars(self) -> int:
        spaces = len(self.data) - len(self.data.translate(None, b" \t\n\v\f\r"))
        return len(self.text) - spaces

    @cached_property
    def symbols(self) -> int:
        return len(self.data) - len(self.data.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.data.split(b"\n") if x.strip()]

    @cached_property
    def duplicate_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def repeats(self) -> int:
        return repeated_words(self.words)

    @property
    def base_failed(self) -> bool:
        return len(self.words) < 20 or 100 * self.repeats > 30 * len(self.words)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


def too_many_symbols(t: Text) -> bool:
    return t.symbols > 0.1 * len(t.words)


def shouted(t: Text) -> bool:
    letters = len(t.data) - len(t.data.translate(None, b"abcdefghijklmnopqrstuvwxyz"))
    capitals = len(t.data) - len(t.data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return capitals > letters and capitals >= 20


def odd_word_length(t: Text) -> bool:
    return not 2 * len(t.words) <= t.word_chars <= 20 * len(t.words)


def too_many_duplicate_lines(t: Text) -> bool:
    return t.duplicate_lines > max(2, 0.3 * len(t.lines))


def few_words_with_letters(t: Text) -> bool:
    bare = b"0123456789.,;:!?#*$%&|<>()[]{}+-=_/\\'\"@^~`"
    return sum(1 for w in t.words if not w.translate(None, bare)) > 0.5 * len(t.words)


def mostly_bullets(t: Text) -> bool:
    return sum(x.lstrip().startswith((b"-", b"*", "•".encode())) for x in t.lines) > 0.9 * len(t.lines)


def mostly_cut_lines(t: Text) -> bool:
    return sum(x.rstrip().endswith((b"...", "…".encode())) for x in t.lines) > 0.3 * len(t.lines)


def stuttered(t: Text) -> bool:
    return sum(a == b for a, b in zip(t.words, t.words[1:])) > 0.2 * len(t.words)


def poor_vocabulary(t: Text) -> bool:
    return len(t.words) >= 50 and len(set(t.words)) < 0.05 * len(t.words) ** 0.9


RULES = (Rule("symbols", too_many_symbols), Rule("capitals", shouted),
         Rule("word_length", odd_word_length), Rule("duplicate_lines", too_many_duplicate_lines),
         Rule("letters", few_words_with_letters), Rule("bullets", mostly_bullets),
         Rule("stutter", stuttered), Rule("cut_lines", mostly_cut_lines), Rule("vocabulary", poor_vocabulary))


def measured(docs: DataFrame, rules: Sequence[Rule], rows: int) -> dict[str, tuple[float, float]]:
    """(seconds for a row, share rejected) of each rule, on a sample of ``id, text``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t for t in map(Text, batch["text"]) if not t.base_failed]
            out = []
            for rule in rules:
                for t in texts:
                    vars(t).pop("lines", None)
                began = time.perf_counter()
                rejected = sum(rule.rejects(t) for t in texts)
                out.append((rule.name, time.perf_counter() - began, rejected, len(texts)))
            yield pd.DataFrame(out, columns=["rule", "seconds", "rejected", "rows"])

    found = (sampled(docs, F.col("id"), rows)
             .mapInPandas(run, "rule string, seconds double, rejected bigint, rows bigint")
             .groupBy("rule").agg(F.sum("seconds").alias("seconds"),
                                  F.sum("rejected").alias("rejected"), F.sum("rows").alias("rows")))
    return {r.rule: (r.seconds / max(1, r.rows), r.rejected / max(1, r.rows))
            for r in found.collect()}


def cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = 2_000) -> list[Rule]:
    """The rules by rejections for each second spent, most first."""
    facts = measured(docs, rules, rows)
    worth = {r.name: facts[r.name][1] / (facts[r.name][0] + 1e-9) if r.name in facts else 0.0
             for r in rules}
    return sorted(rules, key=lambda r: -worth[r.name])


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rules: Sequence[Rule] = RULES, sample_rows: int = 2_000) -> DataFrame:
    """``id``, the base counts, ``base_failed`` and ``kept`` of every row."""
    source = narrow(docs, id_col, text_col)
    ordered = cascade(source, rules, sample_rows)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                t = Text(text)
                failed = t.base_failed
                kept = not failed and not any(r.rejects(t) for r in ordered)
                out.append((len(t.words), t.word_chars, t.symbols, t.duplicate_lines, t.repeats,
                            failed, kept))
            counts = pd.DataFrame(out, columns=["n_words", "word_chars", "n_symbols",
                                                "n_dup_lines", "n_repeat_words", "base_failed",
                                                "kept"], index=batch.index)
            yield pd.concat([batch[["id"]], counts], axis=1)

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInPandas(run, f"id {kind}, n_words bigint, word_chars bigint, "
                              "n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
                              "base_failed boolean, kept boolean")
