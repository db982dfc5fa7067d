"""How far sources diverge in their terms: Gustavson's row accumulation.

Texts are cut into terms (runs of letters A to Z, lower-cased, and of characters beyond
ASCII). Each language keeps the terms of at least ``support`` of its documents. A
group (a language's source) and the language itself give each kept term the smoothed
share ``p = 1 + floor(10^9 (count + 2) / (N + 2 V))``; two groups differ by the sum of
``f = floor((p - q)^2 / (p + q))`` over all kept terms.

The terms are dealt to blocks by their hash, each with its whole slice of the
term-major index: the groups that have the term, and their shares. In a block every
group is one row. It scatters its terms through the index into a dense accumulator
with one cell for each peer, so that no pair of postings is ever a row of its own. Only
terms that both have are met that way; f of a term that one of them lacks is taken
against the other's share of a term it does not have (its baseline). So a group
first adds f of its own terms against all baselines, once for each distinct share, and
the scatter corrects what that got wrong. A block gives one row for each pair of
groups it knows, and these are summed.

All arithmetic is on integers. Null texts, languages and sources are empty strings. Groups
without terms and languages without kept terms are reported (value 0 where no term
is kept). Repeated rows count as often as they stand. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.frames import written

SCALE = 1_000_000_000
CELLS = 1_000_000  # of a table of shares and baselines that is held at once
# ASCII letters in lower case, every other ASCII character a blank, the rest as it is.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(TABLE).split()


def term_counts(docs: DataFrame, text_col: str, lang_col: str, source_col: str,
                most_entries: int = 400_000) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents; a null term for each group.

    Tasks count before anything is shuffled, ``most_entries`` terms at a time.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[tuple, tuple[Counter, Counter]] = {}

        def rows() -> Iterator[pd.DataFrame]:
            for (lang, source), (n, held) in found.items():
                terms = list(n)
                yield pd.DataFrame({
                    "lang": lang, "source": source,
                    "term": [None, *(t.decode("utf-8", "replace") for t in terms)],
                    "n": np.array([0, *(n[t] for t in terms)], dtype=np.int64),
                    "docs": np.array([0, *(held[t] for t in terms)], dtype=np.int64)})

        for batch in batches:
            for lang, source, text in zip(batch["lang"], batch["source"], batch["text"]):
                n, held = found.setdefault((lang, source), (Counter(), Counter()))
                words = terms_of(text)
                n.update(words)
                held.update(set(words))
            if sum(len(n) for n, _ in found.values()) >= most_entries:
                yield from rows()
                found = {}
        yield from rows()

    texts = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(name) for c, name in (
        (lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    return (texts.mapInPandas(run, "lang string, source string, term string, n bigint, docs bigint")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 kept)), exact; null where no term is kept."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(19,0)")
    whole = F.call_function("div", top, F.nullif(total + 2 * kept, F.lit(0)).cast("decimal(19,0)"))
    return (whole + 1).cast("bigint")


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def differences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    gap = p - q
    return gap * gap // (p + q)


def accumulate(key: tuple, postings: pd.DataFrame, peers: pd.DataFrame) -> pd.DataFrame:
    """A block's part of the value of each pair of groups (``low < high``).

    ``postings``: ``term, k, p`` of the block's terms; ``peers``: ``peer, share`` (the
    baseline) of all groups of the language, ``peer`` being their ``k``, from 0 on.
    """
    baseline = np.zeros(len(peers), np.int64)
    baseline[peers["peer"].to_numpy()] = peers["share"].to_numpy()
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(postings):
        term = pd.factorize(postings["term"])[0]
        k, p = postings["k"].to_numpy(), postings["p"].to_numpy()
        order = np.lexsort((k, term))  # the index: by term, then by group
        term, k, p = term[order], k[order], p[order]
        end = np.cumsum(np.bincount(term))[term]
        for g, at in zip(*rows_by_group(k)):
            own, counts = np.unique(p[at], return_counts=True)
            row = -len(at) * differences(baseline[g], baseline)
            at_once = max(1, CELLS // len(baseline))
            for j in range(0, len(own), at_once):
                part = slice(j, j + at_once)
                row += (differences(own[part, None], baseline[None, :]) * counts[part, None]).sum(axis=0)
            # The groups after this one in the lists of its terms.
            sizes = end[at] - at - 1
            met = np.repeat(at + 1 - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            other, theirs, mine = k[met], p[met], np.repeat(p[at], sizes)
            np.add.at(row, other, differences(mine, theirs) - differences(mine, baseline[other])
                      - differences(baseline[g], theirs) + differences(baseline[g], baseline[other]))
            row[g] = 0
            peer = np.flatnonzero(row)
            out.append((np.minimum(g, peer), np.maximum(g, peer), row[peer]))
    low, high, value = (np.concatenate([o[j] for o in out]) if out else np.empty(0, np.int64) for j in range(3))
    sums = pd.DataFrame({"low": low, "high": high, "value": value}).groupby(["low", "high"], as_index=False).sum()
    return sums.assign(lang=key[0])[["lang", "low", "high", "value"]]


def rows_by_group(k: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each group with the places of its postings."""
    order = np.argsort(k, kind="stable")
    groups, starts = np.unique(k[order], return_index=True)
    return groups, np.split(order, starts[1:])


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
               source_col: str = "source", support: int = 10, top_terms: int = 10,
               block_postings: int = 200_000) -> DataFrame:
    """``lang, source, part, item, value, rank``: all peers of each group, and its top terms."""
    counts = written(term_counts(docs, text_col, lang_col, source_col), "term-counts")
    words = counts.where(F.col("term").isNotNull())
    kept = written(words.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("in_lang"))
                   .where(F.col("docs") >= support).drop("docs"), "kept-terms")
    index = written(words.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "in_lang"), "index")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("in_lang").alias("lang_total"))
    totals = index.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_source = Window.partitionBy("lang").orderBy("source")
    groups = written(
        counts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left").fillna(0, ["total", "kept", "lang_total"])
        .withColumn("k", F.row_number().over(by_source) - 1)
        .withColumn("baseline", share(F.lit(0), F.col("total"), F.col("kept"))), "term-groups")
    shares = index.join(groups, ["lang", "source"]).withColumn(
        "p", share(F.col("n"), F.col("total"), F.col("kept")))
    return (pairs(shares, groups, index.count(), block_postings)
            .unionByName(striking_terms(shares, top_terms)))


def pairs(shares: DataFrame, groups: DataFrame, postings: int, block_postings: int) -> DataFrame:
    """Every group beside every other of its language, the most different first."""
    blocks = max(1, math.ceil(postings / block_postings))
    block = F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int")
    slices = shares.select("lang", block.alias("block"), "term", "k", "p")
    numbers = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    peers = (groups.where("kept > 0")
             .select("lang", numbers.alias("block"), F.col("k").alias("peer"),
                     F.col("baseline").alias("share")))
    partial = (slices.groupBy("lang", "block").cogroup(peers.groupBy("lang", "block"))
               .applyInPandas(accumulate, "lang string, low bigint, high bigint, value bigint"))
    summed = written(partial.groupBy("lang", "low", "high").agg(F.sum("value").alias("met")), "pair-sums")
    both = summed.select("lang", F.inline(F.array(
        F.struct(F.col("low").alias("k"), F.col("high").alias("other_k"), "met"),
        F.struct(F.col("high").alias("k"), F.col("low").alias("other_k"), "met"))))
    one = groups.select("lang", "source", "k", "baseline", "kept")
    other = groups.select("lang", F.col("source").alias("item"), F.col("k").alias("other_k"),
                          F.col("baseline").alias("other_baseline"))
    empty = F.coalesce(F.col("kept") * difference(F.col("baseline"), F.col("other_baseline")), F.lit(0))
    valued = (one.join(other, "lang").where("k <> other_k").join(both, ["lang", "k", "other_k"], "left")
              .select("lang", "source", F.lit("pair").alias("part"), "item",
                      (empty + F.coalesce("met", F.lit(0))).alias("value")))
    return valued.withColumn("rank", rank())


def rank() -> Column:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    return F.row_number().over(order)


def striking_terms(shares: DataFrame, top: int) -> DataFrame:
    """Terms that a group uses more than its language does, the most different first."""
    q = share(F.col("in_lang"), F.col("lang_total"), F.col("kept"))
    return (shares.withColumn("q", q).where((F.col("n") > 0) & (F.col("p") > F.col("q")))
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                    difference(F.col("p"), F.col("q")).alias("value"))
            .withColumn("rank", rank()).where(F.col("rank") <= top))
