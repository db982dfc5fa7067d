"""Near-duplicate documents by SimHash and the general pigeonhole principle.

Fingerprints within ``limit`` differing bits are linked; documents that links
connect share a component. The 64 bits are grouped into partitions of bits that
vary together. Each partition gets a threshold of its own: if partition i holds
at most t_i - 1 differing bits for some i whenever the t_i add up to limit + 1,
no link is missed. A dynamic program chooses the t_i for the smallest estimated
number of probes and candidates, from bit statistics of all fingerprints.

Documents with one fingerprint are one row before any comparison. The rows that
meet under a probe key are compared inside tasks, and only a spanning forest of
the links comes out, never all pairs. A key with more rows than ``unit`` is cut
into pieces, every two of which meet in a task of their own.

Null and empty texts and texts of white space have fingerprint zero, linked like
any other. Rows are kept one for one, null ids too (their component is the
smallest id of those they are linked to, null if there is none). An empty table
gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.frames import byte_words, narrow, written

BITS = 64


# --- fingerprints -------------------------------------------------------------

def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash over lower-cased word shingles, repeats included."""
    words = byte_words((text or "")) if text else []
    words = [w.lower() for w in words]  # of bytes: A-Z alone
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(b" ".join(words), seed)]
    else:
        hashes = [digest(b" ".join(s), seed)
                  for s in zip(*(words[k:] for k in range(shingle)))]
    array = np.array(hashes, dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(array), 65_536):
        part = array[at:at + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(array), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3, seed: int = 42) -> DataFrame:
    """``id, fp`` (the unsigned value's bits as a bigint) of every row."""
    source = narrow(docs, id_col, text_col)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle, seed) for t in batch["text"]], dtype=np.uint64)
            yield pd.DataFrame({"id": batch["id"], "fp": fps.view(np.int64)})

    return source.mapInPandas(run, f"id {source.schema['id'].dataType.simpleString()}, fp bigint")


def as_hex(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# --- the plan of the search ---------------------------------------------------

@dataclass(frozen=True)
class Part:
    """Bits of one partition, and how many of them a probe may flip."""
    bits: tuple[int, ...]
    flips: int

    @property
    def mask(self) -> int:
        return sum(1 << b for b in self.bits)

    def variants(self) -> np.ndarray:
        """What a fingerprint's masked value is combined with to make its probe keys."""
        return np.array([sum(1 << b for b in chosen) for k in range(self.flips + 1)
                         for chosen in combinations(self.bits, k)], dtype=np.uint64)


def bit_counts(classes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each two bits, how many have both set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            raw = batch["fp"].to_numpy(np.int64).astype("<i8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
            total, both = total + len(bits), both + (bits.T @ bits)
        yield pd.DataFrame({"cell": np.arange(BITS * BITS + 1),
                            "n": np.append(both.ravel(), total).astype(np.int64)})

    rows = (classes.select("fp").mapInPandas(run, "cell int, n bigint")
            .groupBy("cell").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(BITS * BITS + 1)
    for row in rows:
        counts[row.cell] = row.n
    return int(counts[-1]), counts[:-1].reshape(BITS, BITS)


def correlated_groups(n: int, both: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Bits in ``parts`` groups of equal size, each grown by the strongest correlation."""
    p = both.diagonal() / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    free, groups = list(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        first = max(free, key=lambda b: (corr[b, free].sum(), -b))
        group = [first]
        free.remove(first)
        while len(group) < size:
            best = max(free, key=lambda b: (corr[b, group].mean(), -b))
            group.append(best)
            free.remove(best)
        groups.append(tuple(sorted(group)))
    return groups


def plan_parts(n: int, both: np.ndarray, limit: int = 3, probe_cost: float = 20.0,
               max_parts: int = 6) -> list[Part]:
    """The partitions and thresholds of the smallest estimated cost.

    A threshold t >= 1 costs n probes for every set of less than t bits, and the
    candidates expected if bits differ independently, each at its own rate.
    """
    p = both.diagonal() / max(n, 1)
    differ = 2 * p * (1 - p)
    best: tuple[float, list[Part]] | None = None
    for m in range(1, max_parts + 1):
        groups = correlated_groups(n, both, m)
        prices = []
        for group in groups:
            within = np.zeros(limit + 2)  # chance of exactly k differing bits
            within[0] = 1
            for b in group:
                within[1:] = within[1:] * (1 - differ[b]) + within[:-1] * differ[b]
                within[0] *= 1 - differ[b]
            prices.append([0.0] + [
                probe_cost * n * sum(comb(len(group), k) for k in range(t))
                + n * n * within[:t].sum() for t in range(1, limit + 2)])
        table: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for price in prices:
            table = {total: min((table[total - t][0] + price[t], table[total - t][1] + (t,))
                                for t in range(total + 1) if total - t in table)
                     for total in range(limit + 2)}
        cost, chosen = table[limit + 1]
        if best is None or cost < best[0]:
            best = (cost, [Part(g, t - 1) for g, t in zip(groups, chosen) if t])
    return best[1]


# --- candidates and links -----------------------------------------------------

def spanning_links(fps: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct ``fps``: each is reached once."""
    rest, links = fps, []
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            at = frontier.pop()
            near = np.bitwise_count(rest ^ at) <= limit
            if near.any():
                found = rest[near]
                links.extend((int(at), int(x)) for x in found)
                frontier.extend(found)
                rest = rest[~near]
    return links


def unit_links(batches: Iterator[pd.DataFrame], limit: int) -> Iterator[pd.DataFrame]:
    """Links inside each run of rows of one unit; the rows come sorted by unit."""
    keys = ["part", "key", "left", "right"]
    held: list[pd.DataFrame] = []

    def linked(pdf: pd.DataFrame) -> pd.DataFrame:
        fps = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        unit = pdf[keys].to_numpy(np.int64)
        starts = np.flatnonzero(np.r_[True, (unit[1:] != unit[:-1]).any(axis=1)])
        ends = np.r_[starts[1:], len(fps)]
        found: list[tuple[int, int]] = []
        two = ends - starts == 2
        a, b = fps[starts[two]], fps[starts[two] + 1]
        near = (np.bitwise_count(a ^ b) <= limit) & (a != b)
        found.extend(zip(a[near].tolist(), b[near].tolist()))
        for start, end in zip(starts[ends - starts > 2], ends[ends - starts > 2]):
            found.extend(spanning_links(np.unique(fps[start:end]), limit))
        pairs = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    for batch in batches:
        if batch.empty:
            continue
        last = batch[keys].iloc[-1]
        whole = (batch[keys] != last).any(axis=1).to_numpy()
        cut = int(np.flatnonzero(whole)[-1]) + 1 if whole.any() else 0
        if cut == 0 and held and (held[-1][keys].iloc[-1] == last).all():
            held.append(batch)
            continue
        yield linked(pd.concat([*held, batch.iloc[:cut]]))
        held = [batch.iloc[cut:]]
    if held:
        yield linked(pd.concat(held))


def links(classes: DataFrame, parts: list[Part], limit: int, unit: int) -> DataFrame:
    """``a, b``: links that connect all linked fingerprints of ``classes`` (``fp``)."""
    masks = [(k, np.uint64(p.mask), p.variants()) for k, p in enumerate(parts)]

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = batch["fp"].to_numpy(np.int64).view(np.uint64)
            for part, mask, variants in masks:
                for at in range(0, len(fps), max(1, 200_000 // len(variants))):
                    some = fps[at:at + max(1, 200_000 // len(variants))]
                    key = ((some & mask)[:, None] ^ variants[None, :]).ravel()
                    yield pd.DataFrame({"part": part, "key": key.view(np.int64),
                                        "fp": np.repeat(some, len(variants)).view(np.int64)})

    probes = classes.select("fp").mapInPandas(probe, "part int, key bigint, fp bigint")
    met = (probes.groupBy("part", "key").agg(F.count("*").alias("n")).where(F.col("n") > 1))
    met = written(met.withColumn("pieces", F.ceil(F.col("n") / F.lit(unit // 2)).cast("int")),
                  "simhash-keys")
    pieces = F.when(F.col("n") <= unit, F.lit(1)).otherwise(F.col("pieces"))
    own = F.pmod(F.xxhash64("fp"), "pieces").cast("int")
    units = (probes.join(met, ["part", "key"]).withColumn("pieces", pieces)
             .withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
             .select("part", "key", F.least("own", "other").alias("left"),
                     F.greatest("own", "other").alias("right"), "fp"))
    order = ["part", "key", "left", "right"]
    return (units.repartition(*order).sortWithinPartitions(*order)
            .mapInPandas(lambda batches: unit_links(batches, limit), "a bigint, b bigint"))


# --- components ---------------------------------------------------------------

def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``node, label``: for every node of ``edges`` (``a, b``) the smallest node it reaches.

    Smallest labels spread along the edges, then every node takes its label's
    label, until nothing changes. Both joins are between written tables, so a
    node with very many edges is split.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node"))
                     .agg(F.least(F.min("b"), F.col("a")).alias("label"))
                     .select("node", "label"), "labels")
    state = None
    for _ in range(max_rounds):
        told = (both.join(labels, both.a == labels.node)
                .groupBy(F.col("b").alias("node")).agg(F.min("label").alias("heard")))
        spread = written(labels.join(told, "node")
                         .select("node", F.least("label", "heard").alias("label")), "labels")
        up = spread.select(F.col("node").alias("label"), F.col("label").alias("root"))
        labels = written(spread.join(up, "label").select("node", F.col("root").alias("label")),
                         "labels")
        now = labels.agg(F.count("*"), F.sum(F.xxhash64("node", "label").cast("decimal(38,0)"))).first()
        if now == state:
            return labels
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


@dataclass(frozen=True)
class NearDuplicates:
    """``rows``: id, fp, component of every row; the search that found them."""
    rows: DataFrame
    parts: list[Part]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    limit: int = 3, shingle: int = 3, seed: int = 42,
                    unit: int = 4096) -> NearDuplicates:
    """Components of documents whose fingerprints differ in ``limit`` bits or fewer."""
    fps = written(fingerprints(docs, id_col, text_col, shingle, seed), "simhash")
    classes = written(fps.groupBy("fp").agg(F.min("id").alias("least")), "simhash-classes")
    n, both = bit_counts(classes)
    parts = plan_parts(n, both, limit)
    found = components(links(classes, parts, limit, unit))
    rooted = written(classes.join(found, classes.fp == found.node, "left")
                     .select("fp", "least", F.coalesce("label", "fp").alias("root")), "simhash-roots")
    smallest = written(rooted.groupBy("root").agg(F.min("least").alias("component")),
                       "simhash-components")
    named = written(rooted.join(smallest, "root").select("fp", "component"), "simhash-named")
    return NearDuplicates(fps.join(named, "fp").select("id", "fp", "component"), parts)


def fingerprint_column(text: Column, shingle: int = 3, seed: int = 42) -> Column:
    """The fingerprint of a text, its unsigned bits as a bigint."""
    @F.pandas_udf("bigint")
    def run(texts: pd.Series) -> pd.Series:
        fps = np.array([fingerprint(t, shingle, seed) for t in texts], dtype=np.uint64)
        return pd.Series(fps.view(np.int64))

    return run(F.coalesce(text, F.lit("")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             limit: int = 3) -> DataFrame:
    """``docs`` with one document, the one with the smallest id, of each component.

    Rows with a null id belong to no group that ids could name and stay. Of the rows
    that share an id, one whose own component bears that id stays, if there is any;
    the others go.
    """
    rows = near_duplicates(docs, id_col, text_col, limit).rows
    leads = F.col("id") == F.col("component")
    named = F.col(id_col) == F.col("__id")
    ids = written(rows.where(F.col("id").isNotNull()).groupBy(F.col("id").alias("__id"))
                  .agg(F.max(leads).alias("leads"), F.count("*").alias("n"))
                  .where("not leads or n > 1"), "simhash-ids")
    gone = ids.where("not leads").select("__id")
    twice = ids.where("leads").select("__id")
    first = (rows.where(leads).select(F.col("id").alias("__id"), F.col("fp").alias("__fp"))
             .join(twice, "__id", "left_semi").distinct())
    stay = docs.join(gone, named, "left_anti")
    again = (stay.join(twice, named, "left_semi")
             .withColumn("__own", fingerprint_column(F.col(text_col)))
             .join(first, named & (F.col("__own") == F.col("__fp")), "left_semi")
             .dropDuplicates([id_col]).drop("__own"))
    return stay.join(twice, named, "left_anti").unionByName(again)
