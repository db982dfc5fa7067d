"""Benchmark items inside documents: containment search by size-partitioned MinHash.

An item is a set of word shingles. ``containment`` is the share of an item's distinct
shingles found anywhere in the document, reported from ``threshold`` on. Items are
partitioned by size, in powers of two. A partition whose items have up to n shingles
looks at a document through windows of 2n shingles, one every n, so an item that stands
in one piece lies whole in a window. Item and window then share at least that part of
their shingles which containment asks for, which bounds their Jaccard similarity
whatever the length of the document. Minima under random functions agree with a probability
equal to that similarity: each partition takes as many functions (bands of one row) as make
``miss`` the chance that an item is overlooked, even one that stands in two pieces of
equal length far apart, each a window's match of its own. What agrees is verified by exact
containment of the shingles (their 64-bit hashes) in the whole document, so nothing
false is reported, and an item found by one of its pieces counts with all of them. One in more
pieces may be overlooked more often.

Words are runs of letters, digits and underscores, lower-cased. Items of fewer
than ``shingle`` words are one shingle of all their words. Items without a word
match nothing; null and empty texts have no words. Items repeated under one id
count once, those repeated under other ids are reported for each. Rows that repeat
a document are each searched. Empty tables give an empty result. Columns other
than ids and texts are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.frames import WordHash, narrow

WORD = re.compile(r"\w+")
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of the word shingles of ``size`` words, given the words' hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out = (out ^ words[k:k + n]) * MIX
        out ^= out >> np.uint64(29)
    return out


@dataclass
class ItemClass:
    """Items of one shingle length and one size, with what finding them needs."""
    words: int                 # in a shingle
    step: int                  # a window begins every so many shingles and is twice as long
    ids: list = field(default_factory=list)
    shingles: list[np.ndarray] = field(default_factory=list)
    functions: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    minima: list[np.ndarray] = field(default_factory=list)  # of each function, sorted
    owners: list[np.ndarray] = field(default_factory=list)
    some: list[np.ndarray] = field(default_factory=list)    # whether a minimum begins with these bits

    def build(self, threshold: float, miss: float) -> "ItemClass":
        rng = np.random.default_rng(self.step)
        self.functions = rng.integers(0, 1 << 63, bands(self.shingles, self.step, threshold, miss),
                                      dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for function in self.functions:
            least = np.array([(s * function).min() for s in self.shingles], dtype=np.uint64)
            order = np.argsort(least, kind="stable")
            self.minima.append(least[order])
            self.owners.append(order)
            some = np.zeros(1 << PREFIX_BITS, dtype=bool)
            some[least >> np.uint64(64 - PREFIX_BITS)] = True
            self.some.append(some)
        return self


PREFIX_BITS = 16


def bands(shingles: list[np.ndarray], step: int, threshold: float, miss: float) -> int:
    """Functions that overlook an item in one piece, or in two equal ones, with probability ``miss`` at most."""
    fewest = min(map(len, shingles))
    needed = 1
    for pieces in (1, 2):
        piece = math.ceil(threshold * fewest / pieces - 1e-9)
        similar = piece / (2 * step + fewest - piece)
        if similar < 1:
            needed = max(needed, math.ceil(math.log(miss) / (pieces * math.log(1 - similar))))
    return needed


def build_index(items: list[tuple], shingle: int, threshold: float, miss: float = 1e-3) -> list[ItemClass]:
    """Classes of (id, text) items."""
    hashes, classes = WordHash(), {}
    for item, text in sorted(set(items), key=repr):
        words = WORD.findall((text or "").lower())
        if not words:
            continue
        size = min(shingle, len(words))
        own = np.unique(shingle_hashes(hashes.array(words), size))
        step = 1 << (len(own) - 1).bit_length()
        found = classes.setdefault((size, step), ItemClass(size, step))
        found.ids.append(item)
        found.shingles.append(own)
    return [c.build(threshold, miss) for _, c in sorted(classes.items())]


def candidates(hashes: np.ndarray, lengths: np.ndarray, c: ItemClass) -> set[tuple[int, int]]:
    """(document, item) pairs that agree in the minimum of a window.

    ``hashes`` holds the documents' shingles one after the other.
    """
    counts = -(-lengths // c.step)  # blocks of each document
    starts = np.cumsum(lengths) - lengths
    of = np.repeat(np.arange(len(lengths)), counts)
    first = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    blocks = starts[of] + first * c.step
    joined = np.append(of[1:] == of[:-1], False)  # a window goes on in the next block
    found: set[tuple[int, int]] = set()
    for j, function in enumerate(c.functions):
        least = np.minimum.reduceat(hashes * function, blocks) if c.step > 1 else (hashes * function)[blocks]
        window = least.copy()
        window[joined] = np.minimum(least[:-1], least[1:])[joined[:-1]]
        likely = np.flatnonzero(c.some[j][window >> np.uint64(64 - PREFIX_BITS)])
        left = np.searchsorted(c.minima[j], window[likely], "left")
        right = np.searchsorted(c.minima[j], window[likely], "right")
        for at in np.flatnonzero(right > left).tolist():
            doc = int(of[likely[at]])
            found.update((doc, int(item)) for item in c.owners[j][left[at]:right[at]])
    return found


def document_hits(hashes: np.ndarray, doc: np.ndarray, lengths: np.ndarray, c: ItemClass,
                  threshold: float) -> Iterator[tuple[int, object, float]]:
    """(document, item id, containment) of every document and item that pass."""
    starts = np.cumsum(lengths) - lengths
    hits: dict[int, list[int]] = {}
    for d, item in sorted(candidates(hashes, lengths, c)):
        hits.setdefault(d, []).append(item)
    for d, found in hits.items():
        own = np.unique(hashes[starts[d]:starts[d] + lengths[d]])
        for item in found:
            wanted = c.shingles[item]
            at = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
            share = (own[at] == wanted).sum() / len(wanted)
            if share >= threshold:
                yield int(doc[d]), c.ids[item], float(share)


def search(texts: list[str], index: list[ItemClass], threshold: float, hashes: WordHash,
           most: int = 200_000) -> Iterator[tuple[int, object, float]]:
    """(position of the text, item id, containment); texts go in runs of about ``most`` words."""
    def run(held: list[tuple[int, np.ndarray]]) -> Iterator[tuple[int, object, float]]:
        for size in sorted({c.words for c in index}):
            parts = [(k, shingle_hashes(words, size)) for k, words in held if len(words) >= size]
            if parts:
                together, lengths = np.concatenate([h for _, h in parts]), np.array([len(h) for _, h in parts])
                for c in index:
                    if c.words == size:
                        yield from document_hits(together, np.array([k for k, _ in parts]), lengths, c, threshold)

    held, words = [], 0
    for k, text in enumerate(texts):
        found = hashes.array(WORD.findall(text.lower()))
        held.append((k, found))
        words += len(found)
        if words >= most:
            yield from run(held)
            held, words = [], 0
    if held:
        yield from run(held)


def item_blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple]]:
    """The items, in blocks of at most ``block_chars`` characters or of one hash value."""
    size = F.length("text") + 64
    total = items.agg(F.sum(size)).first()[0] or 0
    n = max(1, math.ceil(total / block_chars))
    while n > 1:
        split = F.pmod(F.xxhash64("id", "text"), F.lit(n))
        over = (items.groupBy(split.alias("block")).agg(F.sum(size).alias("size"), F.count("*").alias("n"))
                .where((F.col("size") > block_chars) & (F.col("n") > 1)))
        if over.isEmpty() or n > 64 * total / block_chars:
            break
        n *= 2
    for b in range(n):
        block = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b)
        yield [(r.id, r.text) for r in block.collect()]


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", shingle: int = 5, threshold: float = 0.8,
                  block_chars: int = 8_000_000) -> DataFrame:
    """``id, item, containment`` of every document and item contained in it.

    The items are the query set: they are read in blocks of at most
    ``block_chars`` characters, each of which is sent to the tasks and searched for
    in all documents.
    """
    source = narrow(docs, id_col, text_col)
    items = narrow(benchmark, item_id_col, item_text_col).distinct()
    spark = docs.sparkSession
    kinds = [f.schema["id"].dataType.simpleString() for f in (source, items)]
    schema = f"id {kinds[0]}, item {kinds[1]}, containment double"
    found = spark.createDataFrame([], schema)
    for block in item_blocks(items, block_chars):
        index = build_index(block, shingle, threshold)
        if not index:
            continue
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            hashes = WordHash()
            for batch in batches:
                best: dict[tuple, float] = {}
                for k, item, share in search(batch["text"].tolist(), sent.value, threshold, hashes):
                    best[k, item] = max(share, best.get((k, item), 0.0))
                yield pd.DataFrame({"id": batch["id"].iloc[[k for k, _ in best]].to_numpy(),
                                    "item": [item for _, item in best],
                                    "containment": list(best.values())})

        found = found.union(source.mapInPandas(run, schema))
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text", **settings) -> DataFrame:
    """``docs`` without the documents that contain an item.

    The verdict is computed beside each row, so texts are not shuffled.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    spark = docs.sparkSession
    shingle, threshold = settings.get("shingle", 5), settings.get("threshold", 0.8)
    items = narrow(benchmark, settings.get("item_id_col", "item_id"),
                   settings.get("item_text_col", "text")).distinct()
    for block in item_blocks(items, settings.get("block_chars", 8_000_000)):
        index = build_index(block, shingle, threshold)
        if not index:
            continue
        docs = docs.where(is_clean(spark.sparkContext.broadcast(index), threshold)(text))
    return docs


def is_clean(sent, threshold: float):
    """Function of a text column: whether it contains no item of a broadcast index."""
    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = WordHash()
        for texts in batches:
            leaks = {k for k, *_ in search(texts.tolist(), sent.value, threshold, hashes)}
            yield pd.Series([k not in leaks for k in range(len(texts))], dtype=bool)

    return clean
