"""How filters overlap: what each removes in every order, by radix text tries.

Five filters judge a text: A few words, B poor vocabulary, C many capitals, D marks,
E identical to a text with a smaller id, anywhere in the table. A to D follow from
the text alone. For E the texts are dealt to ranges of their order, whose borders
are prefixes no longer than tells neighbouring texts apart (taken from a bounded
sample of distinct texts, so that ranges hold about equally much). Each range's
texts go whole into a compressed trie that holds the least id at every terminal; a row
is a duplicate if its id is larger. Tasks that read the table build such tries
first: a row that is no least row there is known for a duplicate and travels without
its text, so of a group of copies, however large, one text leaves each task.

The result of a row is a mask of five bits. All orders follow from the number of
rows of each mask in a part, of those labelled good and of those labelled toxic.

Null texts are empty, null parts are the empty string. A row without an id has no
smaller one: it is no duplicate and makes none. Rows that repeat an id and a text
are no duplicates of each other. An id labelled more than once has each label that
any of its rows gives it; rows without a label count as neither good nor toxic. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MARKS = re.compile(r"[#$%&*|]")
CAPITALS = bytes(range(65, 91))
DUPLICATE = 1 << FILTERS.index("E")
ORDERS = ["".join(order) for order in permutations(FILTERS)]


def failed_filters(text: str) -> int:
    """Bits of the filters A to D that a text fails."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    capitals = len(data) - len(data.translate(None, CAPITALS))
    return ((len(words) < 50) | (100 * len(set(words)) < 65 * len(words)) << 1
            | (100 * capitals > 5 * len(text)) << 2 | (MARKS.search(text) is not None) << 3)


class Node:
    """An edge's characters, the nodes below by their first character, and what ends here."""

    __slots__ = ("label", "below", "value")

    def __init__(self, label: str):
        self.label = label
        self.below: dict[str, Node] = {}
        self.value = None


def common_length(label: str, text: str, at: int) -> int:
    """How many characters of ``label`` stand at ``at``; the first one does."""
    low, high = 1, min(len(label), len(text) - at)
    while low < high:
        half = (low + high + 1) // 2
        if text.startswith(label[low:half], at + low):
            low = half
        else:
            high = half - 1
    return low


class Trie:
    """A compressed trie of whole texts."""

    def __init__(self):
        self.root = Node("")
        self.chars = 0

    def terminal(self, text: str) -> Node:
        """The node at which ``text`` ends, made if need be."""
        node, at = self.root, 0
        while at < len(text):
            child = node.below.get(text[at])
            if child is None:
                child = node.below[text[at]] = Node(text[at:])
                self.chars += len(child.label)
                return child
            if not text.startswith(child.label, at):
                shared = common_length(child.label, text, at)
                upper = node.below[text[at]] = Node(child.label[:shared])
                child.label = child.label[shared:]
                upper.below[child.label[0]] = child
                child = upper
            node, at = child, at + len(child.label)
        return node

    def terminals(self) -> Iterator[tuple[str, object]]:
        """Every text that ends somewhere, and what is held there, in no given order."""
        stack = [(self.root, "")]
        while stack:
            node, before = stack.pop()
            text = before + node.label
            if node.value is not None:
                yield text, node.value
            stack.extend((child, text) for child in node.below.values())


class Terminal:
    """The least id of a text, its rows of that id by part, and the text's failed filters."""

    __slots__ = ("least", "rows", "mask")

    def __init__(self, mask: int):
        self.least, self.rows, self.mask = None, {}, mask

    def add(self, row_id: int, part: str, n: int) -> Iterator[tuple[int, str, int]]:
        """Take rows in; yields (id, part, rows) of those now known for duplicates."""
        if self.least is None or row_id < self.least:
            for name, count in self.rows.items():
                yield self.least, name, count
            self.least, self.rows = row_id, {part: n}
        elif row_id == self.least:
            self.rows[part] = self.rows.get(part, 0) + n
        else:
            yield row_id, part, n


ROW = "id bigint, known boolean, part string, n bigint, mask int"
COLUMNS = ["id", "known", "part", "n", "mask"]


class Rows:
    """Rows gathered for output, given out as frames of bounded size."""

    def __init__(self, columns: list[str], rows: int = 20_000, chars: int = 8_000_000):
        self.columns, self.limits = columns, (rows, chars)
        self.held, self.chars = [], 0

    def add(self, *row, chars: int = 0) -> None:
        self.held.append(row)
        self.chars += chars

    def frames(self, last: bool = False) -> Iterator[pd.DataFrame]:
        if self.held and (last or len(self.held) >= self.limits[0] or self.chars >= self.limits[1]):
            yield pd.DataFrame(self.held, columns=self.columns)
            self.held, self.chars = [], 0


def first_rows(borders: list[str], ranges: int, trie_chars: int):
    """Task over ``id, known, text, part``: least rows with their text and range, others without."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = Rows([*COLUMNS, "text", "place"])
        trie, spread = Trie(), 0

        def least_rows() -> Iterator[pd.DataFrame]:
            for text, found in trie.terminals():
                place = bisect_right(borders, text)
                for part, n in found.rows.items():
                    out.add(found.least, True, part, n, found.mask, text, place, chars=len(text))
                yield from out.frames()

        for batch in batches:
            for row_id, known, text, part in zip(batch["id"], batch["known"], batch["text"], batch["part"]):
                spread = (spread + 1) % ranges
                if not known:
                    out.add(0, False, part, 1, failed_filters(text), None, spread)
                    continue
                node = trie.terminal(text)
                if node.value is None:
                    node.value = Terminal(failed_filters(text))
                for other, name, n in node.value.add(row_id, part, 1):
                    out.add(other, True, name, n, node.value.mask | DUPLICATE, None, spread)
            yield from out.frames()
            if trie.chars >= trie_chars:
                yield from least_rows()
                trie = Trie()
        yield from least_rows()
        yield from out.frames(last=True)

    return run


def settled_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Task over the rows of some ranges: each row's mask, duplicates marked."""
    out, trie = Rows(COLUMNS), Trie()
    for batch in batches:
        for row_id, known, part, n, mask, text in zip(*(batch[c] for c in (*COLUMNS, "text"))):
            if text is None:
                out.add(row_id, known, part, n, mask)
                continue
            node = trie.terminal(text)
            if node.value is None:
                node.value = Terminal(mask)
            for other, name, count in node.value.add(row_id, part, n):
                out.add(other, True, name, count, mask | DUPLICATE)
        yield from out.frames()
    for _, found in trie.terminals():
        for part, n in found.rows.items():
            out.add(found.least, True, part, n, found.mask)
        yield from out.frames()
    yield from out.frames(last=True)


def range_borders(texts: DataFrame, ranges: int, sample_chars: float, total_chars: int,
                  longest: int = 10_000) -> list[str]:
    """Prefixes that part the distinct texts into ``ranges`` of about equal length.

    About ``sample_chars`` characters of texts chosen by their hash are sorted in Spark; a
    border is the shortest prefix that tells a text from the one before (at most
    ``longest`` characters). At most two borders a range reach the driver.
    """
    share = math.ceil(min(1.0, sample_chars / max(1, total_chars)) * 1_000_000)
    sample = texts.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share).select("text").distinct()
    step = min(sample_chars, total_chars) / ranges

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before, since = None, 0.0
        for batch in batches:
            found = []
            for text in batch["text"]:
                if since >= step and text:
                    if before and before[0] == text[0]:
                        size = common_length(before, text, 0) + 1
                    else:
                        size = 1
                    found.append(text[:min(size, longest)])
                    since -= step * math.floor(since / step)
                before, since = text, since + len(text)
            yield pd.DataFrame({"border": found}, columns=["border"]).astype({"border": "str"})

    return sorted({r.border for r in sample.orderBy("text").mapInPandas(run, "border string").collect()})


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
          range_chars: int = 32_000_000, trie_chars: int = 32_000_000,
          sample_chars: int = 100_000) -> DataFrame:
    """``id, part, n, mask``: all rows, ``n`` of each, with the bits of the filters they fail.

    ``range_chars``: characters of a range; ``trie_chars``: of a trie that a reading task
    fills before it gives its least rows out and begins anew; ``sample_chars``: of the
    sample from which a range's borders are taken.
    """
    row_id = F.col(id_col).cast("bigint")
    texts = docs.select(F.coalesce(row_id, F.lit(0)).alias("id"), row_id.isNotNull().alias("known"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                        F.coalesce(F.col(part_col), F.lit("")).alias("part"))
    total = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(shuffles, math.ceil(total / range_chars))
    borders = range_borders(texts, ranges, ranges * sample_chars, total)
    firsts = texts.mapInPandas(first_rows(borders, ranges, trie_chars), f"{ROW}, text string, place int")
    dealt = firsts.repartitionById(len(borders) + 1, F.col("place") % (len(borders) + 1))
    return dealt.mapInPandas(settled_rows, ROW).select(
        F.when(F.col("known"), F.col("id")).alias("id"), "part", "n", "mask")


def mask_counts(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``part, mask, n, good, toxic``: rows of each mask, and those labelled."""
    known = labels.select(F.col(id_col).cast("bigint").alias("id"), "quality", "toxic").where("id is not null")
    known = known.groupBy("id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                                    F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    return rows.join(known, "id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0))).alias(c) for c in ("good", "toxic")])


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
AUDIT = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COUNTS)


def order_matrices() -> dict[str, np.ndarray]:
    """For every order and step (rows), which masks (columns) each count takes in."""
    out = {name: np.zeros((len(ORDERS) * 5, 32), np.int64) for name in COUNTS[:4]}
    for k, order in enumerate(ORDERS):
        before = 0
        for step, letter in enumerate(order):
            bit, row = 1 << FILTERS.index(letter), 5 * k + step
            for mask in range(32):
                fails, earlier = bool(mask & bit), bool(mask & before)
                out["kept"][row, mask] = not fails and not earlier
                out["removed"][row, mask] = fails and not earlier
                out["redundant"][row, mask] = fails and earlier
                out["unique_fails"][row, mask] = mask == bit
            before |= bit
    return out


def every_order(counts: DataFrame) -> DataFrame:
    """One row for each part, order and step, from the counts of each part's 32 masks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matrices = order_matrices()
        orders, steps = np.repeat(ORDERS, 5), np.tile(np.arange(1, 6, dtype=np.int32), len(ORDERS))
        letters = np.array([FILTERS.index(letter) for order in ORDERS for letter in order])
        for batch in batches:
            for part, cells in zip(batch["part"], batch["cells"]):
                n, good, toxic = (np.zeros(32, np.int64) for _ in range(3))
                for cell in cells:
                    m = cell["mask"]
                    n[m], good[m], toxic[m] = cell["n"], cell["good"], cell["toxic"]
                found = {name: matrix @ n for name, matrix in matrices.items()}
                shapley = np.zeros(len(FILTERS), np.int64)
                np.add.at(shapley, letters, found["removed"])
                yield pd.DataFrame({
                    "part": part, "filter_order": orders, "step": steps, **found,
                    "good_lost": matrices["removed"] @ good, "toxic_lost": matrices["removed"] @ toxic,
                    "shapley": shapley[letters]})

    # A part has at most 32 cells.
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return cells.mapInPandas(run, AUDIT)


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source", **settings) -> DataFrame:
    """Counts of every part, filter order and step."""
    return every_order(mask_counts(masks(docs, id_col, text_col, part_col, **settings), labels, id_col))
