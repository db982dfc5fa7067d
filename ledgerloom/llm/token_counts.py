"""Greedy word-piece token counts by a linear longest-match automaton.

The pieces of a vocabulary form a trie. A node that cannot go on has a failure
link to the node that remains once its longest pieces are popped, and the number
popped is known beforehand. Reading a word therefore costs one step for each
character and never looks back, and the count comes out without any piece built.

A piece that begins with the word mark starts a word. Text is split at white
space, and each word is read behind a mark. A character that no piece begins with
counts one token for each UTF-8 byte, as byte fallback has it; so does a
character that occurs in pieces only inside longer ones. Null and empty texts
have no tokens. Every row is counted; an empty table gives an empty result.
Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.frames import MAX_CACHED_WORDS, narrow

MARK = "▁"


class Automaton:
    """Node 0 is the root. ``step`` maps a node and a character to a node."""

    def __init__(self, pieces: Iterable[str]):
        pieces = sorted({p for p in pieces if p})
        self.step: list[dict[str, int]] = [{}]
        value = {0: 0}  # node: tokens that its whole string makes, where it is a piece
        for piece in pieces:
            value[self._node(piece)] = 1
        for c in sorted({c for p in pieces for c in p}):
            value.setdefault(self._node(c), len(c.encode("utf-8")))
        self.fail = [0] * len(self.step)
        self.popped = [0] * len(self.step)
        level = [(0, n, c) for c, n in self.step[0].items()]
        while level:
            following = []
            for parent, node, c in level:
                if node in value:
                    self.fail[node], self.popped[node] = 0, value[node]
                else:
                    at, count = self.fail[parent], self.popped[parent]
                    while c not in self.step[at]:
                        count += self.popped[at]
                        at = self.fail[at]
                    self.fail[node], self.popped[node] = self.step[at][c], count
                following.extend((node, child, k) for k, child in self.step[node].items())
            level = following

    def _node(self, text: str) -> int:
        at = 0
        for c in text:
            if c not in self.step[at]:
                self.step[at][c] = len(self.step)
                self.step.append({})
            at = self.step[at][c]
        return at

    def count(self, word: str) -> int:
        """Tokens of ``word``: the longest piece that fits, again and again."""
        step, fail, popped = self.step, self.fail, self.popped
        at = tokens = 0
        for c in word:
            while (following := step[at].get(c)) is None:
                if at == 0:
                    tokens += len(c.encode("utf-8"))
                    following = 0
                    break
                tokens += popped[at]
                at = fail[at]
            at = following
        while at:
            tokens += popped[at]
            at = fail[at]
        return tokens


def sentence_pieces(path: str) -> list[str]:
    """The ordinary pieces of a SentencePiece model file, read on the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    return [model.id_to_piece(k) for k in range(model.get_piece_size())
            if not any(kind(k) for kind in special)]


def token_counts(docs: DataFrame, pieces: Iterable[str], id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id, n_tokens`` of every row; the vocabulary is sent to the tasks once."""
    source = narrow(docs, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(tuple(pieces))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton, known = Automaton(sent.value), {}
        for batch in batches:
            counts = []
            for text in batch["text"]:
                total = 0
                for word in text.split():
                    tokens = known.get(word)
                    if tokens is None:
                        if len(known) >= MAX_CACHED_WORDS:
                            known.clear()
                        tokens = known[word] = automaton.count(MARK + word)
                    total += tokens
                counts.append(total)
            yield pd.DataFrame({"id": batch["id"], "n_tokens": counts}).astype({"n_tokens": "int64"})

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInPandas(run, f"id {kind}, n_tokens bigint")
