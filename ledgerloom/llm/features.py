"""Hashed words and structure statistics of a text, for the classifiers."""

from __future__ import annotations

import numpy as np

from ledgerloom.llm.frames import WordHash

# Bytes of each class.
UPPER = bytes(range(65, 91))
DIGIT = bytes(range(48, 58))
MARKS = b"#*$%&|<>@^~=+\\_{}[]"
STOPS = b".,;:?"
CALLS = b"!"
STATISTICS = 12


def share(data: bytes, kind: bytes) -> float:
    return (len(data) - len(data.translate(None, kind))) / max(1, len(data))


def statistics(data: bytes, words: list[bytes], chars: int) -> list[float]:
    """Numbers near the unit range that describe how a text is built; ``chars`` is metadata."""
    lines = [x for x in data.split(b"\n") if x.strip()]
    n = len(words)
    return [
        np.log1p(n) / 8, np.log1p(chars) / 10,
        10 * share(data, MARKS), 3 * share(data, UPPER), 5 * share(data, DIGIT),
        5 * share(data, STOPS), 10 * share(data, CALLS),
        min(4.0, len(data) / max(1, n) / 6), len(set(words)) / max(1, n),
        1 - len(set(lines)) / max(1, len(lines)), min(3.0, np.log1p(n / max(1, len(lines))) / 2),
        float(n == 0),
    ]


class Featurizer:
    """Rows of [statistics | word buckets]; bucket values have unit length."""

    def __init__(self, buckets: int = 512):
        self.buckets = buckets
        self.hashes = WordHash(buckets)

    @property
    def width(self) -> int:
        return STATISTICS + self.buckets

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.width), dtype=np.float32)
        for k, text in enumerate(texts):
            data = text.encode("utf-8", "replace")
            words = data.split()
            out[k, :STATISTICS] = statistics(data, words, len(text))
            counts = np.bincount(self.hashes.array(words, np.int64), minlength=self.buckets)
            norm = np.sqrt(np.square(counts, dtype=np.float64).sum())
            out[k, STATISTICS:] = counts / max(1.0, norm)
        return out

    def batches(self, texts: list[str], rows: int = 1024):
        for at in range(0, len(texts), rows):
            yield self(texts[at:at + rows])
