"""Keys that may be among many others, told apart before anything is shuffled.

A sieve is a table of bits, some of which each key sets. It is one row of bounded size,
so tasks hold it whole: a key that finds one of its bits unset is certainly not among
those of the sieve. The few that pass by chance are for the join that follows, so no
result depends on the number of bits. Beyond ``MOST_BITS / 16`` keys more pass by
chance, and the join shuffles more.

A null key sets the bits of a null. A sieve without keys passes none.
DataFrame functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.frames import written

LEAST_BITS, MOST_BITS = 1 << 12, 1 << 26
BITS_A_KEY, HASHES = 16, 3


def places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(k), key), F.lit(bits)) for k in range(HASHES)]


def word_of(place: Column) -> Column:
    return F.shiftright(place, 6)


def bit_of(place: Column) -> Column:
    return F.pmod(place, F.lit(64)).cast("int")


@dataclass(frozen=True)
class Sieve:
    """``table``: one row, the bits as an array of 64-bit words."""
    table: DataFrame
    bits: int

    def may_hold(self, key: Column) -> Column:
        words = self.table.scalar()
        found = [F.getbit(F.get(words, word_of(p).cast("int")), bit_of(p)) == 1 for p in places(key, self.bits)]
        passes = found[0]
        for each in found[1:]:
            passes = passes & each
        return passes


def sieve(keys: DataFrame, key: str, name: str, most_bits: int = MOST_BITS) -> Sieve:
    """The sieve of a written table's column."""
    bits = 1 << math.ceil(math.log2(BITS_A_KEY * keys.count() + 1))
    bits = max(LEAST_BITS, min(most_bits, bits))
    mark = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit_of(F.col("place")))
    marks = (keys.select(F.explode(F.array(*places(F.col(key), bits))).alias("place"))
             .groupBy(word_of(F.col("place")).alias("word")).agg(F.bit_or(mark).alias("mark")))
    every = keys.sparkSession.range(bits // 64).withColumnRenamed("id", "word").join(marks, "word", "left")
    in_order = F.array_sort(F.collect_list(F.struct("word", F.coalesce("mark", F.lit(0).cast("bigint")).alias("mark"))))
    return Sieve(written(every.agg(F.transform(in_order, lambda w: w["mark"]).alias("words")), name), bits)
